"""Quality, language model and mixing."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from corpuslake.llm import lm, mixture, quality
from corpuslake.llm.common import table


def area_under_curve(score, label):
    rank = score.rank()
    good, bad = (label == 1).sum(), (label == 0).sum()
    return (rank[label == 1].sum() - good * (good + 1) / 2) / (good * bad)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op5_quality(spark, sf).toPandas()
    assert len(rows) == table(spark, sf, "documents").count()
    assert rows["score"].between(0, 1).all()
    both = rows.merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    apart = both[both["held_out"]]
    assert area_under_curve(apart["score"], apart["quality"]) > 0.95
    assert (apart["predicted"] == apart["quality"]).mean() > 0.97


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(50, 1), (51, 0), (3, 0), (4, 1), (5, None), (None, 1), (6, 7), (0, 0), (99, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = quality.train(awkward, some)
        out = quality.score_quality(awkward, model)
        assert out.columns == [*[c for c in awkward.columns if c != "score"], "score"]
        rows = out.collect()
        assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert quality.score_quality(nothing, model).count() == 0


def test_quality_follows_from_the_text_alone(spark, sf):
    """Scores and model are equal bit by bit, however the rows are dealt."""
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    found, models = [], []
    for many in (1, 97):
        dealt = docs.repartition(many, "doc_id")
        models.append(quality.train(dealt, labels))
        found.append({r["doc_id"]: r["score"] for r in quality.score_quality(dealt, models[0]).collect()})
    assert found[0] == found[1]
    assert all((models[0].p[k] == models[1].p[k]).all() for k in models[0].p)


def test_passages_are_encoded_without_their_neighbours():
    texts = [b"ab cd", b"", b" x" * 900, b"\x01q", "é".encode() * 700, b"", b"zz zz"]
    x, first = quality.encode(texts)
    ends = [*first[1:], len(x)]
    for text, a, b in zip(texts, first, ends, strict=True):
        assert (quality.encode([text])[0] == x[a:b]).all()
    assert not x[first[1]].any() and not quality.encode([b""])[0].any()


def test_attention_gradient_descends():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(rng.integers(1, 6), quality.FEATURES)).astype(np.float32) for _ in range(200)]
    labels = np.array([float(b[:, 3].max() > 1) for b in bags])
    model = quality.Attention().fit(bags, labels, epochs=30)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    assert ((model.score(np.concatenate(bags), first) > 0.5) == labels).mean() > 0.9


def tokens(text):
    return [*(text or "").encode().lower().split(), lm.END]


def test_unigram_part_equals_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = docs.collect()
    seen = Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            seen.update(tokens(r["text"]))
    n, v = sum(seen.values()), len(seen)
    texts = {r["doc_id"]: tokens(r["text"]) for r in rows}
    got = lm.score_texts(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        own = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in seen for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) and r["score"] < 0


def test_probabilities_of_all_next_words_add_up_to_one(spark):
    """Over all coded words and the escape, after a given context; and over all bytes of a spelling."""
    docs = spark.createDataFrame([(i, "the cat sat on the mat and the dog sat on the cat " * (1 + i % 3)) for i in range(20)], "id long, text string")
    model, _ = lm.train(docs, lm.vocabulary(docs.select("text")))
    words = [*model.code.index, b"unseen"]
    total = 0.0
    for word in words:
        if word == lm.END:
            continue
        both = lm.Words([b"the cat " + word], lm.Lexicon(model.code))
        cost = np.zeros(len(both.tokens))
        for place, slots, bit in both.steps:
            cost[: len(bit)] += model.words.bits_cost(place, slots, bit)
        total += math.exp(cost[both.order.tolist().index(2)])
    end = lm.Words([b"the cat"], lm.Lexicon(model.code))
    cost = np.zeros(3)
    for place, slots, bit in end.steps:
        cost[: len(bit)] += model.words.bits_cost(place, slots, bit)
    assert total + math.exp(cost[end.order.tolist().index(2)]) == pytest.approx(1, abs=1e-4)
    first = 0.0
    for byte in range(256):
        _, steps = lm.spelling([bytes([byte])])
        first += math.exp(sum(float(model.letters.bits_cost(place, slots, bit)[0]) for place, slots, bit in steps))
    assert first == pytest.approx(1, abs=1e-4)


def test_the_previous_two_words_decide(spark):
    """The second next word follows from the word before the last only, whose end all share."""
    names = [f"{a}{b}xx" for a in "bcdfghkl" for b in "aeiou"]
    texts = [" ".join(f"{names[(i * 7 + j * j) % 40]} then {names[(i * 7 + j * j + 13) % 40]}." for j in range(40)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm.score_texts(docs).filter("held_out").collect()
    # Of three words one, the first, is free: log2(40) bits.
    size = np.mean([len(t) / 120 for t in texts])
    assert np.mean([r["bits_per_byte"] for r in rows]) < 0.6 * math.log2(40) / size


def test_texts_that_weights_are_learned_on(spark, monkeypatch):
    learned = []
    learn = lm.Mixer.learn
    monkeypatch.setattr(lm.Mixer, "learn", lambda self, steps: (learned.append(sum(len(bit) for _, _, bit in steps())), learn(self, steps, 1))[1])
    monkeypatch.setattr(lm, "RUN_BYTES", 2_000)
    docs = spark.createDataFrame([(i, f"a b {i % 3}") for i in range(900)] + [(i, f"a b {i}") for i in range(900, 1200)], "id long, text string")
    model, _ = lm.train(docs, lm.vocabulary(docs.select("text")))
    texts = sorted(r["text"] for r in docs.collect())
    least = min(sum(len(bit) for _, _, bit in lm.Words([t.encode()], lm.Lexicon(model.code)).steps) for t in texts)
    assert learned[0] >= 1_000 * least


def test_counts_are_added_up_in_levels(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} and word{i % 5}") for i in range(60)], "id long, text string")
    counted = lm.vocabulary(docs.select("text"))
    one, _ = lm.train(docs.coalesce(1), counted)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    many, _ = lm.train(docs.repartition(9), counted)
    assert all((a == b).all() for a, b in zip(one.words.stretch, many.words.stretch, strict=True))


def test_language_model_of_awkward_rows(awkward, nothing):
    rows = lm.score_texts(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_tokens"] == by_id[1]["n_tokens"] == 1 and by_id[0]["bits_per_byte"] is None
    assert all(r["score"] < 0 for r in rows)
    assert lm.score_texts(nothing).count() == 0
    assert lm.score_texts(awkward.filter("doc_id = 999 OR doc_id IS NULL")).count() == 1


def test_rates_meet_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = mixture.op9_mixture(spark, sf).toPandas()
    assert len(rows) == 1_000 and (rows["rate"] >= 0).all()
    total = rows["n_tokens"].sum()
    for domain in mixture.DOMAINS:
        share = (rows["rate"] * rows["n_tokens"] * rows[f"p_{domain}"]).sum() / total
        assert share == pytest.approx(mixture.TARGETS[domain], abs=1e-4)
    assert ((rows["copies"] - rows["rate"]).abs() < 1).all()


def test_descent_equals_exact_solution(spark):
    """One-hot posteriors: the rate of a domain is its target over its share."""
    eye = np.eye(3).tolist()
    stored = spark.createDataFrame([(n, eye[d]) for n, d in [(10, 0), (30, 0), (40, 1), (20, 2), (0, 1)]], "n long, p array<double>")
    steps = mixture.fit_steps(stored, [1.0, 1.0, 2.0])
    assert np.allclose(mixture.rates(np.eye(3), steps), [0.25 / 0.4, 0.25 / 0.4, 0.5 / 0.2], atol=1e-4)
    assert len(mixture.fit_steps(stored.limit(0), [1.0, 1.0, 1.0])) == 0


def test_classifier_finds_labelled_domains(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = mixture.train(docs, labels.filter("doc_id % 4 <> 0"))
    mixed = mixture.mix(docs.join(labels.filter("doc_id % 4 = 0"), "doc_id"), model, mixture.TARGETS).toPandas()
    truth = np.where(mixed["quality"] == 0, 2, np.where(mixed["toxic"] == 1, 1, 0))
    assert (np.stack(mixed["posterior"]).argmax(1) == truth).mean() > 0.85


def test_mixing_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(50, 1, 0), (3, 0, 0), (4, 1, 1), (None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        model = mixture.train(awkward, some)
        rows = mixture.mix(awkward, model, mixture.TARGETS).collect()
        assert len(rows) == awkward.count() and all(r["rate"] >= 0 for r in rows)
        assert {r["n_tokens"] for r in rows if not r["text"]} == {0}
    assert mixture.mix(nothing, model, mixture.TARGETS).count() == 0


@pytest.mark.parametrize("largest", [1, 200, 60_000, 3_000_000_000, 2**40])
@pytest.mark.parametrize("filled", [1, 40, 900, 1_000])
def test_blocks_of_counts_come_back_whole(largest, filled):
    block = np.zeros(1_000, np.int64)
    block[np.random.default_rng(filled).choice(1_000, filled, replace=False)] = np.linspace(1, largest, filled).astype(np.int64)
    block[block.argmax()] = largest
    assert (lm.unpacked(lm.packed(block), len(block)) == block).all()
