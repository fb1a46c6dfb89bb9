"""Language identification."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslake.llm import language
from corpuslake.llm.common import table

KNOWN = language.Letters()


def spelled(text):
    """Letters in runs with blanks around them, by expressions."""
    words = re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower()))
    return "".join(f" {w}" for w in words) + " " if words else ""


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("aÄ é1.\n😀𝔘", max_size=30))
def test_letters_equal_brute_force(text):
    codes = language.letters_only(text, KNOWN)
    want = "".join(c if c.isalpha() else " " for c in text.lower())
    assert "".join(map(chr, codes)) == ((" " + " ".join(want.split(" "))) and (f" {' '.join(w for w in want.split(' ') if w)} " if want.strip(" ") else ""))


def test_grams_are_counted_over_runs(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 5
    bucket, count = language.grams(text, KNOWN)
    padded = spelled(text)
    grams = Counter(padded[i : i + n] for n in language.ORDERS for i in range(len(padded) - n + 1))
    assert count.sum() == sum(grams.values()) and sorted(count) == sorted(grams.values())
    monkeypatch.setattr(language, "RUN", 7)
    again, counted = language.grams(text, KNOWN)
    assert (again == bucket).all() and (counted == count).all()


def test_a_step_follows_the_rule():
    """One feature at a time, in scalars."""
    random = np.random.default_rng(1)
    leader = language.Leader(3)
    z, n = {}, {}
    for _ in range(30):
        rows = np.append(random.choice(20, 4, replace=False), language.BUCKETS)
        values, truth = np.append(random.random(4), 1.0), int(random.integers(3))
        w = {}
        for r in rows.tolist():
            for c in range(3):
                l1, l2 = (0, 0) if r == language.BUCKETS else (language.L1, language.L2)
                at, sums = z.get((r, c), 0.0), n.get((r, c), 0.0)
                w[r, c] = 0.0 if abs(at) <= l1 else -(at - np.sign(at) * l1) / ((language.BETA + sums**0.5) / language.ALPHA + l2)
        p = language.softmax(np.array([sum(v * w[r, c] for r, v in zip(rows.tolist(), values, strict=True)) for c in range(3)]))
        for r, v in zip(rows.tolist(), values, strict=True):
            for c in range(3):
                g, old = v * (p[c] - (c == truth)), n.get((r, c), 0.0)
                z[r, c] = z.get((r, c), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / language.ALPHA * w[r, c]
                n[r, c] = old + g * g
        leader.learn(rows, values, truth)
    for (r, c), at in z.items():
        assert leader.z[r, c] == pytest.approx(at) and leader.n[r, c] == pytest.approx(n[r, c])


def test_temperature_has_the_least_loss():
    random = np.random.default_rng(3)
    truth = random.integers(0, 4, 4_000)
    honest = random.normal(size=(4_000, 4)) + 2 * np.eye(4)[truth]
    scores = 2 * honest  # with unit noise and means two apart the log odds are twice the values
    assert language.fitted_temperature(5 * scores, truth) == pytest.approx(5, rel=0.15)
    assert language.fitted_temperature(np.zeros((0, 4)), np.zeros(0, int)) == 1


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    model = language.train(docs)
    share = (model.weights[:-1] != 0).mean()
    assert 0 < share < 0.2 and model.languages == ["de", "en", "es", "fr"]
    rows = language.identify(docs, model).collect()
    assert len(rows) == docs.count()
    apart = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang"] == r["lang_pred"] for r in apart]) > 0.98
    assert np.mean([r["score"] for r in apart]) == pytest.approx(np.mean([r["lang"] == r["lang_pred"] for r in apart]), abs=0.03)
    again = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs.repartition(61), model).collect()}
    assert again == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"wort {i} und", "de") for i in range(40)] + [(i, f"word {i} and", "en") for i in range(40, 80)], "doc_id long, text string, lang string")
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    a, b = language.train(docs), language.train(other)
    assert a.languages == b.languages == ["de", "en"] and (a.weights == b.weights).all() and (a.idf == b.idf).all()


def test_sample_is_dealt_evenly(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(language, "fit", lambda languages, idf, sample: sizes.append(Counter(languages[t] for _, _, t in sample)))
    docs = spark.createDataFrame([(i, f"text number {i}", "en" if i % 10 else "de") for i in range(4_000)] + [(1, "again and again", "en")] * 500, "doc_id long, text string, lang string")
    language.train(docs, max_sample=60)
    assert sizes == [Counter(en=30, de=30)]


def test_awkward_rows(spark, awkward, nothing):
    labelled = awkward.selectExpr("*", "CASE WHEN doc_id > 3 THEN 'la' WHEN doc_id = 3 THEN 'en' END AS lang", "'z' AS lang_pred")
    for model in (language.train(labelled), language.train(labelled.filter("lang = 'la'")), language.train(labelled.limit(0))):
        out = language.identify(labelled, model)
        assert out.columns == [*[c for c in labelled.columns if c not in ("lang_pred", "score")], "lang_pred", "score"]
        rows = out.collect()
        assert len(rows) == labelled.count()
        for r in rows:
            assert 0 <= r["score"] <= 1
            assert (r["lang_pred"] == "und") == (not model.languages or not any(c.isalpha() for c in r["text"] or ""))
            assert r["lang_pred"] in (*model.languages, "und")
    assert language.identify(nothing, model).count() == 0
    digits = spark.createDataFrame([(1, "123 .,; 4"), (2, "٣"), (3, "ß")], "doc_id long, text string")
    model = language.train(labelled)
    assert [r["lang_pred"] == "und" for r in language.identify(digits, model).orderBy("doc_id").collect()] == [True, True, False]
