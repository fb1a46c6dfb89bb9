"""MinHash, decontamination, passages, URLs and components."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpuslake.llm import decontaminate, minhash, passages, urls
from corpuslake.llm.components import components
from corpuslake.llm.words import WordHashes, shingle_set

quick = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def smallest_reachable(nodes, links):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[n] = min(seen)
    return out


@pytest.mark.parametrize("edges", [
    [], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)],
    [(random.Random(i).randrange(60), random.Random(-i).randrange(60)) for i in range(45)], [(1, 1), (2, None), (None, 3)],
])
def test_components_equal_search(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == smallest_reachable({n for e in real for n in e}, real)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [np.sort(base[:800]), np.sort(base[100:]), np.sort(base[:1]), np.sort(base[:7])]
    out = minhash.sketches(sets)
    assert (out != np.uint64(2**64 - 1)).all()
    assert abs((out[0] == out[1]).mean() - 700 / 900) < 0.12
    assert (minhash.sketches(sets[:1])[0] == out[0]).all()  # a sketch depends on its set alone


def documents(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "size", "threshold"), [(1, 3, 0.85), (2, 5, 0.8), (3, 3, 0.5)])
def test_near_duplicates_equal_brute_force(spark, seed, size, threshold):
    texts = documents(seed)
    sets = [frozenset(shingle_set(t.encode(), size, WordHashes()).tolist()) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= round(100 * threshold) * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in minhash.near_duplicates(docs, size, threshold).collect()}
    if threshold < 0.8:  # below the design threshold bands may miss links, never make them
        want = smallest_reachable(range(len(texts)), links)
        assert all(got[i] >= want[i] for i in got)
    else:
        assert got == smallest_reachable(range(len(texts)), links)


def test_leftover_pairs_in_a_bucket_are_found(spark):
    """A chain of similar texts: neighbours are linked, but no member is linked with all."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[8 * i : 8 * i + 200]) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component"] for r in minhash.near_duplicates(docs, 3, 0.85).collect()} == {0}


def test_group_of_near_copies_of_one_text(spark):
    """Every copy has words of its own; which are linked, and through which, is up to their number."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(120):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(0, 8)):
            copy[at] = f"new{i}-{at}"
        texts.append(" ".join(copy))
    sets = [frozenset(shingle_set(t.encode(), 3, WordHashes()).tolist()) for t in texts]
    links = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in minhash.near_duplicates(docs, 3, 0.85).collect()}
    assert got == smallest_reachable(range(120), links) and len(set(got.values())) > 1


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    rows = minhash.near_duplicates(awkward, 3, 0.85).collect()
    assert len(rows) == awkward.count()
    by_id = {r["id"]: r for r in rows}
    assert by_id[0]["n"] == by_id[1]["n"] == by_id[2]["n"] == 0 and by_id[1]["component"] == 1
    assert by_id[3]["n"] == 1
    assert by_id[50]["component"] == by_id[51]["component"] == by_id[None]["component"] == 50
    assert minhash.near_duplicates(nothing).count() == 0


def naive_leaks(doc, items, window):
    words = decontaminate.words_of(doc.encode())
    hit, found = set(), set()
    for name, text in items:
        own = decontaminate.words_of(text.encode())
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[at : at + size]:
                    hit |= set(range(i, i + size))
                    found.add(str(name))
    return len(words), hit, found


@quick
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=5), st.lists(st.lists(st.sampled_from("abcd"), max_size=30), min_size=1, max_size=6))
def test_search_equals_brute_force(spark, items, docs):
    items = [(i, " ".join(x)) for i, x in enumerate(items)]
    texts = [" ".join(x) for x in docs]
    search = decontaminate.Benchmark(items, 4)
    for text in texts:
        words = decontaminate.words_of(text.encode())
        hit, names = search.find(words)
        assert (len(words), {i for i, h in enumerate(hit) if h}, names) == naive_leaks(text, items, 4)


def test_blocks_of_items_agree(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 14)))) for i in range(30)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice("abcdef") for _ in range(60))) for i in range(40)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(decontaminate.find_leaks(docs, benchmark, 4).collect())
    assert one == sorted(decontaminate.find_leaks(docs, benchmark, 4, max_block_chars=100).collect())
    for r in one:
        n, hit, names = naive_leaks(r["text"], items, 4)
        runs = zip(r["leaks"][::2], r["leaks"][1::2], strict=True)
        assert (r["n_words"], {i for a, b in runs for i in range(a, b)}, set(r["leak_items"])) == (n, hit, names)


def test_leaks_of_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "the LAZY dog"), (1, None), (None, "quick brown"), (2, ""), (2, "one")], "item_id long, text string")
    out = decontaminate.find_leaks(awkward, benchmark)
    assert out.columns == [*awkward.columns, "n_words", "leaks", "leak_items"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert {r["doc_id"]: r["leak_items"] for r in rows if r["leaks"]} == {50: ["1"], 51: ["1"], None: ["1"], 3: ["2"]}
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0
    assert decontaminate.find_leaks(awkward, benchmark.limit(0)).filter("size(leaks) > 0").count() == 0


@pytest.mark.parametrize("t", [1, 2, 5, 9])
def test_compact_windows_equal_recursion(t):
    rng = np.random.default_rng(t)
    for _ in range(40):
        lengths = rng.integers(0, 40, size=4)
        lengths = np.where(lengths >= t, lengths, 0)
        x = rng.integers(1, 2**63, size=int(lengths.sum()), dtype=np.uint64)
        want, base = set(), 0

        def split(owner, a, b, x=x, want=want):
            if b - a + 1 >= t:
                m = a + int(x[a : b + 1].argmin())
                want.add((owner, a, m, b))
                split(owner, a, m - 1)
                split(owner, m + 1, b)

        for owner, n in enumerate(lengths):
            split(owner, base, base + n - 1)
            base += n
        assert set(zip(*[v.tolist() for v in passages.compact_windows(x, lengths, t)], strict=True)) == want


def test_passages_of_fifty_words_are_found(spark):
    rng = random.Random(8)
    fresh = iter(range(10**6))
    passage = [f"p{i}" for i in range(60)]
    altered = [*passage[:30], "other", *passage[31:]]
    short = [f"s{i}" for i in range(40)]
    rows = []
    for i in range(30):
        body = [f"u{next(fresh)}" for _ in range(rng.randrange(20, 200))]
        middle = passage if i < 12 else altered if i < 15 else short if i < 22 else []
        at = rng.randrange(len(body))
        rows.append((i, " ".join(body[:at] + middle + body[at:])))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = {r["id"] for r in found} | {r["other_id"] for r in found}
    assert ids == set(range(15))
    words = {i: t.split() for i, t in rows}
    for r in found:
        a, b = words[r["id"]][r["begin"] : r["end"]], words[r["other_id"]][r["other_begin"] : r["other_end"]]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8
        assert min(len(a), len(b)) >= 50


@pytest.mark.parametrize("size", [50, 55, 60, 65, 70])
def test_one_edit_at_any_place_is_verified(size):
    fresh = iter(range(10**6))

    def tokens(passage):
        words = [next(fresh) for _ in range(60)] + passage + [next(fresh) for _ in range(60)]
        return passages.shingles(passages.mixed(np.array(words, np.uint64)), passages.SHINGLE)

    for place in range(size):
        passage = [next(fresh) for _ in range(size)]
        other = [*passage[:place], next(fresh), *passage[place + place % 2 :]]  # in turns changed and inserted
        a, b = tokens(passage), tokens(other)
        one, two = (passages.windows_of([x], passages.MIN_TOKENS)[0] for x in (a, b))
        found = passages.verified(a, b, passages.joined(one, two), passages.MIN_TOKENS, 0.8)
        x, y = a[60 : 56 + size], b[60 : 56 + len(other)]
        p, q = set(x.tolist()), set(y.tolist())
        assert 100 * len(p & q) >= 80 * len(p | q)
        agreeing = sum(x[passages.hashed_by(x, f).argmin()] == y[passages.hashed_by(y, f).argmin()] for f in range(passages.FUNCTIONS))
        assert found or agreeing < passages.AGREE, place
        for begin, end, low, high, similarity in found:
            x, y = set(a[begin : end + 1].tolist()), set(b[low : high + 1].tolist())
            assert similarity == len(x & y) / len(x | y) >= 0.8 and min(end - begin, high - low) + 1 >= passages.MIN_TOKENS


def test_repeated_passages_are_all_joined():
    rng = np.random.default_rng(4)
    passage, fresh = rng.integers(0, 2**63, 60, dtype=np.uint64), lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    a = np.concatenate([fresh(70), passage, fresh(70), passage, fresh(70)])
    b = np.concatenate([fresh(50), passage, fresh(90), passage, fresh(50)])
    one, two = (passages.windows_of([x], passages.MIN_TOKENS)[0] for x in (a, b))
    found = passages.verified(a, b, passages.joined(one, two), passages.MIN_TOKENS, 0.8)
    assert len({(f[0], f[2]) for f in found}) == 4


def test_functions_agree_at_the_threshold():
    rng = np.random.default_rng(6)
    missed = 0
    for _ in range(1_000):  # 80 common of 100
        x = rng.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = x[:90], x[10:]
        agreeing = sum(a[passages.hashed_by(a, f).argmin()] == b[passages.hashed_by(b, f).argmin()] for f in range(passages.FUNCTIONS))
        missed += agreeing < passages.AGREE
    assert missed <= 15


def test_passages_that_the_representatives_lack_are_found(spark):
    """Two copies of a passage, and variants of it (0.75 and less) and its lines in documents of any number."""
    rng = random.Random(12)
    fresh = iter(range(10**6))
    rows, wanted = [], []

    def add(middle):
        body = [f"u{next(fresh)}" for _ in range(60)]
        rows.append((len(rows), " ".join(body[:30] + middle + body[30:])))
        return rows[-1][0]

    for case in range(40):
        passage = [f"p{case}x{i}" for i in range(60)]
        variants = []
        for place in (12, 25, 38, 50):
            variants.append([*passage[:place], f"v{next(fresh)}", *passage[place + 1 : place + 5], f"v{next(fresh)}", *passage[place + 6 :]])
        lines = [passage[i : i + 20] for i in (0, 20, 40)]
        places = [add(passage), *[add(v) for v in variants if case % 2], *[add(x) for x in lines for _ in range(3)], add(passage)]
        wanted.append((places[0], places[-1]))
    rng.shuffle(rows)
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    words = {i: t.split() for i, t in rows}
    linked = {i for r in found for i, o, w in ((r["id"], r["other_id"], r["begin"]), (r["other_id"], r["id"], r["other_begin"])) if i != o}
    assert {i for pair in wanted for i in pair} <= linked
    for r in found:
        a, b = words[r["id"]][r["begin"] : r["end"]], words[r["other_id"]][r["other_begin"] : r["other_end"]]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8
        assert min(len(a), len(b)) >= 50
    assert len({(r["id"], r["other_id"], r["begin"], r["other_begin"]) for r in found}) == len(found)


def test_passages_of_awkward_rows(awkward, nothing):
    found = passages.repeated_passages(awkward).collect()
    assert {r["id"] for r in found} | {r["other_id"] for r in found} == {50, 51, None}
    assert passages.repeated_passages(nothing).count() == 0


PAGES = [
    (1, "http://a.example.org/x", '<link rel="canonical" href="http://spam.net/es/1">'), (2, "http://spam.net/es/1", ""),
    (3, "https://b.example.org/y#top", '<META http-equiv=refresh content="0; url=http://a.example.org/x">'), (4, "http://b.example.org:80/y", None),
    (5, "http://c.org/z", "<link href='/w' rel=canonical>"), (6, "http://C.org/w?q=1#f", ""), (7, None, "<p>"), (8, "no url", ""), (9, "", None),
    (10, "http://shop.com/", '<link rel="canonical" href="http://spam.net/es/1">'), (11, "http://www.example.com/en/1", ""), (12, "http://m.example.com/en/1", ""),
    (13, "http://example.com", ""), (14, "ftp://x.net/fr/a?b", ""), (2, "http://spam.net/es/1", ""),
]


def test_urls(spark):
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, rule string")
    rows = {r["page_id"]: r for r in urls.filter_urls(pages, rules).collect()}
    assert (rows[11]["rule"], rows[11]["verdict"]) == ("www.example.com/en/", "allow")
    assert (rows[12]["rule"], rows[12]["verdict"]) == ("example.com/en/", "block")
    assert (rows[13]["host"], rows[13]["path"], rows[13]["rule"]) == ("example.com", "", None)
    assert (rows[14]["host"], rows[14]["path"], rows[14]["verdict"]) == ("x.net", "/fr/a", "block")
    assert rows[6]["host"] == "c.org" and rows[5]["verdict"] == "allow"
    # The allowed page 10 names spam.net/es/1 too, so its other aliases stay, and its own rule blocks page 2.
    assert rows[1]["component"] == rows[2]["component"] == rows[3]["component"] == rows[4]["component"] == rows[10]["component"]
    assert [rows[i]["verdict"] for i in (1, 2, 3, 4, 10)] == ["allow", "block", "allow", "allow", "allow"]
    assert all((rows[i]["host"], rows[i]["path"], rows[i]["verdict"]) == ("", "", "allow") for i in (7, 8, 9))
    without = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages.filter("page_id <> 10"), rules).collect()}
    assert [without[i] for i in (1, 2, 3, 4)] == ["block"] * 4
    assert urls.filter_urls(pages, rules).count() == len(PAGES)
    assert urls.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
