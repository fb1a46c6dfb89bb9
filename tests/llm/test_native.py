"""Exact dedup, line dedup and personal data."""

import hashlib
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpuslake.llm import exact_dedup, line_dedup, pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in BASE.items()}


def spans_of(row):
    return {k: [(s["start"], s["end"]) for s in row[k]] for k in BASE}


def test_exact_groups_keep_the_largest_id(spark, awkward):
    rows = exact_dedup.exact_groups(awkward).collect()
    assert len(rows) == awkward.count()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text_sha256"]].append(r)
    assert {len(g) for g in groups.values()} == {1, 3, 4}  # null twice and empty; a line in four rows
    for group in groups.values():
        assert sum(r["kept"] for r in group) == 1
        ids = [r["doc_id"] for r in group if r["doc_id"] is not None]
        assert all(r["group_size"] == len(group) and r["keep_id"] == max(ids) for r in group)
    assert hashlib.sha256(b"").hexdigest() in groups


def test_exact_groups_of_nothing_and_of_null_ids(spark, nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    rows = exact_dedup.exact_groups(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).collect()
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in rows) == [(None, 2, False), (None, 2, True)]


def test_hot_and_cold_digests_agree(spark):
    docs = spark.range(4_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id DIV 2 AS STRING) END AS text")
    hot = {tuple(r) for r in exact_dedup.exact_groups(docs).collect()}
    assert hot == {tuple(r) for r in exact_dedup.exact_groups(docs, hot_share=0.9).collect()}
    assert [r[1] for r in hot if r[2] > 1_000] == [3_999] * 1_334


def deduped(texts):
    """Brute force over (id, text) rows with different ids."""
    first, lines = {}, {i: t.split("\n") for i, t in texts}
    gone = defaultdict(set)
    for i, own in sorted(lines.items()):
        for at in range(len(own) - 2):
            window = tuple(x.strip(" ") for x in own[at : at + 3])
            if not any(window):
                continue
            j, p = first.setdefault(window, (i, at))
            if (j, p) != (i, at):
                gone[i] |= set(range(max(at, p + 3) if i == j else at, at + 3))
    return {i: "\n".join(x for n, x in enumerate(own) if n not in gone[i]) for i, own in lines.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["a", "b", " a", "", "c"]), max_size=12), min_size=1, max_size=8))
def test_lines_equal_brute_force(spark, texts):
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == deduped(rows)


def test_lines_of_awkward_rows(awkward, nothing):
    out = line_dedup.dedup_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert [r["n_removed"] for r in by_id[51]] == [6]  # the last window ends with the empty line
    assert by_id[50][0] == by_id[50][1]  # repeated rows fare alike
    assert by_id[0][0]["text"] is None and by_id[0][0]["n_lines"] == 0
    assert by_id[1][0]["text"] == "" and by_id[2][0]["text"] == " \n\n "
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_hot_windows_agree(spark):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('x\ny\nz\n', id, '\n', id DIV 2, '\nq\n', id DIV 2) AS text")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got == deduped([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_base_spans_equal_plain_expressions(spark):
    texts = [
        "a.b+c@d-e.co.uk, x@y..z@w.v a@b.c_d@e.f @a.b q@r", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255 1.2.3",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 5 41111111111111111111111", "+1 (569) 555-1219 +49.30.123456 ++12 + 1",
        "ß\U0001f600 é 10.0.0.1 \U0001f600 a@b.cd", "1.2.3.4 " * 300, "1" * 3_000, "1-" * 2_000 + "1", "+1" + "2 " * 2_000, "", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_pii(docs).collect():
        assert spans_of(row) == base_spans(texts[row["doc_id"]]), row["doc_id"]


def test_long_runs_are_linear(spark):
    texts = ["a@b" + ".c" * 200_000, "1" * 400_000, "1-" * 200_000, "+1" + "2 " * 200_000, "a" * 400_000, "1.2.3.4." * 50_000]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: sum(len(r[k]) for k in BASE) for r in rows} == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 50_000}


def test_contexts_discover_unseen_identifiers(spark):
    seen = [(i, f"Words before. Visitors come from host 10.0.0.{i + 1} today") for i in range(20)]
    unseen = [(100, "Visitors come from host 900.0.0.7 today"), (101, "the sum was 900.0.0.8 today"), (102, "no data here")]
    rows = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(seen + unseen, "doc_id long, text string"), min_confidence=0.5).collect()}
    assert [(s["kind"], s["value"]) for s in rows[100]["added"]] == [("ip", "900.0.0.7")]
    text = dict(unseen)[100]
    assert text[rows[100]["added"][0]["start"] : rows[100]["added"][0]["end"]] == "900.0.0.7"
    assert rows[101]["added"] == [] == rows[102]["added"]
    assert all(len(rows[i]["ip"]) == 1 and not rows[i]["added"] for i, _ in seen)


def test_pii_of_awkward_rows(awkward, nothing):
    rows = pii.find_pii(awkward).collect()
    assert len(rows) == awkward.count()
    assert [[len(r[k]) for k in BASE] for r in rows if r["doc_id"] == 52] == [[1, 1, 0, 1]]
    assert pii.find_pii(nothing).count() == 0
