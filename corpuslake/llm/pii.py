"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

The base expressions give the seeds. Every seed and every other word with a digit or an
``@`` is an instance; a lexical pattern is the word before it together with its shape. In
each round a pattern's confidence for a kind is the mean score of the distinct values it
extracts, and a value's score the best confidence of its patterns, seeds staying at one.
Patterns backed by enough distinct seeds then name the values that no expression found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import store, table

KINDS = ("email", "ip", "card", "phone")

# The base expressions, possessive so that no text makes them step back or recurse. A
# match can begin inside a run of its characters only where the last match ended, so
# other starts inside a run need no trial.
_RUN = r"(?:(?<![{0}])|\G)"
PATTERNS = {
    "email": _RUN.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its expression to be tried at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Words that may be identifiers, and the marks around them that are no part of one.
WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
OPENING, CLOSING = r"^[\"'(\[<{]*", r"[\"'.,;:!?)\]>}]*$"

ROUNDS = 3
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.9
MIN_LENGTH = 4
#: So many characters before an instance are searched for the word before it.
CONTEXT = 64

_SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
BEFORE = r"(?<!\S)([^\s0-9@]+)\s*+[\"'(\[<{]*$"


def _hits(text: Column, kind: str, pattern: str, hint: str | None) -> Column:
    """All matches, left to right: kind, number, characters since the last one, value, word before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("value"), F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"))
    hits = F.transform(pairs, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nr"), F.length(p["gap"]).cast("long").alias("gap"), p["value"].alias("value"),
        F.lower(F.regexp_extract(F.substring(p["gap"], -CONTEXT, CONTEXT), BEFORE, 1)).alias("before"),
    ))
    none = F.array().cast("array<struct<kind:string,nr:int,gap:bigint,value:string,before:string>>")
    return F.when(F.contains(text, F.lit(hint)), hits).otherwise(none) if hint else hits


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(char, i):
        d = char.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), weight)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _shape(value: Column) -> Column:
    """The value with runs of letters and digits as ``a`` and 9; a number alone keeps its length."""
    run = F.when(value.rlike("^[0-9]+$"), "[0-9]").otherwise("[0-9]++")
    return F.regexp_replace(F.regexp_replace(value, F.lit(r"\p{L}++"), F.lit("a")), run, F.lit("9"))


def _instances(rows: DataFrame) -> DataFrame:
    """One row per valid base span and per other candidate, whose kind is null."""
    by_kind = Window.partitionBy("row", "kind").orderBy("nr")
    placed = rows.select("row", F.inline("hits")).withColumn("end", F.sum(F.col("gap") + F.length("value")).over(by_kind))
    placed = placed.withColumn("start", F.col("end") - F.length("value"))
    valid = F.lit(False)
    for kind in KINDS:
        valid = valid | ((F.col("kind") == kind) & _valid(kind, F.col("value")))
    base = placed.filter(valid).select("row", "kind", "start", "end", "value", "before")
    lead = F.length("value") - F.length(F.regexp_replace("value", OPENING, ""))
    core = F.regexp_replace(F.regexp_replace("value", OPENING, ""), CLOSING, "")
    words = placed.filter("kind = 'word'").select(
        "row", F.lit(None).cast("string").alias("kind"), (F.col("start") + lead).alias("start"),
        (F.col("start") + lead + F.length(core)).alias("end"), core.alias("value"), "before",
    ).filter(F.length("value") >= MIN_LENGTH)
    # A word overlaps a base span if one that starts no later ends after its start, or one
    # that starts no earlier starts before its end.
    seeds_end, seeds_start = F.when(F.col("kind").isNotNull(), F.col("end")), F.when(F.col("kind").isNotNull(), F.col("start"))
    up, down = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.desc("start"))
    both = base.unionByName(words).withColumn("reach", F.max(seeds_end).over(up)).withColumn("next", F.min(seeds_start).over(down))
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return both.filter(F.col("kind").isNotNull() | apart).select(
        "row", "kind", "start", "end", "value", F.concat_ws(" ", "before", _shape(F.col("value"))).alias("pattern")
    )


def discovered(instances: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Value and kind of identifiers that high-confidence patterns extract and no expression found.

    The graph has an edge per pattern and distinct value; both sides are aggregated
    before each shuffle, so a pattern or value of many texts costs one row a task.
    """
    seeds = instances.filter(F.col("kind").isNotNull()).groupBy("value", "kind").agg(F.lit(1.0).alias("score"))
    edges = instances.select("pattern", "value").distinct()
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    support = edges.join(seeds, "value").groupBy("pattern", "kind").agg(F.count("*").alias("n_seeds"))
    trusted = support.filter(F.col("n_seeds") >= min_seeds).select("pattern", "kind")
    scores = seeds
    for _ in range(rounds):
        confidence = (
            edges.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
            .join(trusted, ["pattern", "kind"]).join(size, "pattern")
            .select("pattern", "kind", (F.col("sum") / F.col("n")).alias("confidence"))
        )
        reached = edges.join(confidence, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("score"))
        scores = reached.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score"))
    known = seeds.select("value").distinct()
    best = scores.filter(F.col("score") >= min_confidence).join(known, "value", "left_anti")
    return best.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("found"))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", **bootstrap) -> DataFrame:
    """Key, one array of base spans per kind, and ``added``, spans that patterns discovered.

    Positions count code points, the end is exclusive. A null or empty text has no
    spans. Every row of ``docs`` gives one row, repeated ones too; a null key stays
    null. Other columns are not read, whatever their names. Empty in, empty out. An
    added span never overlaps a base span, and is a value without base match of its own.
    """
    body = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hits = [_hits(F.col("text"), k, PATTERNS[k], HINTS[k]) for k in KINDS]
    # The only pass over the texts; what is left of them are the matches.
    rows, _ = store(body.select(
        "id", F.monotonically_increasing_id().alias("row"), F.concat(*hits, _hits(F.col("text"), "word", WORD, None)).alias("hits")
    ), "pii")
    instances, _ = store(_instances(rows), "pii-instances")
    named = discovered(instances, **bootstrap)
    added = instances.filter("kind IS NULL").join(named, "value").select("row", F.col("found").alias("kind"), "start", "end", "value", F.lit(True).alias("new"))
    spans = instances.filter("kind IS NOT NULL").select("row", "kind", "start", "end", "value", F.lit(False).alias("new")).unionByName(added)
    span = F.struct("start", "end", "value")
    listed = spans.groupBy("row").agg(
        *[F.collect_list(F.when((F.col("kind") == k) & ~F.col("new"), span)).alias(k) for k in KINDS],
        F.collect_list(F.when(F.col("new"), F.struct("kind", "start", "end", "value"))).alias("added"),
    )
    none = F.array().cast(_SPAN)
    return rows.select("id", "row").join(listed, "row", "left").select(
        F.col("id").alias(key), *[F.coalesce(F.array_sort(k), none).alias(k) for k in KINDS],
        F.coalesce(F.array_sort("added"), F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")).alias("added"),
    )


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.array_join(F.concat(*[_listed(k, F.col(k)) for k in KINDS]), ",")

    def both(kind):
        bare = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        mine = F.transform(F.filter("added", lambda s: s["kind"] == kind), bare)
        return _listed(kind, F.array_sort(F.concat(F.transform(F.col(kind), bare), mine)))

    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"), F.array_join(F.concat(*[both(k) for k in KINDS]), ",").alias("spans"),
    )
