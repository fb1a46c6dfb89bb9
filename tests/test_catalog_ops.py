from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpuslake.operators import catalog, dedup, ops

COLUMNS = (
    "id long, feed_id string, url string, item_key string, content_hash string, s3_uri string, "
    "silver_s3_uri string, title string, published_at timestamp_ntz, status string, "
    "fetched_at timestamp_ntz, updated_at timestamp_ntz, feed_lang string, content_lang string"
)
T0 = datetime(2026, 8, 31, 6)


def at(time="12:00:00"):
    return F.to_timestamp_ntz(F.lit(f"2026-08-31 {time}"))


def table(spark, *statuses):
    rows = [
        (i, "f", f"u{i}", f"k{i}", f"h{i}", f"s3://b/bronze/{i}", f"s3://b/silver/{i}" if s != "fetched" else None,
         f"t{i}", T0, s, T0, T0, None, None)
        for i, s in enumerate(statuses)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def states(df):
    return [r.status for r in df.orderBy("id").collect()]


def test_guarded_transitions(spark):
    df = table(spark, "fetched", "parsed", "indexed", "embedded")
    every = df.select("url")
    assert states(catalog.advance(df, every, "parsed", at())) == ["parsed", "parsed", "indexed", "embedded"]
    assert states(catalog.advance(df, every, "indexed", at())) == ["fetched", "indexed", "indexed", "embedded"]
    assert states(catalog.advance(df, every, "embedded", at())) == ["fetched", "parsed", "embedded", "embedded"]
    assert states(catalog.advance(df, every, "parsed", at(), reparse=True)) == ["parsed"] * 4
    with pytest.raises(ValueError):
        catalog.advance(df, every, "fetched", at())
    with pytest.raises(ValueError):
        catalog.advance(df, every, "indexed", at(), reparse=True)


def test_repeated_marks_do_not_multiply_rows(spark):
    df = table(spark, "fetched")
    marks = df.select("url").union(df.select("url")).union(df.select("url"))
    moved = catalog.advance(df, marks, "parsed", at())
    assert moved.count() == 1 and moved.first().updated_at == datetime(2026, 8, 31, 12)


def test_page_and_filters(spark):
    df = table(spark, *["fetched", "parsed"] * 5)
    assert [r.id for r in catalog.page(df, limit=3, offset=2).collect()] == [7, 6, 5]
    assert [r.id for r in catalog.page(df, status="parsed", limit=2).collect()] == [9, 7]
    assert catalog.page(df, limit=10_000).count() == 10
    assert catalog.count_rows(df, feed_id="f", status="parsed").first().total == 5
    assert catalog.by_id(df, 3).first().url == "u3" and catalog.by_content_hash(df, "zz").isEmpty()


def test_rebuilding_the_index_keeps_embedded_articles(spark):
    df = table(spark, "fetched", "parsed", "indexed", "embedded")
    assert catalog.to_index(df).count() == 1 and catalog.to_index(df, rebuild=True).count() == 3
    assert catalog.to_embed(df).count() == 1 and catalog.to_embed(df, rebuild=True).count() == 2


def test_read_requests(spark):
    df = table(spark, "fetched", "parsed")
    silver = spark.createDataFrame(
        [("s3://b/silver/1", "h1", "T", "f", "c", "rss_summary", "fr", "x" * 500)],
        "silver_s3_uri string, content_hash string, title string, feed_id string, canonical_url string, "
        "text_source string, content_lang string, text string",
    )
    asked = spark.createDataFrame(
        [(1, "h1", None), (2, "h0", None), (3, "zz", None), (4, "h1", "s3://b/silver/1"), (5, None, " "),
         (6, None, "s3://b/bronze/1"), (7, None, "nope"), (8, None, "s3://b/silver/9"), (9, None, "s3://b/silver/1")],
        "request_id int, content_hash string, silver_s3_uri string",
    )
    got = {r.request_id: r for r in catalog.read_silver(asked, df, silver, max_chars=10).collect()}
    assert got[1].error is None and got[1].truncated and len(got[1].text) == 200 and got[1].status == "parsed"
    assert [got[i].error for i in range(2, 9)] == [
        "not parsed yet", "unknown content_hash", "both identifiers given", "no identifier given",
        "outside silver/", "invalid uri", "object not found",
    ]
    assert got[9].error is None and got[9].content_hash == "h1"


def test_feed_language(spark):
    df = table(spark, "fetched", "fetched").withColumn("feed_lang", F.when(F.col("id") == 0, "fr"))
    feeds = spark.createDataFrame([("g", "en")], "id string, lang string")
    assert [r.feed_lang for r in catalog.resolve_feed_lang(df, feeds).orderBy("id").collect()] == ["fr", "und"]


def test_ops_status(spark):
    df = table(spark, "fetched")
    assert ops.ops_status(df, at()).first().stale is False  # exactly six hours
    late = ops.ops_status(df, at("12:00:01")).first()
    assert late.stale and "no write for 6h" in late.message
    empty = ops.ops_status(df.limit(0), at()).first()
    assert empty.stale and empty.articles_total == 0 and empty.seconds_since_write is None


def test_gauges_of_an_empty_lake(spark):
    runs = spark.createDataFrame([], ops.RUN_SCHEMA)
    rows = ops.gauges(table(spark, "fetched").limit(0), runs, at()).collect()
    assert {(r.metric, r.value) for r in rows} == {
        ("catalog_articles_total", 0.0), ("last_write_timestamp", 0.0),
        ("seconds_since_last_write", -1.0), ("catalog_stale", 1.0),
    }


def test_run_counters_are_observed_during_the_write(spark):
    df = spark.createDataFrame([(None,), ("bad",), (None,)], "error string")
    seen, counts = ops.observed(df, F.col("error"))
    seen.write.format("noop").mode("overwrite").save()
    assert counts.get == {"new_items": 2, "errors": 1}
    with pytest.raises(ValueError):
        ops.run_row(spark, "sleep", datetime(2026, 1, 1))


def test_dedup(spark):
    rows = [("x:1", 1), ("y:1", 2), ("x:1", 3), ("z:9", 4)]
    df = spark.createDataFrame(rows, "seen_key string, n int")
    seen = spark.createDataFrame([("z:9",)], "seen_key string")
    first = dedup.unseen(df, seen, ["seen_key"], F.col("n"))
    assert sorted(r.n for r in first.collect()) == [1, 2]
    again = dedup.unseen(df, df, ["seen_key"], F.col("n"))
    assert again.isEmpty()
    assert dedup.insert_if_absent(seen, df, ["seen_key"], F.col("n")).filter("inserted").count() == 2
    assert dedup.duplicate_keys(df, ["seen_key"]).collect()[0].n == 2
    assert dedup.latest_per_key(df, ["seen_key"], F.col("n")).filter("seen_key = 'x:1'").first().n == 3


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("k"), F.col("id").alias("n"))
    plan = dedup.first_per_key(df, ["k"], F.col("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert dedup.first_per_key(df, ["k"], F.col("n")).first().n == 0


def test_page_totals_do_not_depend_on_the_page(spark):
    rows = spark.range(7).selectExpr(
        "id", "if(id < 5, 'a', 'b') AS feed_id", "'t' AS title", "string(id) AS url", "'parsed' AS status", "'h' AS content_hash",
        "'i' AS item_key", "'s' AS s3_uri", "'s' AS silver_s3_uri", "timestamp_seconds(id) AS published_at", "timestamp_seconds(id) AS fetched_at",
        "timestamp_seconds(id) AS updated_at", "'fr' AS feed_lang", "'fr' AS content_lang",
    )
    for offset, ids in ((0, [4, 3]), (4, [0]), (9, [])):
        page = catalog.page_with_total(rows, feed_id="a", limit=2, offset=offset).collect()
        assert [r.id for r in page] == ids and {r.total for r in page} <= {5}
    assert catalog.page_with_total(rows, feed_id="none").collect() == []
