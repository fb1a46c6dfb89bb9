"""Registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.functions import contracts as rules
from corpuslake.functions import keys, text
from corpuslake.operators import (
    answers,
    catalog,
    chunking,
    contracts,
    dedup,
    encode,
    evaluation,
    extraction,
    fusion,
    gold,
    joins,
    langid,
    lexical,
    lexical_index,
    ops,
    vector,
    vector_index,
)
from corpuslake.plans import stages
from corpuslake.plans import tables as t
from corpuslake.schemas import struct
from corpuslake.session import shared_folder, spread, written
from corpuslake.settings import ANALYZED_LANGS, EMBEDDING_DIMS, TOP_K_DEFAULT, RetrievalSettings
from corpuslake.sources import bus, evalset, feeds, lake
from corpuslake.sources import tables as stores
from corpuslake.streaming import ingest as streams

DEPTH = 10
NOW = "2024-02-01 00:00:00"


def _day(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts)


def _now() -> Column:
    return F.to_timestamp_ntz(F.lit(NOW))


# --- identity, layout, envelopes ----------------------------------------------


def item_identity(spark, sf):
    known = lake.identified(t.entries(spark, sf), _now())
    return known.select(
        "doc_id", "feed_id", "item_key", "content_hash", "seen_key", "dt",
        keys.object_uri(t.BUCKET, keys.object_key("bronze", F.col("feed_id"), F.col("dt"), F.col("content_hash"))).alias("s3_uri"),
    )


def uri_parts(spark, sf):
    pages = t.read(spark, sf, "pages")
    uri = F.regexp_replace("url", "^https?://(m[.])?", "s3://")
    return pages.select(
        "page_id", keys.uri_bucket(uri).alias("bucket"), keys.uri_key(uri).alias("object_key"),
        F.when(keys.uri_key(uri).isNull(), "invalid uri").alias("error"),
    )


def bronze_envelope(spark, sf):
    known = lake.identified(t.entries(spark, sf), _now())
    return known.select("doc_id", lake.bronze_json(known, F.lit(NOW)).alias("raw_json"))


def silver_envelope(spark, sf):
    rows = t.silver(spark, sf).withColumn(
        "content_lang_confidence", F.when(F.col("content_lang") == "fr", 0.5)
    )
    return rows.select("doc_id", lake.silver_json().alias("raw_json"))


def chunk_uuid5(spark, sf):
    chunks = t.chunks(spark, sf)
    return chunks.select("chunk_id", keys.uuid5_url(F.col("chunk_id")).alias("point_id"))


def detection_input(spark, sf):
    """Title and text joined the way language detection sees them."""
    rows = t.silver(spark, sf)
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit(""))
    sample = keys.strip(F.concat(title, F.lit("\n"), F.col("text")))
    return rows.select("doc_id", F.length(sample).cast("long").alias("n_chars"), F.md5(sample).alias("digest"))


# --- catalog ------------------------------------------------------------------


def catalog_count(spark, sf):
    a = t.articles(spark, sf)
    every = catalog.count_rows(a).select(F.lit("all").alias("scope"), "total")
    parsed = catalog.count_rows(a, status="parsed").select(F.lit("parsed").alias("scope"), "total")
    one = catalog.count_rows(a, feed_id="src1", status="indexed").select(
        F.lit("src1 indexed").alias("scope"), "total"
    )
    return every.unionByName(parsed).unionByName(one)


def catalog_status_counts(spark, sf):
    return catalog.status_counts(t.articles(spark, sf))


def feed_summary(spark, sf):
    return catalog.feed_summary(t.articles(spark, sf)).select(
        "feed_id", "n", _day("first_fetched"), _day("last_fetched")
    )


def articles_page(spark, sf):
    page = catalog.page(t.articles(spark, sf), status="indexed", limit=50, offset=100)
    return page.select(*[_day(c) if c.endswith("_at") else F.col(c) for c in catalog.PAGE_COLUMNS])


def articles_page_total(spark, sf):
    """A page of one feed's articles with the number of all of them."""
    page = catalog.page_with_total(t.articles(spark, sf), feed_id="src2", limit=20, offset=5)
    return page.select(*[_day(c) if c.endswith("_at") else F.col(c) for c in catalog.PAGE_COLUMNS], "total")


def article_lookups(spark, sf):
    """One article by its number and the same by its content hash."""
    a = t.articles(spark, sf)
    digest = a.filter("id = 5").select("content_hash").scalar()
    named = lambda rows, how: rows.select(F.lit(how).alias("how"), "feed_id", "title", "url", "status")
    return named(catalog.by_id(a, 5), "id").unionByName(named(catalog.by_content_hash(a, digest), "content_hash"))


def recent_articles(spark, sf):
    return catalog.recent(t.articles(spark, sf), 5).select("id", "feed_id", "url", "title", "status")


def articles_to_parse(spark, sf):
    return catalog.with_status(t.articles(spark, sf), "fetched").select("id", "url", "s3_uri", _day("fetched_at"))


def oldest_fetched(spark, sf):
    """FIFO batch: the oldest fetched articles first."""
    return catalog.with_status(t.articles(spark, sf), "fetched", limit=25).select("id", "url", _day("fetched_at"))


def articles_to_index(spark, sf):
    a = t.articles(spark, sf)
    normal = catalog.to_index(a).select(F.lit(False).alias("rebuild"), "id", "silver_s3_uri")
    again = catalog.to_index(a, rebuild=True).select(F.lit(True).alias("rebuild"), "id", "silver_s3_uri")
    return normal.unionByName(again)


def articles_to_embed(spark, sf):
    a = t.articles(spark, sf)
    normal = catalog.to_embed(a).select(F.lit(False).alias("rebuild"), "id", "silver_s3_uri")
    again = catalog.to_embed(a, rebuild=True).select(F.lit(True).alias("rebuild"), "id", "silver_s3_uri")
    return normal.unionByName(again)


def read_silver(spark, sf):
    """Read requests for every labelled document, by hash or, if toxic, by object."""
    wanted = t.read(spark, sf, "labels").join(t._keyed(t.read(spark, sf, "documents")), "doc_id")
    requests = wanted.select(
        F.col("doc_id").alias("request_id"),
        F.when(F.col("toxic") == 0, F.col("content_hash")).alias("content_hash"),
        F.when(F.col("toxic") == 1, t._uri("bronze")).alias("silver_s3_uri"),
    )
    return catalog.read_silver(requests, t.articles(spark, sf), t.silver(spark, sf))


def feed_language(spark, sf):
    resolved = catalog.resolve_feed_lang(t.articles(spark, sf), t.registry(spark, sf))
    return resolved.select("id", "feed_id", "feed_lang")


def unique_violations(spark, sf):
    known = lake.identified(t.entries(spark, sf), _now())
    urls = dedup.duplicate_keys(known, ["link"]).select(F.lit("url").alias("rule"), F.col("link").alias("value"), "n")
    items = dedup.duplicate_keys(known, ["feed_id", "item_key"]).select(
        F.lit("feed_item").alias("rule"), F.concat_ws(":", "feed_id", "item_key").alias("value"), "n"
    )
    return urls.unionByName(items)


def status_transition(spark, sf):
    """Parse the fetched, index the parsed, embed the indexed, each where its label allows."""
    a, labels = t.articles(spark, sf), t.read(spark, sf, "labels")
    marks = labels.select(
        F.concat(F.lit("https://x.example/"), "doc_id").alias("url"), "quality", "toxic"
    )
    run = _now()
    parsed = catalog.advance(a, marks.filter("quality = 1"), "parsed", run)
    indexed = catalog.advance(parsed, marks.filter("toxic = 0"), "indexed", run)
    embedded = catalog.advance(indexed, marks.filter("quality = 1 and toxic = 0"), "embedded", run)
    return embedded.select("id", "status", _day("updated_at"))


def status_reparse(spark, sf):
    """A replay moves every labelled article back to parsed, whatever its status."""
    marks = t.read(spark, sf, "labels").select(
        F.concat(F.lit("https://x.example/"), "doc_id").alias("url"),
        F.concat(F.lit("s3://lake/silver/"), "doc_id").alias("silver_s3_uri"),
    )
    moved = catalog.advance(
        t.articles(spark, sf), marks, "parsed", _now(), reparse=True, carry=("silver_s3_uri",)
    )
    return moved.select("id", "status", "silver_s3_uri", _day("updated_at"))


# --- de-duplication -----------------------------------------------------------


def _seen(spark, sf) -> DataFrame:
    known = lake.identified(t.entries(spark, sf), _now())
    return known.join(t.read(spark, sf, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("seen_key")


def dedup_first_seen(spark, sf):
    """New entries of a poll: the first of every key the toxic documents did not use."""
    known = lake.identified(t.entries(spark, sf), _now())
    fresh = dedup.unseen(known, _seen(spark, sf), ["seen_key"], F.col("doc_id"))
    return fresh.select("doc_id", "feed_id", "seen_key", "content_hash")


def insert_if_absent(spark, sf):
    """Insert by url into a catalog that holds the urls of the toxic documents."""
    known = t.entries(spark, sf).withColumnRenamed("link", "url")
    present = known.join(t.read(spark, sf, "labels").filter("toxic = 1"), "doc_id", "left_semi")
    return dedup.insert_if_absent(present, known, ["url"], F.col("doc_id")).select(
        "doc_id", "feed_id", "url", "inserted"
    )


def latest_versions(spark, sf):
    """Overwrite by id: the last event of every user is the one kept."""
    events = t.read(spark, sf, "events")
    last = dedup.latest_per_key(events, ["user_id"], F.struct("ts", "event_id"))
    return last.select("user_id", "event_id", "event_type", "value")


def chunk_replacement(spark, sf):
    """Re-chunking the labelled documents with small windows replaces all their chunks."""
    silver = t.silver(spark, sf)
    old = chunking.silver_chunks(silver)
    again = silver.join(t.read(spark, sf, "labels"), "doc_id", "left_semi").drop("doc_id")
    new = chunking.silver_chunks(again, size=2000, overlap=100)
    merged = dedup.replace_groups(old, new, "content_hash")
    return merged.groupBy("content_hash").agg(
        F.count("*").alias("n_chunks"), F.max("char_end").cast("long").alias("last_char")
    )


# --- operations ---------------------------------------------------------------


def worker_stats(spark, sf):
    return ops.worker_stats(t.worker_runs(spark, sf))


def ops_status(spark, sf):
    return ops.ops_status(t.articles(spark, sf), _now()).withColumn(
        "last_write_at", F.date_format("last_write_at", "yyyy-MM-dd HH:mm:ss")
    )


def gauges_long(spark, sf):
    return ops.gauges(t.articles(spark, sf), t.worker_runs(spark, sf), _now())


# --- contracts ----------------------------------------------------------------


def _parts(**columns: Column) -> list[Column]:
    """``"name":value`` JSON fragments; a null column is written as null."""
    whole = [F.to_json(F.struct(c.alias(n)), lake.KEEP_NULLS) for n, c in columns.items()]
    return [F.substr(w, F.lit(2), F.length(w) - 2) for w in whole]


def mutated_silver(spark, sf) -> DataFrame:
    """Silver JSON with faults that follow from the document and its label."""
    d = t._keyed(t.text_table(spark, sf)).join(t.read(spark, sf, "labels"), "doc_id", "left")
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    lang = F.col("lang")
    version, digest, title, url, at, body, source, uri, feed_lang, content_lang, conf, extra = _parts(
        schema_version=F.when(low, 2).otherwise(1),
        content_hash=F.when(lang == "de", F.upper("content_hash")).otherwise(F.col("content_hash")),
        title=F.when(lang != "es", F.col("title")),
        canonical_url=F.lit(None).cast("string"),
        parsed_at=F.col("dt"),
        text=F.when(F.col("n_chars") < 200, "").otherwise(F.col("text")),
        text_source=F.when(F.col("quality") == 1, F.col("source")).otherwise("permalink"),
        bronze_s3_uri=F.when(toxic, F.lit("http://x")).otherwise(t._uri("bronze")),
        feed_lang=lang,
        content_lang=F.when(F.col("n_chars") > 5000, F.col("source")).otherwise(lang),
        content_lang_confidence=F.floor(F.col("n_chars") / 1000).cast("long"),
        note=F.lit("x"),
    )
    feed = _parts(feed_id=F.col("source"))[0]
    fields = F.array(
        version, feed, digest, F.when((lang != "fr") | F.col("quality").isNull(), title), url, at, body,
        source, uri, F.when(~F.coalesce(toxic, F.lit(False)), feed_lang), content_lang, conf,
        F.when(F.col("quality").isNull(), extra),
    )
    return d.select(
        "doc_id", F.concat(F.lit("{"), F.array_join(F.array_compact(fields), ","), F.lit("}")).alias("raw_json")
    )


def contract_violations(spark, sf):
    checked = contracts.validate(mutated_silver(spark, sf), "silver")
    return checked.select("doc_id", F.col("n_errors").cast("long").alias("n_errors"), "report")


def contract_error_counts(spark, sf):
    """How often each field breaks the contract."""
    errors = mutated_silver(spark, sf).select(F.explode(rules.violations("raw_json", "silver")).alias("e"))
    return errors.groupBy(F.col("e.path").alias("path")).agg(F.count("*").alias("n"))


def contract_audit(spark, sf):
    """Valid and invalid objects per layer, over bronze, silver and gold."""
    known = lake.identified(t.entries(spark, sf), _now())
    bronze = known.select("doc_id", lake.bronze_json(known, F.lit(NOW)).alias("raw_json"))
    silver = mutated_silver(spark, sf)
    gold_ = t.silver(spark, sf).select(
        "doc_id", F.to_json(F.struct("dt", *lake.SILVER_FIELDS), lake.KEEP_NULLS).alias("raw_json")
    )
    checked = contracts.validate(bronze, "bronze").unionByName(
        contracts.validate(silver, "silver")
    ).unionByName(contracts.validate(gold_, "gold"))
    return contracts.audit_totals(checked)


def lake_audit(spark, sf):
    """Audit of every parsed and fetched article's objects."""
    rows = t.silver(spark, sf)
    silver = rows.select(F.col("silver_s3_uri").alias("uri"), lake.silver_json().alias("raw_json"))
    known = lake.identified(
        t.entries(spark, sf).withColumns({"id": F.concat(F.lit("doc-"), "doc_id")}), _now()
    )
    bronze = known.filter("lang <> 'es'").select(
        keys.object_uri(t.BUCKET, keys.object_key("bronze", F.col("feed_id"), F.col("dt"), F.col("content_hash"))).alias("uri"),
        lake.bronze_json(known, F.lit(NOW)).alias("raw_json"),
    )
    return contracts.audit_totals(contracts.audit_lake(t.articles(spark, sf), bronze, silver, limit=None))


def audit_sample(spark, sf):
    return contracts.lake_sample(t.articles(spark, sf), limit=300).select("id", "status")


# --- gold ---------------------------------------------------------------------


def _silver_objects(spark, sf) -> DataFrame:
    """Silver JSON by path: some without feed or text, some blank, some broken."""
    rows = t.silver(spark, sf)
    body = (
        F.when(F.col("feed_id") == "src3", "  \n")
        .when(F.col("feed_id") == "src4", F.concat(F.lit("{"), "text"))
        .when(
            F.col("feed_id") == "src5",
            F.to_json(F.struct("content_hash", F.lit("").alias("text"), "feed_id")),
        )
        .when(
            F.col("content_lang") == "es",
            F.to_json(F.struct("content_hash", "text", "feed_id", "title", F.lit("2020-02-02").alias("dt"))),
        )
        .otherwise(lake.silver_json())
    )
    return rows.select(F.col("silver_s3_uri").alias("path"), F.explode(F.array(body)).alias("raw_json"))


def gold_projection(spark, sf):
    rows = gold.gold_rows(_silver_objects(spark, sf))
    return rows.select(
        "content_hash", "feed_id", "dt", "title", "content_lang", F.length("text").cast("long").alias("n_chars")
    )


def gold_partition_counts(spark, sf):
    return gold.partition_counts(gold.gold_rows(_silver_objects(spark, sf)))


def gold_write_read(spark, sf):
    """Gold written by partition, read back, and counted per partition."""
    folder = shared_folder(spark, "gold")
    gold.write_gold(gold.gold_rows(_silver_objects(spark, sf)), folder)
    return gold.partition_counts(gold.read_gold(spark, folder))


def layer_written(spark, sf):
    """Bronze objects written by source and day, twice under one name, and read back by their paths."""
    known = lake.identified(t.entries(spark, sf), _now())
    rows, folder = known.withColumn("raw_json", lake.bronze_json(known, F.lit(NOW))), shared_folder(spark, "layer")
    for _ in range(2):
        lake.write_layer(rows, "bronze", folder, "bronze")
    back = lake.read_layer(spark, folder)
    return back.groupBy(keys.path_value(F.col("path"), "source").alias("source"), keys.path_value(F.col("path"), "dt").alias("dt")).agg(
        F.count("*").alias("n"), F.countDistinct(F.get_json_object("raw_json", "$.content_hash")).alias("n_hashes")
    )


# --- bus ----------------------------------------------------------------------


def _bus(spark, sf) -> DataFrame:
    """A message per event about an article, in turn; other events are among them."""
    n = max(1, t.read(spark, sf, "documents").count())
    events = t.read(spark, sf, "events").select("event_id", "event_type", (F.col("event_id") % n).alias("id"))
    a = events.join(t.articles(spark, sf), "id", "left").withColumn("id", F.col("event_id"))
    value = (
        F.when(F.col("event_type") == "error", F.lit("[1, 2]"))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.lit("article.removed").alias("event"), "url")))
    )
    return a.withColumn("_other", value).select(
        "id", F.col("feed_id").alias("key"),
        F.coalesce(
            "_other",
            F.to_json(
                F.struct(
                    F.lit("article.ingested").alias("event"), "feed_id",
                    F.when(F.col("event_type") != "signup", F.col("url")).alias("url"),
                    "s3_uri", "content_hash", "item_key", F.coalesce("feed_lang", F.lit("")).alias("feed_lang"),
                )
            ),
        ).alias("value"),
    )


def event_rows(spark, sf):
    return bus.ingested_events(_bus(spark, sf)).select(
        "id", "feed_id", "url", "s3_uri", "content_hash", "title", "feed_lang", "error"
    )


def event_error_counts(spark, sf):
    """Skip-bad-row counts: usable and rejected events per feed."""
    return bus.ingested_events(_bus(spark, sf)).groupBy("feed_id").agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


def bus_messages(spark, sf):
    return bus.messages(t.articles(spark, sf))


# --- text ---------------------------------------------------------------------


def html_text(spark, sf):
    return t.text_table(spark, sf, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))


def _landed(spark, sf) -> DataFrame:
    """Entries whose guid two documents share, within a feed or across feeds."""
    none = F.lit(None).cast("string")
    return t.read(spark, sf, "documents").select(
        F.col("source").alias("feed_id"), F.col("doc_id").cast("int").alias("position"),
        F.concat(F.lit("t "), "doc_id").alias("title"), F.concat(F.lit("https://x.example/"), "doc_id").alias("link"),
        F.concat(F.lit("id-"), F.floor(F.col("doc_id") / 2).cast("string")).alias("id"), none.alias("guid"),
        F.col("text").alias("summary"), none.alias("published"), none.alias("updated"), none.alias("author"),
        F.array().cast("array<string>").alias("tags"),
    )


def _stage_tables(home: stages.Lake) -> DataFrame:
    """Per article: status, and how often each store holds its object, event and documents."""
    def per(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.groupBy(F.col(key)).agg(F.count("*").alias(name))

    a = home.articles.current().select("url", "feed_id", "status", "content_hash", F.col("s3_uri").alias("uri"))
    sent = bus.ingested_events(bus.read_messages(home.spark, home.bus))
    chunks, held = home.chunk_vectors(), home.index().lists.filter("field = ''")
    doubled = chunks.groupBy("content_hash").agg(
        (F.count("*") - F.countDistinct("chunk_id")).alias("doubled_chunks"), (F.count("*") > 0).alias("chunked")
    )
    silver = per(home.silver.current().withColumn("uri", F.replace("uri", F.lit("/silver/"), F.lit("/bronze/"))), "uri", "silver")
    return (
        a.join(per(home.bronze.versions(), "uri", "bronze"), "uri", "left").join(silver, "uri", "left")
        .join(per(sent, "url", "events"), "url", "left")
        .join(per(home.lexical_documents.current(), "content_hash", "lexical"), "content_hash", "left")
        .join(per(held.select(F.explode("hashes").alias("content_hash")), "content_hash", "indexed"), "content_hash", "left")
        .join(doubled, "content_hash", "left")
        .select("url", "feed_id", "status", "bronze", "silver", "events", "lexical", "indexed", "doubled_chunks", "chunked")
    )


def _home(spark, sf, name: str) -> stages.Lake:
    return stages.Lake(spark, shared_folder(spark, name), t.registry(spark, sf), langid.train(t.text_table(spark, sf)))


def stages_run(spark, sf):
    """All stages over the documents as landed entries, run twice; the second adds nothing."""
    home, pages = _home(spark, sf, "stages"), t.read(spark, sf, "pages")
    for _ in range(2):
        stages.run_stages(home, datetime(2024, 2, 1), _landed(spark, sf), pages)
    return _stage_tables(home)


def stages_resumed(spark, sf):
    """An ingest that stops before it publishes and marks entries seen, then all stages from the bus."""
    home, pages = _home(spark, sf, "stages"), t.read(spark, sf, "pages")
    now = datetime(2024, 2, 1)
    stages.collect_entries(home, _landed(spark, sf), now)
    stages.run_stages(home, now, _landed(spark, sf), pages, from_bus=True)
    return _stage_tables(home)


def html_marks(spark, sf):
    """Documents in pages of their own, with entities of every kind and classes in every quoting."""
    drop = ['<div class="ad banner">x</div>', "<DIV id=a class='wide ads'>x</DIV>", "<div class=share>x</div>"]
    keep = '<div class="adverb">kept &OUML; &ouml;&szlig;&times;&bull;&deg; &#233;&#xE9;&#1114109;&#0; &amp;lt;</div>'
    body = F.regexp_replace(F.regexp_replace("text", r"[^\p{L}\n]+", " "), r"\n+", "</p><p>")
    html = F.concat(F.lit("<article>" + "".join(drop) + keep + "<p>"), body, F.lit("</p></article>"))
    return t.text_table(spark, sf).select("doc_id", F.md5(text.html_text(html)).alias("digest"))


def html_nested(spark, sf):
    """Documents among dropped elements that hold others of their name, as deep as the id says."""
    deep = (F.col("doc_id") % 7 + 1).cast("int")
    inner = F.concat(
        F.repeat(F.lit('<div class="share"><DIV>'), deep), F.lit("x"), F.repeat(F.lit("</div>LEFT</DIV>"), deep),
        F.lit("<table><tr><td>"), F.repeat(F.lit("<table><tr><td>a</td></tr>"), deep), F.repeat(F.lit("</table>CELL"), deep), F.lit("</table>"),
    )
    drop = F.concat(F.lit('<div class="ad">ad<div>y</div>LEFT<nav>n</nav>'), inner, F.lit("</div><aside>a<aside/><aside>b</aside>LEFT</aside>"))
    body = F.regexp_replace(F.regexp_replace("text", r"[^\p{L}\n]+", " "), r"\n+", "</p><p>")
    links = '<ul><li><a href="/a">One</a></li><li>- <A href=/b>Two <b>words</b></a></li></ul><p>see <a href="/c">all</a> of it here</p>'
    html = F.concat(
        F.lit("<body>"), F.when(F.col("doc_id") % 3 != 0, F.lit("<article>")).otherwise(""), drop,
        F.lit('<div class="wrap"><div>kept</div>'), inner, F.lit("also kept</div><p>"), body, F.lit("</p>" + links),
        F.when(F.col("doc_id") % 3 != 0, F.lit("</article><p>beside</p>")).otherwise(F.lit("<form>open")),
    )
    return t.text_table(spark, sf).select("doc_id", F.md5(text.html_text(html)).alias("digest"))


def _cascade_entries(spark, sf) -> DataFrame:
    """Entries that link to the page of equal number; only English ones have a summary."""
    d = t.text_table(spark, sf)
    pages = t.read(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return d.join(pages, "doc_id", "left").select(
        "doc_id", F.col("url").alias("link"),
        F.when(F.col("lang") != "es", F.regexp_extract("text", r"^[^.\n]*", 0)).alias("title"),
        F.when(F.col("lang") == "en", F.concat(F.lit("<p>"), "text", F.lit("</p>"))).alias("summary"),
    )


def text_source_cascade(spark, sf):
    found = extraction.article_text(_cascade_entries(spark, sf), t.text_table(spark, sf, "pages"))
    return found.select("doc_id", "text_source", "error", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n_chars"))


def lang_profiles(spark, sf):
    table = langid.profile_table(t.text_table(spark, sf))
    return table.select("lang", F.col("place").cast("long").alias("place"), "n", F.round("log_weight", 6).alias("log_weight"))


def lang_detect(spark, sf):
    docs = t.text_table(spark, sf)
    model = langid.train(docs)
    title = F.regexp_extract("text", r"^[^.\n]*", 0)
    return langid.detect(docs, model, title, F.col("text"), F.lit("und")).select(
        "doc_id", "content_lang", "confidence"
    )


def chunk_documents(spark, sf):
    chunks = t.chunks(spark, sf)
    return chunks.select(
        "chunk_id", "content_hash", F.col("chunk_index").cast("long").alias("chunk_index"),
        F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"),
        "feed_id", "content_lang", "text",
    )


def published_dates(spark, sf):
    """RFC 822 and ISO dates written from the catalog's times, and read back."""
    a = t.articles(spark, sf)
    rfc = F.concat(F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    iso = F.concat(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    given = F.when(F.col("status") == "fetched", "soon").when(F.col("status") == "parsed", iso).otherwise(rfc)
    parsed = F.to_utc_timestamp(keys.published_timestamp(given), F.current_timezone())
    return a.select("id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("published_at"))


def landed_feeds(spark, sf):
    """Feed files holding one document each, read back as entries."""
    d = t.text_table(spark, sf)

    def element(name: str, value: Column) -> Column:
        safe = value
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            safe = F.replace(safe, F.lit(char), F.lit(entity))
        return F.concat(F.lit(f"<{name}>"), safe, F.lit(f"</{name}>"))

    item = F.concat(
        element("title", F.col("lang")), element("link", F.concat(F.lit("https://x.example/"), "doc_id")),
        element("guid", F.col("doc_id").cast("string")), element("description", F.col("text")),
    )
    xml = F.concat(F.lit("<rss><channel><item>"), item, F.lit("</item></channel></rss>"))
    entries = feeds.landed_entries(d.select(F.col("source").alias("feed_id"), xml.alias("xml")))
    return entries.select("feed_id", "title", "link", "guid", F.md5("summary").alias("digest"))


def feed_dialects(spark, sf):
    """Documents landed as items of RSS, RDF and Atom in turn, with the elements each has; one parse of every file."""
    d = t.text_table(spark, sf).select("doc_id", "source", "lang", F.md5("text").alias("body"))
    link, about = F.concat(F.lit("https://x.example/"), "doc_id"), F.concat(F.lit("urn:doc:"), "doc_id")

    def of(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) and p.startswith(("<", '"')) else F.col(p) if isinstance(p, str) else p for p in parts])

    rss = of(
        '<rss xmlns:dc="d" xmlns:content="c"><channel><title>t</title><item><title>', "lang", "</title><link> ", link, "</link><content:encoded>", "body",
        "</content:encoded><dc:creator>", "source", "</dc:creator><category>a</category><category>b</category></item></channel></rss>",
    )
    rdf = of(
        '<rdf:RDF xmlns:rdf="r" xmlns="http://purl.org/rss/1.0/" xmlns:dc="d"><channel><title>t</title></channel><item rdf:about="', about, '"><title>', "lang",
        "</title><link>", link, "</link><description>", "body", "</description><dc:date>2024-01-02</dc:date><dc:creator>", "source",
        "</dc:creator><dc:subject>s</dc:subject></item></rdf:RDF>",
    )
    atom = of(
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>', "lang", '</title><id>', about, '</id><link rel="self" href="no"/><link href="', link,
        '"/><summary>', "body", "</summary><updated>2024-01-02</updated><author><name>", "source", '</name></author><category term="s"/></entry></feed>',
    )
    kind = F.col("doc_id") % 3
    entries = feeds.landed_entries(d.select(F.col("source").alias("feed_id"), F.when(kind == 0, rss).when(kind == 1, rdf).otherwise(atom).alias("xml")))
    return entries.select("feed_id", "title", "link", "id", "summary", "updated", "author", F.array_join("tags.term", ",").alias("terms"))


def silver_build(spark, sf):
    """Silver rows of articles whose bronze summary may be missing: text, source, language."""
    cascade = _cascade_entries(spark, sf).withColumns(
        {c: F.lit(None).cast("string") for c in ("id", "guid", "published", "updated", "author")}
    )
    a = t.articles(spark, sf).select(
        F.col("id").alias("doc_id"), "url", "s3_uri", "feed_id", "content_hash", "feed_lang",
        F.lit(None).cast("string").alias("catalog_title"),
    )
    rows = cascade.join(a.withColumn("item_key", F.col("content_hash")), "doc_id")
    bronze = rows.select(F.col("s3_uri").alias("uri"), lake.bronze_json(rows, F.lit(NOW)).alias("raw_json"))
    articles = a.select("url", "s3_uri", "feed_id", "content_hash", "feed_lang", F.col("catalog_title").alias("title"))
    model = langid.train(t.text_table(spark, sf))
    built = stages.silver_rows(
        articles, bronze, t.text_table(spark, sf, "pages"), t.registry(spark, sf), model, F.lit(NOW).cast("timestamp")
    )
    return built.select(
        "url", "error", "text_source", F.md5("text").alias("digest"), "feed_lang", "content_lang",
        "content_lang_confidence", "dt", "silver_s3_uri",
    )


# --- lexical ------------------------------------------------------------------


def lexical_query_rewrite(spark, sf):
    turns = t.read(spark, sf, "conversations")
    return turns.select("conv_id", "turn", text.lexical_query(F.col("text")).alias("lexical_query"))


def lexical_documents(spark, sf):
    docs = t.lexical_docs(spark, sf)
    return docs.select(
        "content_hash", "feed_lang", "content_lang", "title", "title_fr", "title_en", "canonical_url",
        "author", F.length("text_fr").cast("long").alias("n_fr"), F.length("text_en").cast("long").alias("n_en"),
    )


def term_stats(spark, sf):
    fields = lexical.search_fields(t.lexical_docs(spark, sf), None)
    return lexical.term_stats(lexical.postings(lexical.field_terms(fields)))


def field_stats(spark, sf):
    tokens = lexical.field_terms(lexical.search_fields(t.lexical_docs(spark, sf), None))
    return lexical.field_stats(tokens).withColumn("avg_dl", F.round("avg_dl", 6)).withColumn(
        "n_tokens", F.col("n_tokens").cast("long")
    )


def _ranked(df: DataFrame, key: str) -> DataFrame:
    return df.select("query_id", F.col("rank").cast("long").alias("rank"), key, "score")


def bm25_topk(spark, sf):
    """Top articles of every question: all its words, title counted twice."""
    found = lexical.search(t.questions(spark, sf), t.lexical_docs(spark, sf), DEPTH)
    return _ranked(found, "content_hash")


def bm25_topk_lang(spark, sf):
    """The same within French and within English articles, each with its stop words and stems."""
    asked, docs = t.questions(spark, sf), t.lexical_docs(spark, sf)
    found = [
        lexical.search(asked, docs, DEPTH, lang=lang).withColumn("lang", F.lit(lang)) for lang in ANALYZED_LANGS
    ]
    return found[0].unionByName(found[1]).select("query_id", "lang", F.col("rank").cast("long").alias("rank"), "content_hash", "score")


def bm25_index_topk(spark, sf):
    """The same as ``bm25_topk`` from an index written to storage, of which only blocks that matter are read."""
    index = lexical_index.LexicalIndex.write(t.lexical_docs(spark, sf), shared_folder(spark, "lexical"))
    return _ranked(lexical_index.search_index(t.questions(spark, sf), index, DEPTH), "content_hash")


def bm25_index_updated(spark, sf):
    """The same from an index of other texts, some missing and some to be removed, that was then updated."""
    docs = t.lexical_docs(spark, sf)
    number = F.regexp_extract("canonical_url", "[0-9]+$", 0).cast("long")
    stale = docs.withColumn("text", F.when(number % 3 == 0, F.concat(F.lit("older words and "), F.reverse("text"))).otherwise(F.col("text")))
    extra = docs.filter(number % 5 == 0).withColumn("content_hash", F.concat(F.lit("gone-"), "content_hash"))
    index = lexical_index.LexicalIndex.write(
        stale.filter(number % 7 != 0).unionByName(extra), shared_folder(spark, "lexical"), blocks=16
    )
    index.update(docs.filter((number % 3 == 0) | (number % 7 == 0)), removed=extra.select("content_hash"))
    return _ranked(lexical_index.search_index(t.questions(spark, sf), index, DEPTH), "content_hash")


def lexical_branch(spark, sf):
    """Rewritten questions, their hits, and a snippet around a matched term."""
    docs, asked = t.lexical_docs(spark, sf), t.questions(spark, sf)
    found = lexical.search(asked, docs, DEPTH, rewrite=True)
    hits = lexical.with_hits(found, docs, asked, rewrite=True)
    return hits.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "content_hash", "score", "feed_id",
        "title", "content_lang", "snippet",
    )


def snippets(spark, sf):
    """Plain one-line snippets of every page's HTML."""
    pages = t.text_table(spark, sf, "pages")
    return pages.select("page_id", text.clean_snippet(text.html_text(F.col("html"))).alias("snippet"))


# --- vectors ------------------------------------------------------------------


def encoded_questions(spark, sf):
    """Non-zero components of every question's vector."""
    vectors = encode.encode(t.questions(spark, sf), "question")
    return vectors.select("query_id", F.posexplode("embedding").alias("pos", "x")).filter("x <> 0").select(
        "query_id", F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x")
    )


def centroid_topk(spark, sf):
    """The nearest vectors to the mean of every label."""
    vectors = t.read(spark, sf, "embeddings")
    found = vector.cosine_top_k(vector.label_centroids(vectors), spread(vectors), DEPTH, key="vec_id")
    return _ranked(found, "vec_id")


def cosine_topk(spark, sf):
    """The nearest chunks to every question."""
    wanted = encode.encode(t.questions(spark, sf), "question")
    return _ranked(vector.cosine_top_k(wanted, t.chunk_vectors(spark, sf), DEPTH), "chunk_id")


def vector_index_topk(spark, sf):
    """The nearest chunks to every question among vectors that were stored with their texts."""
    wanted = encode.encode(t.questions(spark, sf), "question")
    stored = t.stored_chunks(spark, sf)
    return vector.with_payload(vector.cosine_top_k(wanted, stored, DEPTH), stored).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "chunk_id", "score", F.md5("text").alias("digest")
    )


def vector_cells_topk(spark, sf):
    """The same from vectors stored by cell, of which only cells that may matter are read."""
    wanted = encode.encode(t.questions(spark, sf), "question")
    index = vector_index.VectorIndex.write(encode.encode(t.chunks(spark, sf)), shared_folder(spark, "vectors"))
    return vector.with_payload(vector_index.cosine_top_k(wanted, index, DEPTH), index.vectors).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "chunk_id", "score", F.md5("text").alias("digest")
    )


def cosine_topk_lang(spark, sf):
    wanted = encode.encode(t.questions(spark, sf), "question")
    return _ranked(vector.cosine_top_k(wanted, t.chunk_vectors(spark, sf), DEPTH, lang="de"), "chunk_id")


def vector_dimensions(spark, sf):
    given = encode.dimension_report(t.read(spark, sf, "embeddings")).withColumn("origin", F.lit("given"))
    own = encode.dimension_report(t.chunk_vectors(spark, sf)).withColumn("origin", F.lit("encoded"))
    return given.unionByName(own).select("origin", F.col("dims").cast("long").alias("dims"), "n")


# --- hybrid -------------------------------------------------------------------


def _branches(spark, sf) -> DataFrame:
    docs, asked = t.lexical_docs(spark, sf), t.questions(spark, sf)
    found = lexical.with_hits(lexical.search(asked, docs, DEPTH, rewrite=True), docs, asked, rewrite=True)
    near = vector.cosine_top_k(encode.encode(asked, "question"), t.chunk_vectors(spark, sf), DEPTH)
    return fusion.lexical_passages(found).unionByName(
        fusion.vector_passages(vector.with_payload(near, t.chunks(spark, sf)))
    )


def _passages(spark, sf, **settings) -> DataFrame:
    chosen = RetrievalSettings(**settings)
    vectors = t.stored_chunks(spark, sf) if chosen.vector else t.chunk_vectors(spark, sf)
    return fusion.hybrid_retrieve(t.questions(spark, sf), t.lexical_docs(spark, sf), vectors, chosen)


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "content_hash",
        F.col("chunk_index").cast("long").alias("chunk_index"), "sources", "score",
        "lexical_score", "vector_score", "text",
    )


def rrf_fusion(spark, sf):
    return _shown(fusion.fuse(_branches(spark, sf), limit=20))


def rrf_merged(spark, sf):
    """Fusion of the nearest chunks of all languages and of one, which have passages in common."""
    wanted, stored = encode.encode(t.questions(spark, sf), "question"), t.stored_chunks(spark, sf)

    def near(lang: str | None) -> DataFrame:
        found = vector.cosine_top_k(wanted, stored, DEPTH, lang=lang)
        return fusion.vector_passages(vector.with_payload(found, stored))

    german = near("de").withColumns({"list": F.lit(2), "source": F.lit("german")})
    return _shown(fusion.fuse(near(None).unionByName(german), limit=20))


def relevance_gate(spark, sf):
    return _shown(fusion.relevant(fusion.fuse(_branches(spark, sf), limit=20), 0.3))


def hybrid_retrieve(spark, sf):
    return _shown(_passages(spark, sf, top_k=10, min_vector_score=0.2))


def vector_only_retrieve(spark, sf):
    return _shown(_passages(spark, sf, top_k=10, min_vector_score=0.0, lexical=False))


def lexical_only_retrieve(spark, sf):
    return _shown(_passages(spark, sf, top_k=10, vector=False))


def search_response(spark, sf):
    rows = fusion.search_response(_passages(spark, sf, top_k=5, min_vector_score=0.0))
    return rows.withColumn("rank", F.col("rank").cast("long")).withColumn(
        "chunk_index", F.col("chunk_index").cast("long")
    )


def citations(spark, sf):
    """Passage key and label of every chunk."""
    chunks = t.chunks(spark, sf)
    return chunks.select(
        fusion.passage_key().alias("passage_key"),
        fusion.citation_label(F.col("title"), F.col("chunk_index")).alias("label"),
    )


# --- answers and evaluation ---------------------------------------------------


def prompt_assembly(spark, sf):
    return answers.prompts(t.questions(spark, sf), _passages(spark, sf, top_k=4, min_vector_score=0.0)).select(
        "query_id", "user_message"
    )


def sources_footer(spark, sf):
    texts = answers.passage_texts(_passages(spark, sf, top_k=4, min_vector_score=0.0))
    return texts.select("query_id", "n_passages", "footer")


def answer_routing(spark, sf):
    """Retrieve-only answers under a gate strict enough to refuse some questions."""
    asked = t.questions(spark, sf)
    found = _passages(spark, sf, top_k=4, lexical=False, min_vector_score=0.3)
    return answers.route_answers(asked, found, retrieve_only=True).select(
        "query_id", "n_passages", "refused", "answer"
    )


def _scores(spark, sf) -> DataFrame:
    found = _passages(spark, sf, top_k=4, lexical=False, min_vector_score=0.3)
    routed = answers.route_answers(t.questions(spark, sf), found, t.generated_answers(spark, sf))
    return evaluation.score_cases(t.eval_cases(spark, sf), routed, retrieve_only=False)


def case_scores(spark, sf):
    return _scores(spark, sf)


def eval_summary(spark, sf):
    return evaluation.eval_summary(_scores(spark, sf))


def recall_report(spark, sf):
    def retrieve(_):
        return _passages(spark, sf, top_k=TOP_K_DEFAULT, lexical=False, min_vector_score=0.3)

    report, _ = evaluation.evaluate_recall(
        t.eval_cases(spark, sf), retrieve, model="hashing", vector_size=EMBEDDING_DIMS,
        k=TOP_K_DEFAULT, eval_set="benchmark",
    )
    return report.withColumn("recall_at_k", F.round("recall_at_k", 6)).withColumns(
        {c: F.col(c).cast("long") for c in ("vector_size", "k")}
    )


def recall_cases(spark, sf):
    found = _passages(spark, sf, top_k=TOP_K_DEFAULT, lexical=False, min_vector_score=0.3)
    return evaluation.case_hits(t.eval_cases(spark, sf), found)


def baseline_check(spark, sf):
    """Two recall reports over stored cases against the registered baseline, which one of them is."""
    folder, params = shared_folder(spark, "baseline"), evalset.embed_params({"top_k": TOP_K_DEFAULT})
    t.eval_cases(spark, sf).write.json(f"{folder}/cases")
    cases = evalset.read_eval_cases(spark, f"{folder}/cases")
    found = written(
        _passages(spark, sf, top_k=params["top_k"], lexical=False, min_vector_score=0.3)
        .select(F.col("query_id").cast("string").alias("query_id"), "vector_score"), "found",
    )
    for gate in (0.3, 0.5):
        report, _ = evaluation.evaluate_recall(
            cases, lambda _, gate=gate: found.filter(F.col("vector_score") >= gate), model=f"{params['model']} {gate}",
            vector_size=params["vector_size"], k=params["top_k"], eval_set="benchmark",
        )
        evalset.write_report(report, f"{folder}/reports/gate={gate}")
    reports = spark.read.json(f"{folder}/reports")
    evalset.register(reports.filter("gate = 0.5"), f"{folder}/registry", "2024-01-01")
    evalset.register(reports.filter("gate = 0.3"), f"{folder}/registry", "2024-01-02")
    judged = evaluation.against_baseline(reports, evalset.read_registry(spark, f"{folder}/registry"))
    return judged.withColumns({c: F.round(c, 6) for c in ("recall_at_k", "baseline_recall")})


def last_user_message(spark, sf):
    return answers.last_user_message(t.read(spark, sf, "conversations"))


def answer_citations(spark, sf):
    """Which generated answers cite a passage."""
    turns = t.read(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return turns.select("conv_id", "turn", evaluation.has_citation(F.col("text")).alias("has_citation"))


# --- streaming ----------------------------------------------------------------


def _documents_stream(spark, sf) -> DataFrame:
    schema = t.read(spark, sf, "documents").schema
    return streams.stream_table(spark, sf, "documents", schema)


def stream_dedup(spark, sf):
    """First-seen keys of the document stream; which copy arrives first is not fixed."""
    folder = shared_folder(spark, "stream-dedup")
    keyed = _documents_stream(spark, sf).select(
        F.concat_ws(":", "source", F.sha2("text", 256)).alias("seen_key")
    )
    streams.drain(streams.first_seen_keys(keyed, "seen_key"), f"{folder}/checkpoint", path=f"{folder}/out")
    return spark.read.schema(keyed.schema).parquet(f"{folder}/out")


def stream_upsert(spark, sf):
    """Insert-if-absent by url as a stream sink, drained twice: the second adds nothing."""
    folder = shared_folder(spark, "stream-upsert")
    schema = "url string, doc_id long, feed_id string"
    target = stores.VersionedTable(spark, f"{folder}/articles", struct(schema), ("url",))
    rows = _documents_stream(spark, sf).select(
        F.concat(F.lit("https://x.example/"), F.sha2("text", 256)).alias("url"), "doc_id",
        F.col("source").alias("feed_id"),
    )
    sink = streams.upsert_batches(target, ["url"], F.col("doc_id"))
    streams.drain(rows, f"{folder}/checkpoint", sink)
    streams.drain(rows, f"{folder}/checkpoint", sink)
    return target.versions().groupBy("url").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))


def stream_replay(spark, sf):
    """Events read by a stream and, from the start again, by a batch: the same rows."""
    folder = shared_folder(spark, "stream-replay")
    schema = t.read(spark, sf, "events").schema
    rows = streams.stream_table(spark, sf, "events", schema).select(
        F.col("event_id").alias("offset"), F.col("event_type").alias("key"), "props"
    )
    streams.drain(rows, f"{folder}/checkpoint", path=f"{folder}/live")
    live = spark.read.parquet(f"{folder}/live").select("offset", "key", F.lit(1).alias("live"))
    again = t.read(spark, sf, "events").select(
        F.col("event_id").alias("offset"), F.col("event_type").alias("key"), F.lit(0).alias("live")
    )
    return live.unionByName(again).groupBy("key").agg(
        F.count_if(F.col("live") == 1).alias("streamed"), F.count_if(F.col("live") == 0).alias("replayed"),
        F.max("offset").alias("last_offset"),
    )


def stream_bus(spark, sf):
    """Ingest events published to storage and consumed as a stream."""
    folder = shared_folder(spark, "stream-bus")
    sent = _bus(spark, sf).select("key", "value", F.col("id").alias("offset"))
    bus.write_messages(sent, f"{folder}/topic")
    events = bus.ingested_events(bus.stream_messages(spark, f"{folder}/topic"))
    streams.drain(events, f"{folder}/checkpoint", path=f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").select(
        F.col("offset").alias("id"), "feed_id", "url", "s3_uri", "content_hash", "title", "feed_lang", "error"
    )


def _reordered(spark, rows: DataFrame, folder: str, files: int = 6) -> DataFrame:
    """A stream over ``rows`` that arrive file by file, dealt to the files by a hash."""
    rows.repartition(files, F.xxhash64("doc_id")).write.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_earliest(spark, sf):
    """Of every text of a feed its earliest document, from a stream in another order."""
    folder = shared_folder(spark, "stream-earliest")
    rows = t.read(spark, sf, "documents").select("doc_id", F.concat_ws(":", "source", F.sha2("text", 256)).alias("seen_key"))
    target = stores.VersionedTable(spark, f"{folder}/updates", struct("seen_key string, doc_id long"), ())
    first = streams.earliest_per_key(_reordered(spark, rows, f"{folder}/in"), "seen_key", "doc_id")
    streams.drain(first, f"{folder}/checkpoint", streams.append_batches(target), mode="update")
    return streams.settled(target.versions(), "seen_key", "doc_id").select("seen_key", "doc_id")


def stream_in_order(spark, sf):
    """Documents numbered per feed, released in that order from a stream in another one."""
    folder = shared_folder(spark, "stream-order")
    rows = joins.numbered_per_key(t.read(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id")
    freed = streams.in_order(_reordered(spark, rows, f"{folder}/in"), "source", "number")
    streams.drain(freed, f"{folder}/checkpoint", path=f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


def stream_run_log(spark, sf):
    """The run log's totals of a stream of bus events that was drained twice; the second time it was empty."""
    folder = shared_folder(spark, "stream-log")
    bus.write_messages(_bus(spark, sf).select("key", "value", F.col("id").alias("offset")).repartition(3), f"{folder}/topic")
    events, runs = bus.ingested_events(bus.stream_messages(spark, f"{folder}/topic", max_files=1)), stores.run_log(spark, folder)
    for hour in (1, 2):
        streams.logged_drain(events, f"{folder}/checkpoint", f"{folder}/out", runs, "parse", datetime(2024, 2, 1, hour, tzinfo=timezone.utc))
    return ops.worker_stats(runs.versions()).select("job", "runs_total", "new_items_total", "errors_total", "last_run_epoch")


def stages_limited(spark, sf):
    """Articles parsed from the bus in runs of limited length, none of whose events is lost."""
    home, pages, now = _home(spark, sf, "stages"), t.read(spark, sf, "pages"), datetime(2024, 2, 1)
    total = stages.ingest(home, _landed(spark, sf), now)
    runs = [sum(streams.parse_events(home, pages, now, limit=limit)) for limit in (total // 2, 1, None)]
    parsed = home.articles.current().groupBy("feed_id").agg(F.count_if(F.col("status") == "parsed").alias("parsed"))
    return parsed.select("feed_id", "parsed", F.lit(runs[0] + runs[1] - total // 2).cast("long").alias("limited"), F.lit(sum(runs)).cast("long").alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        item_identity, uri_parts, bronze_envelope, silver_envelope, chunk_uuid5, detection_input,
        catalog_count, catalog_status_counts, feed_summary, articles_page, recent_articles,
        articles_to_parse, oldest_fetched, articles_to_index, articles_to_embed, read_silver,
        feed_language, unique_violations, status_transition, status_reparse, dedup_first_seen,
        insert_if_absent, latest_versions, chunk_replacement, worker_stats, ops_status, gauges_long,
        contract_violations, contract_error_counts, contract_audit, lake_audit, audit_sample,
        gold_projection, gold_partition_counts, gold_write_read, event_rows, event_error_counts,
        bus_messages, html_text, html_marks, html_nested, text_source_cascade, lang_profiles, lang_detect, chunk_documents,
        lexical_query_rewrite, lexical_documents, term_stats, field_stats, bm25_topk, bm25_topk_lang,
        bm25_index_topk, bm25_index_updated, lexical_branch, snippets, encoded_questions, centroid_topk, cosine_topk,
        cosine_topk_lang, vector_index_topk, vector_cells_topk, vector_dimensions, rrf_fusion, relevance_gate, hybrid_retrieve,
        vector_only_retrieve, lexical_only_retrieve, search_response, citations, prompt_assembly,
        sources_footer, answer_routing, case_scores, eval_summary, recall_report, recall_cases,
        last_user_message, answer_citations, stream_dedup, stream_upsert, stream_replay,
        published_dates, landed_feeds, feed_dialects, silver_build, stream_bus, stages_run, stages_resumed,
        stream_earliest, stream_in_order, stream_run_log, stages_limited, articles_page_total, article_lookups,
        layer_written, rrf_merged, baseline_check,
    )
}
