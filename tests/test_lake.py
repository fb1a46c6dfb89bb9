"""Landed feeds, stages run end to end, streams, gold, and tables on storage."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpuslake.operators import extraction, gold, langid
from corpuslake.operators.joins import numbered_per_key
from corpuslake.plans import stages, tables
from corpuslake.schemas import struct
from corpuslake.sources import bus, feeds, lake
from corpuslake.sources.tables import VersionedTable, run_log
from corpuslake.streaming import ingest as streams

NOW = datetime(2026, 9, 1, 12)
BODY = "Une crue soudaine frappe la vallée et les secours cherchent encore les habitants du village. " * 3
RSS = f"""<rss version="2.0"><channel><title>c</title>
<item><title>Crue au Népal</title><link>https://x/1</link><guid>g1</guid><description>&lt;p&gt;{BODY}&lt;/p&gt;</description>
<pubDate>Mon, 31 Aug 2026 10:00:00 GMT</pubDate><category>monde</category></item>
<item><title>Sans résumé</title><link>https://x/2</link><guid>g2</guid></item>
<item><title>Bref</title><link>https://x/3</link><guid>g3</guid><description>court</description></item>
<item><title></title><link>https://x/4</link><guid>g4</guid></item>
<item><title>Doublon</title><link>https://x/1</link><guid>g1</guid></item>
<item><title>Même adresse</title><link>https://x/1</link><guid>g5</guid><description>autre</description></item>
<item><title>Sans clé</title></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>a</title>
<entry><title>Flood</title><id>tag:1</id><link rel="self" href="https://y/self"/><link href="https://y/1"/>
<summary>The flood reached the valley during the night and the rescue teams looked for people in every village nearby.</summary>
<published>2026-08-30T09:00:00Z</published><author><name>A. Writer</name></author><category term="world" label="World"/></entry></feed>"""
PAGE = "<html><nav>menu</nav><article><p>" + "La page de l'article donne un texte assez long pour être gardé. " * 4 + "</p></article></html>"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    for feed, xml in (("france", RSS), ("world", ATOM), ("broken", "<html>not a feed</html>")):
        (root / f"feed={feed}").mkdir()
        (root / f"feed={feed}" / "latest.xml").write_text(xml, encoding="utf-8")
    return feeds.read_landed(spark, str(root))


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        {"id": "france", "name": "F", "url": "https://x", "lang": "fr", "category": "press"},
        {"id": "world", "name": "W", "url": "https://y", "lang": "en", "category": "press"},
    ]
    return feeds.feed_registry(spark, rows)


@pytest.fixture(scope="module")
def profiles(spark, sf):
    return langid.train(tables.text_table(spark, sf))


@pytest.fixture
def home(spark, tmp_path, registry, profiles):
    return stages.Lake(spark, str(tmp_path / "lake"), registry, profiles)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([("https://x/2", PAGE), ("https://x/3", "")], "url string, html string")


def test_registry_is_checked(spark, registry):
    assert registry.count() == 2
    row = {"id": "a", "name": "n", "url": "u", "lang": "fr", "category": "c"}
    for bad in ([row, row], [{**row, "lang": ""}]):
        with pytest.raises(ValueError):
            feeds.feed_registry(spark, bad)


def test_landed_feeds(landed):
    rows = {(r.feed_id, r.title): r for r in landed.collect()}
    assert len(rows) == 8 and not any(f == "broken" for f, _ in rows)
    rss, atom = rows["france", "Crue au Népal"], rows["world", "Flood"]
    assert rss.guid == "g1" and rss.summary.startswith("<p>") and rss.tags[0].term == "monde"
    assert atom.id == "tag:1" and atom.link == "https://y/1" and atom.author == "A. Writer"
    assert atom.tags[0].label == "World" and atom.published == "2026-08-30T09:00:00Z"


def test_stages_end_to_end(spark, home, landed, pages):
    first = stages.run_stages(home, NOW, landed, pages)
    assert first["ingest"] == 6  # keys, not items: g1 comes twice, one item has no key
    articles = {r.url: r for r in home.articles.current().collect()}
    assert set(articles) == {"https://x/1", "https://x/2", "https://x/3", "https://x/4", "https://y/1"}
    assert first["parse"] == (4, 1)
    assert {u: r.status for u, r in articles.items()} == {
        "https://x/1": "embedded", "https://x/2": "embedded", "https://x/3": "embedded",
        "https://x/4": "fetched", "https://y/1": "embedded",
    }
    silver = {json.loads(r.raw_json)["canonical_url"]: json.loads(r.raw_json) for r in home.silver.current().collect()}
    assert {u: s["text_source"] for u, s in silver.items()} == {
        "https://x/1": "rss_summary", "https://x/2": "permalink", "https://x/3": "rss_summary", "https://y/1": "rss_summary",
    }
    assert silver["https://x/3"]["feed_lang"] == silver["https://x/3"]["content_lang"] == "fr"
    assert "content_lang_confidence" not in silver["https://x/3"] and silver["https://x/3"]["author"] is None
    assert silver["https://y/1"]["content_lang_confidence"] <= 1
    assert articles["https://x/1"].silver_s3_uri.startswith("s3://lake/silver/source=france/dt=2026-08-31/")
    chunks = home.chunk_vectors()
    assert first["embed"] == chunks.count() and chunks.filter("size(embedding) <> 384").isEmpty()
    assert home.lexical_documents.current().count() == 4

    again = stages.run_stages(home, NOW, landed, pages)
    assert again == {"ingest": 0, "parse": (0, 1), "index": 0, "embed": 0}
    assert home.articles.current().count() == 5
    polls = home.runs.current().filter("job = 'poll'").orderBy("new_items").collect()
    assert [(r.new_items, r.errors) for r in polls] == [(0, 1), (6, 1)]  # the item without a key
    assert home.runs.current().groupBy("job").agg(F.sum("new_items")).count() == 4

    rebuilt = stages.run_stages(home, NOW, None, pages, rebuild=True)
    assert rebuilt["index"] == 4 and rebuilt["embed"] == first["embed"]
    assert home.chunk_vectors().count() == first["embed"]
    assert stages.write_gold(home) == 4


def test_invalid_objects_are_not_stored(spark, home, pages):
    schema = feeds.ENTRY_SCHEMA
    rows = [
        ("france", 0, "t", "https://x/9", "  ", None, None, None, None, None, None),  # a blank key
        ("france", 1, "t", "https://x/8", "id8", None, None, None, None, None, None),
        ("f", 2, "t", "https://x/7", "id7", None, None, None, None, None, None),
    ]
    assert stages.ingest(home, spark.createDataFrame(rows, schema), NOW) == 2
    assert home.bronze.versions().count() == 2
    bad = home.table("ingested", stages.INGESTED_SCHEMA, ()).versions().filter("error is not null").first()
    assert bad.error == "item_key: '' should be non-empty"
    # the feed is not registered, so its language is unknown, which the contract allows
    assert stages.parse(home, pages, NOW) == (2, 0)
    assert {r.feed_lang for r in home.articles.current().collect()} == {"fr", "und"}


def test_parsing_from_the_bus_and_replay(spark, home, landed, pages):
    stages.ingest(home, landed, NOW)
    messages = bus.read_messages(spark, home.path("bus"))
    assert messages.count() == 5 and messages.filter("key = 'france'").count() == 4
    assert streams.parse_events(home, pages, NOW) == (4, 1)
    assert streams.parse_events(home, pages, NOW) == (0, 0)  # drained
    stages.index(home, NOW)
    assert streams.replay_events(home, pages, NOW) == (4, 1)
    assert home.articles.current().filter("status = 'parsed'").count() == 4


def test_event_filtering(spark):
    good = {"event": "article.ingested", "feed_id": "f", "url": "u", "s3_uri": "s", "content_hash": "h", "item_key": "k"}
    values = [good, {**good, "feed_lang": "fr"}, {**good, "event": "other"}, [1], {**good, "url": None}]
    rows = [("f", json.dumps(v), i) for i, v in enumerate(values)] + [("f", "{bad", 9), ("f", None, 10)]
    df = spark.createDataFrame(rows, bus.MESSAGE_SCHEMA)
    got = bus.ingested_events(df).orderBy("offset").collect()
    assert [(r.offset, r.feed_lang, r.error) for r in got] == [(0, None, None), (1, "fr", None), (4, None, "missing url")]
    assert bus.kafka_options("h:1", "t", replay=True)["startingOffsets"] == "earliest"


def sequenced(spark, folder, name, numbers, key="a"):
    """A file of one feed's numbered rows."""
    rows = [(key, n, f"v{n}", 0.1 * n) for n in numbers]
    spark.createDataFrame(rows, "feed string, n long, v string, x double").coalesce(1).write.parquet(f"{folder}/in/{name}")


def test_rows_are_held_back_and_released_in_order(spark, tmp_path):
    folder = str(tmp_path)
    schema = "feed string, n long, v string, x double"

    def drained(most_held=100):
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/*")
        streams.drain(streams.in_order(stream, "feed", "n", most_held), f"{folder}/c", path=f"{folder}/out")
        rows = spark.read.parquet(f"{folder}/out").filter("feed = 'a'").orderBy("position").collect()
        assert all((r.v, r.x) == (f"v{r.n}", 0.1 * r.n) for r in rows)
        return [(r.n, r.position, r.missing) for r in rows]

    sequenced(spark, folder, "1", [2, 1, 4])
    sequenced(spark, folder, "1b", [0, 1], "b")
    assert drained() == []  # nothing before its predecessor
    sequenced(spark, folder, "2", [0, 2])
    assert drained() == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]
    sequenced(spark, folder, "3", [1, 7, 4])  # late, doubled and ahead
    sequenced(spark, folder, "3b", [2], "b")
    assert drained() == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]
    sequenced(spark, folder, "4", [5])
    sequenced(spark, folder, "4b", [3], "b")
    got = drained(2)  # too many are held: all are released, with the gaps before them
    assert got == [(0, 0, 0), (1, 1, 0), (2, 2, 0), (4, 3, 1), (5, 4, 0), (7, 5, 1)]
    sequenced(spark, folder, "5", [6, 3, 8])
    assert drained() == [*got, (8, 6, 0)]
    assert [r.n for r in spark.read.parquet(f"{folder}/out").filter("feed = 'b'").orderBy("position").collect()] == [0, 1, 2, 3]


def test_the_earliest_copy_is_kept(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "t"), struct("k string, at long, v string"), ())
    for i, rows in enumerate([[("a", 5, "x"), ("b", 1, "y")], [("a", 3, "z"), ("b", 2, "w")], [("a", 4, "q")]]):
        spark.createDataFrame(rows, "k string, at long, v string").write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema("k string, at long, v string").parquet(str(tmp_path / "in/*"))
        streams.drain(streams.earliest_per_key(stream, "k", "at"), str(tmp_path / "c"), streams.append_batches(target), mode="update")
    kept = streams.settled(target.versions(), "k", "at")
    assert sorted((r.k, r.at, r.v) for r in kept.collect()) == [("a", 3, "z"), ("b", 1, "y")]


def test_numbers_per_key_are_consecutive(spark):
    rows = [("hot" if i % 3 else f"k{i % 5}", i * 7919 % 1000) for i in range(1_000)] + [(None, 1), (None, 0)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(13)
    got = numbered_per_key(df, "k", "v").collect()
    by_key = {}
    for r in sorted(got, key=lambda r: r.number):
        by_key.setdefault(r.k, []).append((r.number, r.v))
    assert len(got) == 1_002
    for found in by_key.values():
        assert [n for n, _ in found] == list(range(len(found))) and [v for _, v in found] == sorted(v for _, v in found)


def test_drained_rows_are_counted(spark, tmp_path):
    runs = run_log(spark, str(tmp_path / "log"))
    for i in range(3):
        spark.createDataFrame([(i, None), (i, "bad")], "v int, error string").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("v int, error string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = [streams.logged_drain(stream, str(tmp_path / "c"), str(tmp_path / "o"), runs, "parse", NOW) for _ in range(2)]
    assert got == [(3, 3), (0, 0)]
    assert sorted((r.new_items, r.errors) for r in runs.versions().collect()) == [(0, 0), (3, 3)]


@pytest.mark.parametrize(
    "summary,html,title,source,starts",
    [
        (BODY, PAGE, "t", "rss_summary", "Une crue"),
        ("court", PAGE, "t", "permalink", "La page"),
        ("court", "<p>bref</p>", "t", "rss_summary", "bref"),  # a short page replaces the short summary
        ("court", "<nav>x</nav>", "t", "title_only", "t"),  # so does a page without text
        ("court", None, "t", "rss_summary", "court"),
        (None, None, " t ", "title_only", "t"),
        (None, None, "  ", None, None),
        (None, None, None, None, None),
    ],
)
def test_text_cascade(spark, summary, html, title, source, starts):
    entry = spark.createDataFrame([("u", title, summary)], "link string, title string, summary string")
    page = spark.createDataFrame([("u", html)] if html else [], "url string, html string")
    row = extraction.article_text(entry, page).first()
    assert row.text_source == source and (row.error is None) == (source is not None)
    assert row.text is None if starts is None else row.text.startswith(starts)


def test_language_detection(spark, profiles, sf):
    df = tables.text_table(spark, sf).filter("n_chars > 200")
    found = langid.detect(df, profiles, F.lit(None).cast("string"), F.col("text"), F.lit("xx"))
    agree = found.agg(F.avg((F.col("content_lang") == F.col("lang")).cast("int"))).first()[0]
    assert agree > 0.95
    short = spark.createDataFrame([(1, "court"), (2, "1234567890 " * 9), (3, None)], "doc_id long, text string")
    rows = langid.detect(short, profiles, F.lit(""), F.col("text"), F.lit("")).orderBy("doc_id").collect()
    assert [(r.content_lang, r.confidence) for r in rows] == [("und", None)] * 3


def test_profiles_count_every_trigram(spark, profiles):
    assert profiles.gains.shape == (langid.PLACES, len(profiles.langs))
    texts = "".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) for i in range(1500))
    table = langid.profile_table(spark.createDataFrame([(texts, "XX"), (texts, None)], "text string, lang string"))
    assert table.agg(F.sum("n")).first()[0] == len(texts) and {r.lang for r in table.collect()} == {"xx"}


def silver_file(root, name, doc, dt="2026-08-31"):
    folder = root / "silver" / "source=harbour" / f"dt={dt}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2), encoding="utf-8")


def test_gold_backfill(spark, tmp_path):
    base = {"schema_version": 1, "feed_id": "harbour", "title": None, "text": "contenu", "feed_lang": "fr"}
    silver_file(tmp_path, "a", {**base, "content_hash": "c0ffee"})
    silver_file(tmp_path, "b", {**base, "content_hash": "b0a7", "dt": "2026-01-01"})
    silver_file(tmp_path, "blank", " \n")
    silver_file(tmp_path, "bad", "{oops")
    silver_file(tmp_path, "empty", {**base, "content_hash": "cc", "text": ""})
    silver_file(tmp_path, "nofeed", {"content_hash": "dd", "text": "x"})
    objects = lake.read_objects(spark, str(tmp_path / "silver"))
    assert lake.inventory(spark, str(tmp_path), 3).count() == 3
    out = str(tmp_path / "gold")
    assert gold.write_gold(gold.gold_rows(objects), out) == 2
    rows = {r.content_hash: r for r in gold.read_gold(spark, out).collect()}
    assert {h: (r.feed_id, r.dt) for h, r in rows.items()} == {
        "c0ffee": ("harbour", "2026-08-31"), "b0a7": ("harbour", "2026-01-01"),
    }
    # another day is added without touching the first ones
    silver_file(tmp_path / "later", "c", {**base, "content_hash": "ee"}, dt="2026-09-01")
    later = lake.read_objects(spark, str(tmp_path / "later"))
    assert gold.write_gold(gold.gold_rows(later), out) == 1
    assert gold.read_gold(spark, out).count() == 3
    assert gold.write_gold(gold.gold_rows(later), out, replace_all=True) == 1
    assert gold.read_gold(spark, out).count() == 1
    for replace in (True, False):
        with pytest.raises(ValueError):
            gold.write_gold(gold.gold_rows(objects.filter("path like '%blank%'")), out, replace)
    assert gold.read_gold(spark, out).count() == 1


def test_gold_feed_from_path_and_inference(spark, tmp_path):
    silver_file(tmp_path, "a", {"content_hash": "h", "text": "x"})
    objects = lake.read_objects(spark, str(tmp_path))
    inferred = gold.infer_schema(objects)
    assert inferred.fieldNames() == ["content_hash", "text"]
    row = gold.gold_rows(objects, inferred).first()
    assert (row.feed_id, row.dt) == ("harbour", "2026-08-31")


def test_layer_writes_reject_invalid_objects(spark, tmp_path):
    rows = [("f", "2026-08-31", "a" * 64, json.dumps({"x": 1}))]
    df = spark.createDataFrame(rows, "feed_id string, dt string, content_hash string, raw_json string")
    bad = lake.write_layer(df, "bronze", str(tmp_path / "bronze"))
    assert bad.count() == 1 and "(racine)" in bad.first().report


def test_layer_round_trip(spark, sf, tmp_path):
    known = lake.identified(tables.entries(spark, sf), F.to_timestamp_ntz(F.lit("2026-08-31 00:00:00")))
    rows = known.withColumn("raw_json", lake.bronze_json(known, F.lit("2026-08-31")))
    bad = lake.write_layer(rows, "bronze", str(tmp_path / "bronze"))
    assert bad.isEmpty()
    back = lake.read_layer(spark, str(tmp_path / "bronze"))
    assert back.select("raw_json").exceptAll(rows.select("raw_json")).isEmpty() and back.count() == rows.count()


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), struct("k string, v int"), ("k",))
    assert table.current().isEmpty() and table.next_batch() == 0
    table.append(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"))
    for _ in range(2):  # a repeated run
        assert table.append(spark.createDataFrame([("a", 2)], "k string, v int"), run="again") == 1
    assert table.versions().count() == 3 and table.versions(but="again").count() == 2
    assert sorted((r.k, r.v) for r in table.current().collect()) == [("a", 2), ("b", 1)]
    wider = VersionedTable(spark, table.path, struct("k string, v int, added string"), ("k",))
    assert {r.added for r in wider.current().collect()} == {None}
    table.compact()
    assert table.versions().filter("batch = 2").count() == table.versions().count() == 2
    assert sorted((r.k, r.v) for r in table.current().collect()) == [("a", 2), ("b", 1)]
    table.append(spark.createDataFrame([("b", 3)], "k string, v int"))
    assert sorted((r.k, r.v) for r in table.current().collect()) == [("a", 2), ("b", 3)]


def test_compacting_a_log_keeps_its_rows(spark, home):
    home.log("poll", NOW, 1, 0)
    home.log("poll", NOW, 2, 0)
    home.runs.compact()
    home.runs.compact()
    assert sorted(r.new_items for r in home.runs.current().collect()) == [1, 2]


def test_a_fresh_checkpoint_keeps_what_is_there(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "t"), struct("k string, v int"), ("k",))
    schema = "k string, v int"

    def landed(name, *values):
        spark.createDataFrame([(k, i) for i, k in enumerate(values)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def drain(name, checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        streams.drain(stream, str(tmp_path / checkpoint), streams.upsert_batches(target, ["k"], F.col("v")))

    landed("one", "a", "b")
    landed("one", "c")
    drain("one", "first")
    landed("two", "c", "z")
    drain("two", "second")
    drain("one", "third")
    assert sorted(r.k for r in target.versions().collect()) == ["a", "b", "c", "z"]


def test_a_failed_ingest_is_completed(spark, home, landed, pages, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    for name in ("publish",):
        with monkeypatch.context() as broken:
            broken.setattr(stages, name, fail)
            with pytest.raises(RuntimeError):
                stages.ingest(home, landed, NOW)
    stages.ingest(home, landed, NOW)
    assert home.bronze.versions().count() == home.bronze.versions().select("uri").distinct().count()
    assert bus.read_messages(spark, home.bus).count() == 5
    offsets = [r.offset for r in bus.read_messages(spark, home.bus).filter("key = 'france'").collect()]
    assert len(set(offsets)) == 4 and None not in offsets
    assert stages.parse(home, pages, NOW) == (4, 1)
    assert home.silver.versions().count() == 4
    envelope = json.loads(home.bronze.versions().first().raw_json)
    assert envelope["fetched_at"].endswith("+00:00") and "T" in envelope["fetched_at"]


def test_limits_count_ingest_events(spark, home, landed, pages):
    stages.ingest(home, landed, NOW)
    noise = spark.createDataFrame([("x", "{}", -1), ("x", "[1]", -2)], bus.MESSAGE_SCHEMA)
    bus.write_messages(noise, f"{home.bus}/batch=99")
    assert sum(streams.replay_events(home, pages, NOW, limit=1)) == 1
    assert sum(streams.parse_events(home, pages, NOW, limit=2)) == 2


def test_events_beyond_a_limit_are_parsed_by_later_runs(spark, home, landed, pages):
    stages.ingest(home, landed, NOW)
    assert [sum(streams.parse_events(home, pages, NOW, limit=n)) for n in (1, 1, 0)] == [1, 1, 0]
    assert home.articles.current().filter("status = 'fetched'").count() >= 3
    stages.ingest(home, spark.createDataFrame([("world", 9, "t", "https://x/late", "late", None, BODY, None, None, None, None)], feeds.ENTRY_SCHEMA), NOW)
    assert sum(streams.parse_events(home, pages, NOW)) == 4  # the three held ones and the new one
    assert sum(streams.parse_events(home, pages, NOW)) == 0
    offsets = {}
    for r in bus.read_messages(spark, home.bus).collect():
        offsets.setdefault(r.key, []).append(r.offset)
    assert all(sorted(o) == list(range(len(o))) for o in offsets.values())


def test_items_of_two_feeds_share_their_chunks(spark, home, pages):
    schema = feeds.ENTRY_SCHEMA
    rows = [(f, 0, "t", f"https://x/{f}", "same", None, BODY * 9, None, None, None, None) for f in ("france", "other")]
    stages.run_stages(home, NOW, spark.createDataFrame(rows, schema), pages)
    chunks = home.chunk_vectors()
    assert chunks.count() == chunks.select("chunk_id").distinct().count() > 1
    assert home.lexical_documents.current().count() == 1
    assert home.articles.current().filter("status = 'embedded'").count() == 2

def test_stream_dedup_with_a_bound(spark, sf, tmp_path):
    schema = tables.read(spark, sf, "events").schema
    events = streams.stream_table(spark, sf, "events", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    keys = streams.first_seen_keys(events.select("ts", F.col("user_id").cast("string").alias("k")), "k", ("ts", "400 days"))
    streams.drain(keys, str(tmp_path / "c"), path=str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == tables.read(spark, sf, "events").select("user_id").distinct().count()


def test_replacing_chunks_leaves_no_tail(spark, home):
    columns = "chunk_id string, content_hash string"
    store = VersionedTable(spark, home.path("some"), struct(columns), ("content_hash",), whole=True)
    store.append(spark.createDataFrame([("h:0", "h"), ("h:1", "h"), ("g:0", "g"), ("g:1", "g")], columns))
    store.append(spark.createDataFrame([("h:0", "h")], columns))
    for _ in range(2):
        assert sorted(r.chunk_id for r in store.current().collect()) == ["g:0", "g:1", "h:0"]
        store.compact()


def test_objects_lie_by_source_and_day(spark, tmp_path):
    layer = lake.ObjectLayer(spark, str(tmp_path / "silver"))
    at = lambda day: F.to_timestamp(F.lit(f"2026-09-0{day} 00:00:00"))
    uri = "s3://lake/silver/source={}/dt={}/{}.json".format
    rows = [(uri(f, f"2026-08-{d}", "a"), "a", "{}") for f in ("7", "b") for d in range(10, 20)] + [("s3://lake/elsewhere", "z", "{}")]
    schema = "uri string, content_hash string, raw_json string"
    wanted = spark.createDataFrame([(rows[0][0],), (None,), ("",), (uri("7", "2026-08-10", "x"),), ("s3://lake/elsewhere",)], "uri string")
    assert layer.current().isEmpty() and layer.current_for(wanted).isEmpty()
    for _ in range(2):  # a repeated run
        layer.write(spark.createDataFrame(rows, schema), at(1), "first")
    assert layer.versions().count() == 21
    layer.write(spark.createDataFrame([(rows[0][0], "a", "new")], schema), at(2), "later")
    layer.write(spark.createDataFrame([(rows[0][0], "a", "old")], schema), at(1), "again")
    assert layer.versions().count() == 23 and layer.current().count() == 21
    found = layer.current_for(wanted)
    assert {(r.uri, r.raw_json, r.source, r.dt) for r in found.collect()} == {
        (rows[0][0], "new", "7", "2026-08-10"), ("s3://lake/elsewhere", "{}", "none", "none"),
    }
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert layer.current_for(wanted.limit(0)).isEmpty()


def test_a_repeated_layer_write_replaces_itself(spark, sf, tmp_path):
    known = lake.identified(tables.entries(spark, sf), F.to_timestamp_ntz(F.lit("2026-08-31 00:00:00")))
    rows = known.withColumn("raw_json", lake.bronze_json(known, F.lit("2026-08-31")))
    for run in ("a", "a", "b"):
        lake.write_layer(rows, "bronze", str(tmp_path / "bronze"), run)
    assert lake.read_layer(spark, str(tmp_path / "bronze")).count() == 2 * rows.count()
