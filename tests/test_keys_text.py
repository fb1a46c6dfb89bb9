import hashlib
import html
import uuid

import pytest
from pyspark.sql import functions as F

from corpuslake.functions import keys, text


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column.alias("v")).collect()]


@pytest.mark.parametrize(
    "entry,expected",
    [
        (("a", "b", "c"), "a"),
        (("", " g ", "c"), "g"),
        (("  ", "g", None), ""),
        ((None, None, "l"), "l"),
        ((None, None, None), None),
        ((" k\n", None, None), "k"),
    ],
)
def test_item_key(spark, entry, expected):
    got = values(spark, keys.item_key(F.col("i"), F.col("g"), F.col("l")), [entry], "i string, g string, l string")
    assert got == [expected]


def test_content_hash_is_of_the_key(spark):
    assert values(spark, keys.content_hash(F.col("x")), [("é",)]) == [hashlib.sha256("é".encode()).hexdigest()]


def test_uuid5_matches_rfc4122(spark):
    names = ["abc:0", "", "été:12"]
    got = values(spark, keys.uuid5_url(F.col("x")), [(n,) for n in names])
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]
    assert got[0] == "a132f9bc-70c3-5a14-b3c8-25db4a317a45"


@pytest.mark.parametrize(
    "uri,bucket,key",
    [
        ("s3://b/k/x.json", "b", "k/x.json"),
        ("s3://b/", None, None),
        ("s3:///k", None, None),
        ("http://b/k", None, None),
        ("s3://b", None, None),
    ],
)
def test_uri_parts(spark, uri, bucket, key):
    assert values(spark, keys.uri_bucket(F.col("x")), [(uri,)]) == [bucket]
    assert values(spark, keys.uri_key(F.col("x")), [(uri,)]) == [key]


def test_published_timestamp(spark):
    rows = [("Mon, 31 Aug 2026 10:00:00 GMT",), ("31 Aug 2026 10:00:00 +0200",), ("2026-08-31T10:00:00Z",), ("soon",), (None,)]
    got = values(spark, F.date_format(keys.published_timestamp(F.col("x")), "yyyy-MM-dd HH:mm"), rows)
    assert got == ["2026-08-31 10:00", "2026-08-31 08:00", "2026-08-31 10:00", None, None]


@pytest.mark.parametrize(
    "question,expected",
    [
        ("que dit le sur la", None),
        ("Le cœur du Népal", "Népal"),
        ("aujourd'hui", None),
        ("inondations internationales au Népal", "internationales"),
        ("crue 2024 Himalaya", "2024"),
        ("ab cd ef", None),
        ("Himalaya Népal", "Himalaya Népal"),
    ],
)
def test_lexical_query(spark, question, expected):
    assert values(spark, text.lexical_query(F.col("x")), [(question,)]) == [expected]


def test_term_counts(spark):
    got = values(spark, text.term_counts(text.words(F.col("x"))), [("b a b, C! b",), ("...",), (None,)])
    assert [(t.term, t.tf) for t in got[0]] == [("a", 1), ("b", 3), ("c", 1)]
    assert got[1:] == [None, None]


def test_analysis_drops_stop_words_of_its_language(spark):
    assert values(spark, text.analyzed(F.col("x"), "fr"), [("L'eau de la mer",)]) == [["eau", "mer"]]
    assert values(spark, text.analyzed(F.col("x")), [("the sea",)]) == [["the", "sea"]]
    stem = lambda t: F.regexp_replace(t, "s$", "")
    assert values(spark, text.analyzed(F.col("x"), "en", stem), [("the seas",)]) == [["sea"]]


@pytest.mark.parametrize(
    "markup,expected",
    [
        ("", None),
        ("   ", None),
        ("<p>Bonjour</p><p>Bonjour</p><p>Monde</p>", "Bonjour\nMonde"),
        ("<nav>menu</nav><article><p>corps</p></article><p>reste</p>", "corps"),
        ("<!-- c --><script>x('<p>')</script><p>a<b>b</b></p><table><tr><td>t</td></tr></table>", "ab"),
        ("<p>&eacute;t&#233; &#x2014; &amp;lt; &quot;q&quot;&nbsp;&#160;fin</p>", 'été — &lt; "q" fin'),
        ("plain text only", "plain text only"),
        ("<div class=\"ad\">pub</div><p>x</p>", "x"),
        ('<div class="ad">x<div>y</div>LEFT</div><p>a</p>', "a"),
        ("<table><tr><td><table><tr><td>t</td></tr></table>CELL</td></tr></table>a", "a"),
        ("<NAV>m<nav>n<nav/></Nav>o</nav>a<header>h</header><heading>b</heading>", "ab"),
        ('<div><div class="wide ad">x</div>a<div class="adverb">b</div></div>c</div>d', "a\nb\nc\nd"),
        ("<p>a</p><form><p>b</p><table>t</table>", "a\nb\nt"),
        ("<nav>m<table>t</nav>a</table>b", "ab"),
        ("</nav></div>a<svg/>b<svg><svg></svg>c</svg>d", "ab\nd".replace("\n", "")),
        ("<template><nav></template>a<script>'<table>'</script>b", "ab"),
        ("<ul><li><a href='/x'>One</a></li><li><a>Two</a> words and more of them</li></ul>", "Two words and more of them"),
        ("<p><a>" + "long " * 30 + "</a></p>", ("long " * 30).strip()),
        ("<p>see <a>all &amp; more</a> of it</p>\u0001\u0002", "see all & more of it"),
        ("<p><a>open link", None),
        ("<div>" * 300 + '<div class="ads">' + "<div>" * 300 + "x" + "</div>" * 300 + "y</div>kept" + "</div>" * 300, "kept"),
        ("<div class=share>" * 40 + "x" + "</div>" * 40 + "<b>kept</b>", "kept"),
    ],
)
def test_html_text(spark, markup, expected):
    assert values(spark, text.html_text(F.col("x")), [(markup,)]) == [expected]


def test_entities_agree_with_the_standard_library(spark):
    names = [n for n in html.entities.html5 if n.endswith(";")]
    sample = "|".join(f"&{n}" for n in names) + "|&#8364;|&#x1F600;|&#12;|&#1114109;|&#0;|&#55296;|&bogus;|&#|5;"
    got = values(spark, text.unescape(F.col("x")), [(sample,)])[0]
    assert got == html.unescape(sample.replace("&#12;", "\f").replace("&#1114109;", chr(1114109)))


def test_snippets(spark):
    long = "mot " * 100 + "aiguille " + "foin " * 100
    got = values(spark, text.snippet(F.col("x"), F.lit("aiguille")), [(long,), ("court",)])
    assert "aiguille" in got[0] and len(got[0]) == 120
    assert got[1] == "court"
    clean = values(spark, text.clean_snippet(F.col("x")), [("<em>a</em>\n  b",), ("x" * 130,)])
    assert clean == ["a b", "x" * 120 + "…"]


@pytest.mark.parametrize(
    "body,terms,expected",
    [
        ("One word here. Two rare words, the rarest! The end.", ["rarest", "words", "end"], "Two rare words, the rarest!"),
        ("a b. a b. b a.", ["a", "b"], "a b."),
        ("plain", ["absent"], "plain"),
        ("", ["x"], ""),
        (None, ["x"], None),
        (" ".join(f"w{i}" for i in range(45)) + ".", ["w41"], "w40 w41 w42 w43 w44."),
        ("long" * 50 + " tail", ["tail"], ("long" * 50 + " tail")[:120]),
        ("\n\n...!\nx", ["x"], "x"),
    ],
)
def test_best_fragment(spark, body, terms, expected):
    row = spark.createDataFrame([(body, terms)], "x string, t array<string>").select(text.best_fragment(F.col("x"), F.col("t")).alias("f")).first()
    assert row["f"] == expected


def test_fragments_meet_terms_by_their_stems(spark):
    row = spark.createDataFrame([("No one. They were running. End.", ["run"])], "x string, t array<string>")
    assert row.select(text.best_fragment(F.col("x"), F.col("t"), "en").alias("f")).first()["f"] == "They were running."
