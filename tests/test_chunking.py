import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslake.operators import chunking


def brute(text, size, overlap):
    """The window rule stated directly, for comparison."""
    body, out, start = text.strip(), [], 0
    while body:
        stop = min(start + size, len(body))
        if stop < len(body):
            for at in range(stop - 1, start, -1):
                if body[at] == " ":
                    stop = at
                    break
        piece = body[start:stop].strip()
        if piece:
            out.append((len(out), piece, start, stop))
        if stop >= len(body):
            break
        start = max(stop - overlap, start + 1)
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ab\n é😀", max_size=120), st.integers(5, 30), st.integers(0, 4))
def test_equals_the_stated_rule(text, size, overlap):
    assert chunking.split_text(text, size, overlap) == brute(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" abc", max_size=200))
def test_windows_cover_the_text(text):
    body = text.strip()
    chunks = chunking.split_text(text, 20, 5)
    covered = {i for _, _, a, b in chunks for i in range(a, b)}
    assert all(i in covered or body[i].isspace() for i in range(len(body)))


def test_edge_cases():
    cut = chunking.split_text
    assert cut(None, 800, 100) == cut("  \n", 800, 100) == []
    assert cut("x" * 800, 800, 100) == [(0, "x" * 800, 0, 800)]
    assert [c[2:] for c in cut("x" * 801, 800, 100)] == [(0, 800), (700, 801)]
    assert cut("short", 10, 50) == [(0, "short", 0, 5)]
    with pytest.raises(ValueError):
        cut("x" * 20, 10, 10)
    # an early space and one huge token: the window advances a character at a time
    assert len(cut("ab " + "x" * 40, 10, 8)) > 10


def test_many_chunks_are_linear():
    assert len(chunking.split_text("mot " * 250_000, 800, 100)) > 1000


def test_explode_keeps_columns(spark):
    df = spark.createDataFrame(
        [("h1", "f", "t", "fr", None, "u", None, "mot " * 500), ("h2", "f", None, None, None, "u", None, " ")],
        "content_hash string, feed_id string, title string, content_lang string, feed_lang string, "
        "silver_s3_uri string, canonical_url string, text string",
    )
    rows = chunking.silver_chunks(df).orderBy("chunk_index").collect()
    assert [r.chunk_id for r in rows] == [f"h1:{i}" for i in range(len(rows))] and len(rows) == 3
    assert {r.content_lang for r in rows} == {"fr"} and rows[0].title == "t"


def test_language_falls_back(spark):
    df = spark.createDataFrame(
        [("h", "f", None, "", None, "u", None, "x")],
        "content_hash string, feed_id string, title string, content_lang string, feed_lang string, "
        "silver_s3_uri string, canonical_url string, text string",
    )
    assert chunking.silver_chunks(df).first().content_lang == "und"
