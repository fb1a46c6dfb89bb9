import pytest

AWKWARD = [None, "", " \n\n ", "one", "Two WORDS", "x" * 200_000, "lorem ipsum dolor sit amet " * 4_000]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns named like new ones."""
    line = "the quick brown fox jumps over the lazy dog and runs away from it all day long\n"
    rows = [(i, t) for i, t in enumerate(AWKWARD)]
    rows += [(50, line * 5), (50, line * 5), (51, line * 5), (None, line * 5), (52, "Mail a.b@c.de or +49 30 1234567, 10.0.0.1"), (53, None)]
    return spark.createDataFrame(
        [(i, t, "s", 1, "k", True) for i, t in rows], "doc_id long, text string, score string, n int, row string, kept boolean"
    )


@pytest.fixture
def nothing(awkward):
    return awkward.limit(0)
