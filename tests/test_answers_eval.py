import pytest
from pyspark.sql import functions as F

from corpuslake.operators import answers, evaluation
from corpuslake.sources import evalset

FUSED = (
    "query_id long, rank int, text string, sources string, chunk_index int, content_hash string, feed_id string, "
    "title string, content_lang string, canonical_url string, silver_s3_uri string, score double"
)


def passages(spark):
    return spark.createDataFrame(
        [
            (1, 1, " extrait un \n", "bm25", None, "h", "f", "T" * 70, "fr", "https://u", "s3://b/k", 0.1),
            (1, 3, "deux", "vector", 2, "h", None, None, "fr", None, None, 0.1),
        ],
        FUSED,
    )


QUESTIONS = "query_id long, question string"


def test_prompt_and_footer(spark):
    asked = spark.createDataFrame([(1, " Quoi ? "), (2, "rien")], QUESTIONS)
    prompt = answers.prompts(asked, passages(spark)).collect()
    assert len(prompt) == 1
    assert prompt[0].user_message == (
        "Extraits du corpus :\n\n[1] (bm25) " + "T" * 70 + "\n    feed: f\n    silver: s3://b/k\n    extrait: extrait un"
        "\n\n[2] (vector) (sans titre)\n    feed: ?\n    silver: (uri inconnue)\n    extrait: deux\n\nQuestion : Quoi ?"
    )
    footer = answers.passage_texts(passages(spark)).first().footer
    assert footer.endswith(f"- [1] {'T' * 70} — https://u\n- [2] (sans titre) — ?")


def test_routing(spark):
    asked = spark.createDataFrame([(1, "q"), (2, "rien")], QUESTIONS)
    preview = {r.query_id: r for r in answers.route_answers(asked, passages(spark), retrieve_only=True).collect()}
    assert preview[1].answer == f"(retrieve seul)\n[1] {'T' * 60}\n[2] (sans titre) [chunk 2]"
    assert preview[2].refused and preview[2].answer == answers.REFUSAL
    said = spark.createDataFrame([(1, "voici [1]"), (2, "invention")], "query_id long, answer string")
    full = {r.query_id: r for r in answers.route_answers(asked, passages(spark), said).collect()}
    assert full[1].answer.startswith("voici [1]\n\n---\n**") and full[2].answer == answers.REFUSAL


@pytest.mark.parametrize(
    "expect,n,answer,refused,retrieve_only,ok,reason",
    [
        ("refuse", 0, "", False, False, True, "refused"),
        ("refuse", 2, answers.REFUSAL + " ", False, False, True, "refused"),
        ("refuse", 2, "texte", False, False, False, "passages found"),
        ("grounded", 0, "", True, False, False, "nothing retrieved"),
        ("grounded", 1, "texte", False, True, True, "passages found"),
        ("grounded", 1, answers.REFUSAL, False, False, False, "refused despite passages"),
        ("grounded", 1, "sans", False, False, False, "no citation"),
        ("grounded", 1, "selon [1]", False, False, True, "grounded with citation"),
        ("grounded", 1, answers.SOURCES_MARK, False, False, True, "grounded with citation"),
    ],
)
def test_scoring_table(spark, expect, n, answer, refused, retrieve_only, ok, reason):
    cases = spark.createDataFrame([(1, expect, "hard")], "case_id long, expect string, difficulty string")
    said = spark.createDataFrame([(1, n, answer, refused)], "query_id long, n_passages long, answer string, refused boolean")
    row = evaluation.score_cases(cases, said, retrieve_only).first()
    assert (row.ok, row.reason) == (ok, reason)


def test_summary_and_recall(spark):
    cases = spark.createDataFrame(
        [(1, "q", "grounded", "hard"), (2, "q", "grounded", "one_shot"), (3, "q", "grounded", "one_shot"), (4, "q", "refuse", "one_shot")],
        "case_id long, question string, expect string, difficulty string",
    )
    report, hits = evaluation.evaluate_recall(
        cases, lambda q: q.filter("query_id in (1, 2)"), model="m", vector_size=3, k=4, eval_set="s"
    )
    row = report.first()
    assert (row.n_grounded, row.n_hits, row.n_refuse, row.n_refuse_ok) == (3, 2, 1, 1)
    assert abs(row.recall_at_k - 2 / 3) < 1e-12
    assert [r.case_id for r in hits.filter("expect = 'grounded' and not hit").collect()] == [3]
    none, _ = evaluation.evaluate_recall(cases.filter("expect = 'refuse'"), lambda q: q, model="m", vector_size=3, k=4, eval_set="s")
    assert none.first().recall_at_k == 0.0


def test_baseline_registry(spark, tmp_path):
    cases = spark.createDataFrame([(1, "grounded")], "case_id long, expect string")
    path = str(tmp_path / "registry")
    good = evaluation.recall_report(cases.withColumn("hit", F.lit(True)), "old", 384, 4, "s")
    evalset.register(good, path, "2026-01-01")
    worse = evaluation.recall_report(cases.withColumn("hit", F.lit(False)), "new", 64, 4, "s")
    row = evaluation.against_baseline(worse, evalset.read_registry(spark, path)).first()
    assert row.worse and row.advice.startswith("roll back to old (384")
    evalset.register(worse, path, "2026-01-02")
    assert not evaluation.against_baseline(worse, evalset.read_registry(spark, path)).first().worse
    evalset.write_report(worse, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().recall_at_k == 0.0


@pytest.mark.parametrize(
    "case", [{"expect": "x"}, {"difficulty": "easy"}, {"question": "  "}, {"expect": None}]
)
def test_invalid_cases_are_refused(spark, case):
    sound = {"id": "c", "question": "q", "expect": "grounded", "difficulty": "hard"}
    assert evalset.eval_cases(spark, [sound]).count() == 1
    with pytest.raises(ValueError):
        evalset.eval_cases(spark, [{**sound, **case}])
    with pytest.raises(ValueError):
        evalset.eval_cases(spark, [])


def test_params():
    assert evalset.embed_params() == {"model": "hashing", "vector_size": 384, "top_k": 4}
    assert evalset.embed_params({"vector_size": 64})["vector_size"] == 64


def test_last_user_message(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "user", " b\n"), (1, 2, "user", "  "), (1, 3, "assistant", "c"), (2, 0, "system", "s")],
        "conv_id long, turn long, role string, text string",
    )
    got = {r.conv_id: (r.question, r.error) for r in answers.last_user_message(turns).collect()}
    assert got == {1: ("b", None), 2: (None, "no user message")}
