"""The registered queries as SQL over the same tables, for checking."""

from __future__ import annotations

import re

from corpuslake.functions import contracts as rules
from corpuslake.functions import stems, text
from corpuslake.operators import answers
from corpuslake.settings import EMBEDDING_DIMS, LAKE_NAME

DEPTH = 10
TITLE = r"regexp_extract(text, '^[^.\n]*')"


def _at(minutes: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + to_minutes({minutes}))"


def _day(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _with(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def _words(expr: str) -> str:
    return rf"regexp_extract_all(lower({expr}), '[\p{{L}}\p{{N}}]+')"


KEYED = f"""
keyed AS (
  SELECT *, 'doc-' || doc_id AS item_key, sha256('doc-' || doc_id) AS content_hash,
    strftime({_at('doc_id')}, '%Y-%m-%d') AS dt, {TITLE} AS title
  FROM documents)"""

LOCATED = """
located AS (
  SELECT *, 's3://lake/bronze/source=' || source || '/dt=' || dt || '/' || content_hash || '.json' AS bronze_uri,
    's3://lake/silver/source=' || source || '/dt=' || dt || '/' || content_hash || '.json' AS silver_uri
  FROM keyed)"""

ARTICLES = f"""
articles AS (
  SELECT doc_id AS id, source AS feed_id, 'https://x.example/' || doc_id AS url, item_key, content_hash,
    bronze_uri AS s3_uri, CASE WHEN status <> 'fetched' THEN silver_uri END AS silver_s3_uri, title,
    {_at('doc_id')} AS published_at, status, {_at('doc_id + 60')} AS fetched_at, {_at('doc_id + 60')} AS updated_at,
    CASE WHEN lang <> 'en' THEN lang END AS feed_lang, CASE WHEN status <> 'fetched' THEN lang END AS content_lang
  FROM (SELECT *, ['fetched', 'parsed', 'indexed', 'embedded'][doc_id % 4 + 1] AS status FROM located))"""

CATALOG = (KEYED, LOCATED, ARTICLES)

ENTRIES = f"""
entries AS (
  SELECT *, sha256(item_key) AS content_hash, feed_id || ':' || item_key AS seen_key,
    strftime({_at('doc_id')}, '%Y-%m-%d') AS dt
  FROM (
    SELECT doc_id, source AS feed_id, {TITLE} AS title, lang, text AS summary,
      'https://x.example/' || sha256(text) AS link,
      CASE lang WHEN 'en' THEN '' WHEN 'de' THEN 'id-' || doc_id || ' ' END AS id,
      CASE WHEN lang <> 'es' THEN ' ' || sha256(text) END AS guid,
      CASE lang WHEN 'de' THEN 'id-' || doc_id WHEN 'es' THEN 'https://x.example/' || sha256(text)
        ELSE sha256(text) END AS item_key
    FROM documents))"""

SILVER = f"""
silver AS (
  SELECT doc_id, source AS feed_id, content_hash, title, 'https://x.example/' || doc_id AS canonical_url,
    text, bronze_uri AS bronze_s3_uri, silver_uri AS silver_s3_uri, lang AS feed_lang, lang AS content_lang, dt
  FROM located)"""
DOCS = (KEYED, LOCATED, SILVER)

# One row per step of the chunk window: w is the hard end, the cut is the last space
# strictly inside (start, w), and the next start is at least one further.
CHUNKS = """
bodies AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS body FROM silver),
steps AS (
  SELECT content_hash, body, length(body) AS n, 0 AS step, 0 AS a,
    CASE WHEN length(body) <= 800 THEN length(body) ELSE
      CASE WHEN strpos(reverse(substring(body, 2, 799)), ' ') > 0
        THEN 800 - strpos(reverse(substring(body, 2, 799)), ' ') ELSE 800 END END AS b
  FROM bodies WHERE body <> ''
  UNION ALL
  SELECT content_hash, body, n, step + 1, s,
    CASE WHEN s + 800 >= n THEN n ELSE
      CASE WHEN strpos(reverse(substring(body, s + 2, 799)), ' ') > 0
        THEN s + 800 - strpos(reverse(substring(body, s + 2, 799)), ' ') ELSE s + 800 END END
  FROM (SELECT *, greatest(b - 100, a + 1) AS s FROM steps WHERE b < n)),
pieces AS (
  SELECT content_hash, a AS char_start, b AS char_end, step,
    regexp_replace(substring(body, a + 1, b - a), '^\\s+|\\s+$', '', 'g') AS piece FROM steps),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY step) - 1 AS chunk_index
  FROM pieces WHERE piece <> ''),
chunks AS (
  SELECT s.content_hash || ':' || chunk_index AS chunk_id, s.content_hash, chunk_index, piece AS text,
    char_start, char_end, feed_id, title, content_lang, feed_lang, silver_s3_uri, canonical_url
  FROM numbered n JOIN silver s USING (content_hash))"""


def _vectors(name: str, source: str, key: str, body: str) -> str:
    """Sparse vectors of the hashing encoder: (key, pos, x) rounded to 32 bits."""
    return f"""
{name}_tf AS (
  SELECT k, term, count(*) AS tf FROM (
    SELECT {key} AS k, unnest({_words(body)}) AS term FROM {source}) GROUP BY k, term),
{name}_sum AS (
  SELECT k, ('0x' || substr(md5(term), 1, 8))::BIGINT % {EMBEDDING_DIMS} AS pos,
    sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END * (1 + ln(tf))) AS x
  FROM {name}_tf GROUP BY ALL),
{name}_norm AS (SELECT k, sqrt(sum(x * x)) AS n FROM {name}_sum GROUP BY k),
{name}_f AS (
  SELECT k, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END::FLOAT::DOUBLE AS x
  FROM {name}_sum JOIN {name}_norm USING (k)),
{name} AS (
  SELECT k, pos, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY k)), 0) AS x FROM {name}_f)"""


QUESTIONS = "questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
QUESTION_VECTORS = _vectors("qvec", "questions", "query_id", "question")
CHUNK_VECTORS = _vectors("cvec", "chunks", "chunk_id", "text")


def _cosine(k: int, where: str = "") -> str:
    """Top chunks per question; a chunk that shares no dimension scores 0."""
    return f"""
pairs AS (
  SELECT q.k AS query_id, c.k AS chunk_id, sum(q.x * c.x) AS s
  FROM qvec q JOIN cvec c USING (pos) GROUP BY ALL),
near_all AS (
  SELECT query_id, chunk_id, round(coalesce(s, 0), 6) + 0.0 AS score
  FROM questions CROSS JOIN chunks LEFT JOIN pairs USING (query_id, chunk_id) {where}),
near AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM near_all)
  WHERE rank <= {k})"""


STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(text.QUESTION_STOP_WORDS))
LEXICAL_TERMS = rf"""
list_filter(regexp_extract_all({{0}}, '[0-9A-Za-zÀ-ÿ_-]+'),
  lambda t: length(t) > 2 AND lower(t) NOT IN ({STOP}))"""


def _rewritten(source: str, body: str) -> str:
    kept = LEXICAL_TERMS.format(body)
    rare = "list_filter(kept, lambda t: length(t) >= 12 OR regexp_matches(t, '[0-9]'))"
    return f"""
kept AS (SELECT *, {kept} AS kept FROM {source}),
rewritten AS (
  SELECT * EXCLUDE (kept), nullif(array_to_string(
    CASE WHEN len({rare}) > 0 THEN {rare} ELSE kept END, ' '), '') AS lexical_query
  FROM kept)"""


def _ending_cases(endings, then) -> str:
    """CASE over a word w: the first of the endings it has decides; ``then(ending, new, stem)`` is the result."""
    return "CASE " + " ".join(f"WHEN ends_with(w, '{e}') THEN {then(e, new, f'w[:-{len(e) + 1}]')}" for e, new in endings) + " ELSE w END"


def _longest(endings):
    return sorted(endings, key=lambda r: -len(r[0]))


def _english_stems() -> tuple[str, ...]:
    """Porter's steps, one table of words after the other."""
    has = lambda of, pattern: f"regexp_matches({of}, '{pattern}')"
    replaced = lambda pattern: lambda e, new, stem: f"CASE WHEN {has(stem, pattern)} THEN {stem} || '{new}' ELSE w END"
    mended = f"""CASE WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e' WHEN {has('s', stems.DOUBLED_END)} THEN s[:-2]
      WHEN {has('s', stems.SHORT_END)} THEN s || 'e' ELSE s END"""
    ion = f"CASE WHEN {has('w[:-4]', stems.MANY)} AND regexp_matches(w[:-4], '[st]$') THEN w[:-4] ELSE w END"
    steps = (
        "CASE WHEN regexp_matches(w, '(ss|i)es$') THEN w[:-3] WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN w[:-2] ELSE w END",
        None,
        f"CASE WHEN ends_with(w, 'y') AND {has('w[:-2]', stems.HAS_VOWEL)} THEN w[:-2] || 'i' ELSE w END",
        _ending_cases(_longest(stems.PORTER_2), replaced(stems.SOME)),
        _ending_cases(_longest(stems.PORTER_3), replaced(stems.SOME)),
        f"CASE WHEN ends_with(w, 'ion') THEN {ion} ELSE {_ending_cases(_longest([(e, '') for e in stems.PORTER_4]), replaced(stems.MANY))} END",
        f"""CASE WHEN ends_with(w, 'e') AND ({has('w[:-2]', stems.MANY)} OR {has('w[:-2]', stems.ONE)} AND NOT {has('w[:-2]', stems.SHORT_END)})
          THEN w[:-2] ELSE w END""",
        f"CASE WHEN ends_with(w, 'll') AND {has('w', stems.MANY)} THEN w[:-2] ELSE w END",
    )
    out = ["stem_0 AS (SELECT DISTINCT term AS word, regexp_replace(term, '^y', 'Y') AS w FROM heard WHERE length(term) > 2)"]
    for i, step in enumerate(steps):
        if step is None:
            out.append(f"""stem_{i + 1} AS (
  SELECT word, CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {has('w[:-4]', stems.SOME)} THEN w[:-2] ELSE w END
    WHEN cut = 0 OR NOT {has('s', stems.HAS_VOWEL)} THEN w ELSE {mended} END AS w
  FROM (SELECT *, w[:-(cut + 1)] AS s FROM (
    SELECT *, CASE WHEN ends_with(w, 'ed') THEN 2 WHEN ends_with(w, 'ing') THEN 3 ELSE 0 END AS cut FROM stem_{i})))""")
        else:
            out.append(f"stem_{i + 1} AS (SELECT word, {step} AS w FROM stem_{i})")
    return (*out, f"stemmed AS (SELECT word, translate(w, 'Y', 'y') AS stem FROM stem_{len(steps)})")


def _french_stems() -> tuple[str, ...]:
    doubled = f"translate(w, '{stems.FRENCH_ACCENTS[0]}', '{stems.FRENCH_ACCENTS[1]}')"
    for letter in "abcdefghijklmnopqrstuvwxyz":
        doubled = f"replace({doubled}, '{letter * 2}', '{letter}')"
    endings = " ".join(f"WHEN ends_with(w, '{e}') AND length(w) >= {least} THEN w[:-{cut + 1}] || '{new}'" for e, least, cut, new in stems.FRENCH_ENDINGS)
    steps = (
        """CASE WHEN length(w) > 5 AND ends_with(w, 'aux') AND NOT ends_with(w, 'eaux') THEN w[:-3] || 'l'
          WHEN length(w) > 3 AND right(w, 1) IN ('x', 's') THEN w[:-2] ELSE w END""",
        f"CASE {endings} ELSE w END",
        f"CASE WHEN length(w) > 4 THEN {doubled} ELSE w END",
        f"CASE WHEN length(w) > 4 THEN regexp_replace(w, '{stems.FRENCH_FINALS}', '\\1') ELSE w END",
    )
    out = ["stem_0 AS (SELECT DISTINCT term AS word, term AS w FROM heard)"]
    out += [f"stem_{i + 1} AS (SELECT word, {step} AS w FROM stem_{i})" for i, step in enumerate(steps)]
    return (*out, f"stemmed AS (SELECT word, w AS stem FROM stem_{len(steps)})")


def _bm25_lang(lang: str) -> str:
    """The best of the articles in ``lang`` by its analysis, as one subquery."""
    stop = text.ANALYSIS_STOP_WORDS[lang] + (stems.ELIDED if lang == "fr" else ())
    body = (lambda c: f"regexp_replace({c}, '{text.POSSESSIVE.replace(chr(39), chr(39) * 2)}', '\\1', 'g')") if lang == "en" else (lambda c: c)
    heard = f"""
heard AS (
  SELECT * FROM (
    SELECT content_hash, 'title' AS field, unnest({_words(body('title'))}) AS term FROM silver WHERE content_lang = '{lang}'
    UNION ALL SELECT content_hash, 'text', unnest({_words(body('text'))}) FROM silver WHERE content_lang = '{lang}'
    UNION ALL SELECT 'q' || query_id, 'question', unnest({_words(body('question'))}) FROM questions)
  WHERE term NOT IN ({', '.join(repr(w) for w in stop)})),"""
    chain = ",\n".join((_english_stems if lang == "en" else _french_stems)())
    return f"""
  WITH {heard}
{chain},
  tokens AS (SELECT content_hash, field, coalesce(stem, term) AS term FROM heard LEFT JOIN stemmed ON word = term),
  lengths AS (SELECT content_hash, field, count(*) AS dl FROM tokens WHERE field <> 'question' GROUP BY ALL),
  fstats AS (SELECT field, count(*) AS n_docs, avg(dl) AS avg_dl FROM lengths GROUP BY field),
  tf AS (SELECT content_hash, field, term, count(*) AS tf FROM tokens WHERE field <> 'question' GROUP BY ALL),
  tstats AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
  qterms AS (SELECT DISTINCT content_hash[2:]::BIGINT AS query_id, term FROM tokens WHERE field = 'question'),
  parts AS (
    SELECT query_id, content_hash, field,
      ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avg_dl)) AS w
    FROM qterms JOIN tf USING (term) JOIN tstats USING (field, term) JOIN fstats USING (field) JOIN lengths USING (content_hash, field)),
  scored AS (
    SELECT query_id, content_hash, round(greatest(2 * sum(w) FILTER (field = 'title'), sum(w) FILTER (field = 'text')), 6) AS score
    FROM parts GROUP BY ALL)
  SELECT '{lang}' AS lang, query_id, content_hash, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, content_hash) AS rank
  FROM scored QUALIFY rank <= {DEPTH}"""


def _bm25(question: str, source: str, docs: str, k: int, stop: tuple[str, ...] = ()) -> str:
    """BM25 over title and text, best field with the title doubled."""
    drop = f"WHERE term NOT IN ({', '.join(repr(w) for w in stop)})" if stop else ""
    return f"""
fields AS (
  SELECT content_hash, 'title' AS field, unnest({_words('title')}) AS term FROM {docs}
  UNION ALL SELECT content_hash, 'text', unnest({_words('text')}) FROM {docs}),
tokens AS (SELECT * FROM fields {drop}),
lengths AS (SELECT content_hash, field, count(*) AS dl FROM tokens GROUP BY ALL),
fstats AS (SELECT field, count(*) AS n_docs, avg(dl) AS avg_dl, sum(dl)::BIGINT AS n_tokens FROM lengths GROUP BY field),
tf AS (SELECT content_hash, field, term, count(*) AS tf FROM tokens GROUP BY ALL),
tstats AS (SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY ALL),
qterms AS (
  SELECT DISTINCT query_id, term FROM (
    SELECT query_id, unnest({_words(question)}) AS term FROM {source}) {drop}),
parts AS (
  SELECT query_id, content_hash, field, term,
    ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avg_dl)) AS w
  FROM qterms JOIN tf USING (term) JOIN tstats USING (field, term) JOIN fstats USING (field)
    JOIN lengths USING (content_hash, field)),
scored AS (
  SELECT query_id, content_hash, min(term) AS match_term,
    round(greatest(2 * sum(w) FILTER (field = 'title'), sum(w) FILTER (field = 'text')), 6) AS score
  FROM parts GROUP BY ALL),
found AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, content_hash) AS rank FROM scored)
  WHERE rank <= {k})"""


HITS = rf"""
sentences AS (
  SELECT content_hash, unnest(s) AS sentence, generate_subscripts(s, 1) AS si FROM (
    SELECT content_hash, regexp_extract_all(text, '{text.SENTENCE}') AS s FROM silver WHERE content_hash IN (SELECT content_hash FROM found))),
fragments AS (
  SELECT content_hash, si, fi, array_to_string(w[fi + 1:fi + {text.FRAGMENT_WORDS}], ' ') AS fragment FROM (
    SELECT *, unnest(range(0, len(w), {text.FRAGMENT_WORDS})) AS fi FROM (
      SELECT content_hash, si, regexp_extract_all(sentence, '\S+') AS w FROM sentences))),
shown AS (
  SELECT * FROM (
    SELECT query_id, f.content_hash, fragment, si, fi,
      coalesce(list_sum(list_transform(list_intersect(list_distinct({_words('fragment')}), terms), lambda t: length(t))), 0) AS hit
    FROM found f JOIN fragments USING (content_hash) JOIN (SELECT query_id, list(term) AS terms FROM qterms GROUP BY query_id) USING (query_id))
  QUALIFY row_number() OVER (PARTITION BY query_id, content_hash ORDER BY hit DESC, si, fi) = 1),
hits AS (
  SELECT f.query_id, rank, f.content_hash, score, feed_id, title, content_lang, canonical_url, silver_s3_uri,
    CASE WHEN hit > 0 THEN substring(fragment, 1, 120) ELSE substring(d.text, 1, 120) END AS snippet
  FROM found f JOIN silver d USING (content_hash) LEFT JOIN shown s ON s.query_id = f.query_id AND s.content_hash = f.content_hash)"""

LEXICAL_BRANCH = (QUESTIONS, _rewritten("questions", "question"), _bm25("lexical_query", "rewritten", "silver", DEPTH), HITS)
GERMAN_NEAR = re.sub(r"\b(pairs|near_all|near)\b", r"\1_de", _cosine(DEPTH, "WHERE content_lang = 'de'"))
VECTOR_BRANCH = (QUESTION_VECTORS, CHUNKS, CHUNK_VECTORS, _cosine(DEPTH))

LEXICAL_PASSAGES = """
SELECT query_id, 0 AS list, rank, snippet AS text, 'bm25' AS source, NULL::BIGINT AS chunk_index, content_hash,
  feed_id, title, content_lang, canonical_url, silver_s3_uri, score AS lexical_score, NULL::DOUBLE AS vector_score
FROM hits"""
VECTOR_PASSAGES = """
SELECT query_id, 1 AS list, rank, text, 'vector' AS source, chunk_index, content_hash, feed_id, title,
  content_lang, canonical_url, silver_s3_uri, NULL::DOUBLE AS lexical_score, score AS vector_score
FROM near JOIN chunks USING (chunk_id)"""


def _fused(limit: int, gate: float, *passages: str) -> str:
    """Passages have distinct keys here (a hash with or without chunk), so none merge."""
    keep = f"WHERE sources = 'bm25' OR vector_score >= {gate}" if gate > 0 else ""
    return f"""
passages AS ({' UNION ALL '.join(passages)}),
both_lists AS (SELECT query_id, count(DISTINCT list) = 2 AS fusing FROM passages GROUP BY query_id),
fused AS (
  SELECT * FROM (
    SELECT query_id, content_hash, chunk_index, source AS sources, text, feed_id, title, content_lang,
      canonical_url, silver_s3_uri, nullif(lexical_score, 0) AS lexical_score, nullif(vector_score, 0) AS vector_score,
      round(CASE WHEN fusing THEN 1.0::DOUBLE / (60 + rank) ELSE coalesce(nullif(lexical_score, 0), nullif(vector_score, 0), 0) END, 9) AS score,
      row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN fusing THEN rank ELSE 0 END, list, rank) AS rank
    FROM passages JOIN both_lists USING (query_id))
  WHERE rank <= {limit}),
gated AS (SELECT * FROM fused {keep}),
final AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM gated)"""


def _hybrid(limit: int, gate: float, *branches: str) -> tuple[str, ...]:
    parts, passages = list(DOCS), []
    if "lexical" in branches:
        parts += LEXICAL_BRANCH
        passages.append(LEXICAL_PASSAGES)
    else:
        parts.append(QUESTIONS)
    if "vector" in branches:
        parts += VECTOR_BRANCH
        passages.append(VECTOR_PASSAGES)
    return (*parts, _fused(limit, gate, *passages))


BOTH = ("lexical", "vector")
SHOWN = """SELECT query_id, rank, content_hash, chunk_index, sources, score, lexical_score, vector_score, text FROM gated"""
TITLED = "coalesce(nullif(title, ''), '(sans titre)')"
LABEL = f"substring({TITLED}, 1, 60) || CASE WHEN chunk_index IS NULL THEN '' ELSE ' [chunk ' || chunk_index || ']' END"
FOOTER = f"""chr(10) || chr(10) || '---' || chr(10) || '**Sources {LAKE_NAME}**' || chr(10) ||
    string_agg('- [' || n || '] ' || {TITLED} || ' — ' || coalesce(nullif(canonical_url, ''), nullif(silver_s3_uri, ''), '?'), chr(10) ORDER BY n)"""
REFUSAL = "'" + answers.REFUSAL.replace("'", "''") + "'"

STRICT = _hybrid(4, 0.3, "vector")
TEXTS = f"""
texts AS (
  SELECT query_id, count(*) AS n_passages, {FOOTER} AS footer,
    '(retrieve seul)' || chr(10) || string_agg('[' || n || '] ' || {LABEL}, chr(10) ORDER BY n) AS preview
  FROM final GROUP BY query_id)"""
CASES = """
cases AS (
  SELECT item_id AS case_id, text AS question, CASE WHEN quality = 1 THEN 'grounded' ELSE 'refuse' END AS expect,
    CASE WHEN toxic = 1 THEN 'hard' ELSE 'one_shot' END AS difficulty
  FROM benchmark LEFT JOIN labels ON item_id = doc_id)"""
SCORED_CASES = (
    *STRICT, TEXTS, CASES,
    f"""
generated AS (
  SELECT conv_id AS query_id, arg_min(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY 1),
routed AS (
  SELECT query_id, coalesce(n_passages, 0) AS n_passages,
    CASE WHEN n_passages IS NULL THEN {REFUSAL} ELSE coalesce(answer, '') || footer END AS answer
  FROM questions LEFT JOIN texts USING (query_id) LEFT JOIN generated USING (query_id)),
scores AS (
  SELECT case_id, difficulty, expect, n_passages > 0 AS retrieve_nonempty, n_passages = 0 AS refused,
    cites AS has_citation,
    CASE WHEN expect = 'refuse' THEN n_passages = 0 ELSE n_passages > 0 AND cites END AS ok,
    CASE WHEN expect = 'refuse' THEN CASE WHEN n_passages = 0 THEN 'refused' ELSE 'passages found' END
      WHEN n_passages = 0 THEN 'nothing retrieved' WHEN NOT cites THEN 'no citation' ELSE 'grounded with citation' END AS reason
  FROM cases JOIN (SELECT *, contains(answer, '[1]') OR contains(answer, 'Sources {LAKE_NAME}') AS cites FROM routed) ON case_id = query_id)""",
)

MUTATED = f"""
mutated AS (
  SELECT k.*, quality, toxic,
    CASE WHEN quality IS NULL THEN [{{'p': '', 'm': 'Additional properties are not allowed (''note'' was unexpected)'}}] ELSE [] END
    || CASE WHEN lang = 'fr' AND quality IS NOT NULL THEN [{{'p': '', 'm': '''title'' is a required property'}}] ELSE [] END
    || CASE WHEN toxic = 1 THEN [{{'p': '', 'm': '''feed_lang'' is a required property'}}] ELSE [] END
    || CASE WHEN toxic = 1 THEN [{{'p': 'bronze_s3_uri', 'm': '''http://x'' does not match ''^s3://'''}}] ELSE [] END
    || CASE WHEN lang = 'de' THEN [{{'p': 'content_hash', 'm': '''' || upper(content_hash) || ''' does not match ''^[a-f0-9]{{64}}$'''}}] ELSE [] END
    || CASE WHEN n_chars > 5000 THEN [{{'p': 'content_lang', 'm': '''' || source || ''' is too long'}}] ELSE [] END
    || CASE WHEN n_chars >= 2000 THEN [{{'p': 'content_lang_confidence', 'm': (n_chars // 1000) || ' is greater than the maximum of 1'}}] ELSE [] END
    || CASE WHEN quality = 0 THEN [{{'p': 'schema_version', 'm': '1 was expected'}}] ELSE [] END
    || CASE WHEN n_chars < 200 THEN [{{'p': 'text', 'm': ''''' should be non-empty'}}] ELSE [] END
    || CASE WHEN quality = 1 THEN [{{'p': 'text_source', 'm': '''' || source || ''' is not one of [''rss_summary'', ''permalink'', ''title_only'']'}}] ELSE [] END
      AS errs
  FROM keyed k LEFT JOIN labels USING (doc_id))"""

# In the given pages no dropped element holds one of its own name.
DROPPED = (text.RAW + "".join(rf"|<{n}\b[^>]*>.*?</{n}\s*>" for n in text.DROPPED_ELEMENTS) + "|" + text.CLASSED_TAG + r".*?</div\s*>").replace("'", "''")
BLOCK = text.BLOCK_TAG.replace("'", "''")


def _unescaped(expr: str) -> str:
    """The entities that the given pages hold; each is decoded once, the ampersand last."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">")):
        expr = f"replace({expr}, '&{name};', '{char}')"
    return f"replace({expr}, '&amp;', '&')"


def _html(source: str, key: str, html: str, name: str) -> str:
    """Main text of every page; the given pages hold no numeric entities."""
    return f"""
{name}_body AS (
  SELECT {key} AS k, regexp_replace({html}, '{DROPPED}', '', 'g') AS body FROM {source}),
{name}_main AS (
  SELECT k, CASE WHEN regexp_extract(body, '{text.ARTICLE}', 1) <> '' THEN regexp_extract(body, '{text.ARTICLE}', 1) ELSE body END AS body
  FROM {name}_body),
{name}_lines AS (
  SELECT k, unnest(string_split(plain, chr(10))) AS line, generate_subscripts(string_split(plain, chr(10)), 1) AS i
  FROM (SELECT k, {_unescaped(f"regexp_replace(regexp_replace(body, '{BLOCK}', chr(10), 'g'), '{text.ANY_TAG}', '', 'g')")} AS plain FROM {name}_main)),
{name}_first AS (
  SELECT k, line, min(i) AS i FROM (
    SELECT k, trim(regexp_replace(line, '[\\s\\x{{00A0}}]+', ' ', 'g')) AS line, i FROM {name}_lines)
  WHERE line <> '' GROUP BY k, line),
{name} AS (
  SELECT s.{key} AS k, string_agg(line, chr(10) ORDER BY i) AS text
  FROM {source} s LEFT JOIN {name}_first f ON f.k = s.{key} GROUP BY s.{key})"""


TRIGRAMS = r"""
samples AS (
  SELECT doc_id, lang, ' ' || trim(regexp_replace(lower({body}), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS s, n_sample
  FROM (SELECT *, {sample} AS n_sample FROM {source})),
chars AS (SELECT doc_id, lang, n_sample, string_split(s, '') AS c FROM samples),
grams AS (
  SELECT doc_id, lang, n_sample, (unicode(c[i]) * 40503 + unicode(c[i + 1]) * 9973 + unicode(c[i + 2]) * 2657) % 65521 AS gram
  FROM (SELECT *, unnest(range(1, len(c) - 1)) AS i FROM chars))"""

PROFILES = """
gram_counts AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY ALL),
profiles AS (
  SELECT lang, gram, n, (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::DOUBLE AS total FROM gram_counts)"""
PLAIN_GRAMS = TRIGRAMS.format(body="text", sample="0", source="documents")
SAMPLE = rf"regexp_replace({TITLE} || chr(10) || text, '^\s+|\s+$', '', 'g')"


def _detect_grams(body: str, source: str) -> str:
    return (
        TRIGRAMS.format(body=body, sample=f"length({body})", source=source)
        .replace("samples AS", "d_samples AS").replace("FROM samples", "FROM d_samples")
        .replace("chars AS", "d_chars AS").replace("FROM chars", "FROM d_chars").replace("grams AS", "d_grams AS")
    )


JUDGED = """
floors AS (SELECT lang AS plang, -ln(any_value(total)) AS floor FROM profiles GROUP BY 1),
doc_counts AS (SELECT doc_id, gram, count(*) AS c FROM d_grams WHERE n_sample >= 40 GROUP BY ALL),
doc_n AS (SELECT doc_id, sum(c) AS n_grams FROM doc_counts GROUP BY 1),
gains AS (
  SELECT doc_id, p.lang AS plang, sum(c * (ln((p.n + 1) / p.total) - floor)) AS gain
  FROM doc_counts JOIN profiles p USING (gram) JOIN floors ON plang = p.lang GROUP BY ALL),
hit AS (SELECT DISTINCT doc_id FROM gains),
totals AS (
  SELECT doc_id, f.plang, coalesce(gain, 0) + n_grams * floor AS s
  FROM hit CROSS JOIN floors f JOIN doc_n USING (doc_id) LEFT JOIN gains g USING (doc_id, plang)),
best AS (SELECT doc_id, max(s) AS m FROM totals GROUP BY 1),
judged AS (
  SELECT doc_id, min(plang) FILTER (s = m) AS content_lang, round(1 / sum(exp(s - m)), 6) AS confidence
  FROM totals JOIN best USING (doc_id) GROUP BY 1)"""

CHOSEN = f"""
parts AS (
  SELECT doc_id, d.lang, d.source, own_.text AS s, page_.text AS p, page_id IS NOT NULL AS landed,
    CASE WHEN d.lang <> 'es' THEN {TITLE.replace('text', 'd.text')} END AS raw_title
  FROM documents d LEFT JOIN own_ ON own_.k = doc_id LEFT JOIN pages ON page_id = doc_id LEFT JOIN page_ ON page_.k = doc_id),
chosen AS (
  SELECT *, nullif(raw_title, '') AS t, CASE WHEN length(s) >= 80 THEN s WHEN landed THEN p ELSE s END AS body,
    NOT coalesce(length(s) >= 80, false) AND coalesce(landed AND length(p) >= 80, false) AS permalink FROM parts),
sourced AS (
  SELECT *, coalesce(body, t) AS found, CASE WHEN permalink THEN 'permalink' WHEN body IS NOT NULL THEN 'rss_summary'
    WHEN t IS NOT NULL THEN 'title_only' END AS text_source,
    CASE WHEN coalesce(body, t) IS NULL THEN 'no extractable text' END AS error FROM chosen)"""
CASCADE = (
    _html("pages", "page_id", "html", "page_"),
    "wrapped AS (SELECT doc_id, '<p>' || text || '</p>' AS h FROM documents WHERE lang = 'en')",
    _html("wrapped", "doc_id", "h", "own_"),
    CHOSEN,
)

GOLD = """
gold AS (
  SELECT content_hash, source AS feed_id, CASE WHEN lang = 'es' THEN '2020-02-02' ELSE dt END AS dt, title,
    CASE WHEN lang <> 'es' THEN lang END AS content_lang, length(text) AS n_chars
  FROM located WHERE source NOT IN ('src3', 'src4', 'src5') AND text <> '')"""

BUS = """
bus AS (
  SELECT a.* REPLACE (event_id AS id), event_type
  FROM events JOIN articles a ON a.id = event_id % (SELECT count(*) FROM documents)
  WHERE event_type NOT IN ('error', 'view'))"""
EVENT_ROWS = """
rows_ AS (
  SELECT id, feed_id, CASE WHEN event_type <> 'signup' THEN url END AS url, s3_uri, content_hash,
    NULL::VARCHAR AS title, feed_lang, CASE WHEN event_type = 'signup' THEN 'missing url' END AS error
  FROM bus)"""

FEEDS = "feeds AS (SELECT source AS id, min(lang) AS lang FROM documents GROUP BY 1)"
# One article per feed and guid, the first that landed; every store holds what is its own once.
STAGE_ROWS = """
SELECT 'https://x.example/' || min(doc_id) AS url, source AS feed_id, 'embedded' AS status, 1 AS bronze, 1 AS silver,
  1 AS events, 1 AS lexical, 1 AS indexed, 0 AS doubled_chunks, true AS chunked
FROM documents GROUP BY source, doc_id // 2"""
PAGE_COLUMNS = (
    f"id, feed_id, url, item_key, content_hash, s3_uri, silver_s3_uri, title, {_day('published_at')} AS published_at, "
    f"status, {_day('fetched_at')} AS fetched_at, {_day('updated_at')} AS updated_at"
)


def _quoted_json(name: str, value: str) -> str:
    return f"""'"{name}":' || to_json({value})"""


BRONZE_JSON = (
    "'{\"schema_version\":1,' || "
    + " || ',' || ".join(_quoted_json(c, c) for c in ("feed_id", "item_key", "content_hash", "title", "link"))
    + """ || ',"published":null,"fetched_at":"2024-02-01 00:00:00","source":"rss_item","raw":{' || """
    + " || ',' || ".join(_quoted_json(c, c) for c in ("title", "link"))
    + """ || CASE WHEN id IS NULL THEN '' ELSE ',"id":' || to_json(id) END
      || CASE WHEN guid IS NULL THEN '' ELSE ',"guid":' || to_json(guid) END || ',"summary":' || to_json(summary) || '}}'"""
)
SILVER_JSON = (
    "'{\"schema_version\":1,' || "
    + " || ',' || ".join(_quoted_json(c, c) for c in ("feed_id", "content_hash", "title", "canonical_url"))
    + """ || ',"author":null,"published":' || to_json(dt) || ',"parsed_at":' || to_json(dt || 'T00:00:00+00:00') || ',' || """
    + _quoted_json("text", "text") + """ || ',"text_source":"rss_summary",' || """
    + " || ',' || ".join(_quoted_json(c, c) for c in ("bronze_s3_uri", "feed_lang", "content_lang"))
    + """ || CASE WHEN content_lang = 'fr' THEN ',"content_lang_confidence":0.5' ELSE '' END || '}'"""
)

STATUS_PATH = """
marked AS (
  SELECT a.*, l.doc_id IS NOT NULL AS has_label, quality, toxic FROM articles a LEFT JOIN labels l ON l.doc_id = a.id),
step1 AS (SELECT *, CASE WHEN status = 'fetched' AND quality = 1 THEN 'parsed' ELSE status END AS s1 FROM marked),
step2 AS (SELECT *, CASE WHEN s1 = 'parsed' AND toxic = 0 THEN 'indexed' ELSE s1 END AS s2 FROM step1),
step3 AS (
  SELECT *, CASE WHEN s2 IN ('indexed', 'embedded') AND quality = 1 AND toxic = 0 THEN 'embedded' ELSE s2 END AS s3,
    (status = 'fetched' AND quality = 1) OR (s1 = 'parsed' AND toxic = 0)
      OR (s2 IN ('indexed', 'embedded') AND quality = 1 AND toxic = 0) AS moved
  FROM step2)"""

ORACLE = {
    "item_identity": _with(ENTRIES, select="""
SELECT doc_id, feed_id, item_key, content_hash, seen_key, dt,
  's3://lake/bronze/source=' || feed_id || '/dt=' || dt || '/' || content_hash || '.json' AS s3_uri FROM entries"""),
    "uri_parts": """
SELECT page_id, nullif(regexp_extract(u, '^s3://([^/]+)/(.+)$', 1), '') AS bucket,
  nullif(regexp_extract(u, '^s3://([^/]+)/(.+)$', 2), '') AS object_key,
  CASE WHEN NOT regexp_matches(u, '^s3://([^/]+)/(.+)$') THEN 'invalid uri' END AS error
FROM (SELECT page_id, regexp_replace(url, '^https?://(m[.])?', 's3://') AS u FROM pages)""",
    "bronze_envelope": _with(ENTRIES, select=f"SELECT doc_id, {BRONZE_JSON} AS raw_json FROM entries"),
    "silver_envelope": _with(*DOCS, select=f"SELECT doc_id, {SILVER_JSON} AS raw_json FROM silver"),
    "chunk_uuid5": _with(*DOCS, CHUNKS, select="""
SELECT chunk_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id
FROM (SELECT chunk_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(chunk_id)) AS h FROM chunks)"""),
    "detection_input": f"SELECT doc_id, length({SAMPLE}) AS n_chars, md5({SAMPLE}) AS digest FROM documents",
    "catalog_count": _with(*CATALOG, select="""
SELECT 'all' AS scope, count(*) AS total FROM articles
UNION ALL SELECT 'parsed', count(*) FROM articles WHERE status = 'parsed'
UNION ALL SELECT 'src1 indexed', count(*) FROM articles WHERE feed_id = 'src1' AND status = 'indexed'"""),
    "catalog_status_counts": _with(*CATALOG, select="""
SELECT coalesce(status, '(total)') AS status, count(*) AS n FROM articles GROUP BY ROLLUP (status)"""),
    "feed_summary": _with(*CATALOG, select=f"""
SELECT feed_id, count(*) AS n, {_day('min(fetched_at)')} AS first_fetched, {_day('max(fetched_at)')} AS last_fetched
FROM articles GROUP BY feed_id"""),
    "articles_page": _with(*CATALOG, select=f"""
SELECT {PAGE_COLUMNS} FROM (
  SELECT * FROM articles WHERE status = 'indexed' ORDER BY articles.fetched_at DESC, id DESC LIMIT 50 OFFSET 100)"""),
    "articles_page_total": _with(*CATALOG, select=f"""
SELECT {PAGE_COLUMNS}, total FROM (
  SELECT *, count(*) OVER () AS total FROM articles WHERE feed_id = 'src2' ORDER BY articles.fetched_at DESC, id DESC LIMIT 20 OFFSET 5)"""),
    "article_lookups": _with(*CATALOG, select="""
SELECT how, feed_id, title, url, status FROM articles, unnest(['id', 'content_hash']) AS u(how) WHERE id = 5"""),
    "layer_written": _with(ENTRIES, select="""
SELECT feed_id AS source, dt, count(*) AS n, count(DISTINCT content_hash) AS n_hashes FROM entries GROUP BY ALL"""),
    "recent_articles": _with(*CATALOG, select="""
SELECT id, feed_id, url, title, status FROM articles ORDER BY fetched_at DESC, id DESC LIMIT 5"""),
    "articles_to_parse": _with(*CATALOG, select=f"""
SELECT id, url, s3_uri, {_day('fetched_at')} AS fetched_at FROM articles WHERE status = 'fetched'"""),
    "oldest_fetched": _with(*CATALOG, select=f"""
SELECT id, url, {_day('t')} AS fetched_at FROM (
  SELECT id, url, fetched_at AS t FROM articles WHERE status = 'fetched' ORDER BY fetched_at, id LIMIT 25)"""),
    "articles_to_index": _with(*CATALOG, select="""
SELECT false AS rebuild, id, silver_s3_uri FROM articles WHERE status = 'parsed'
UNION ALL SELECT true, id, silver_s3_uri FROM articles WHERE status IN ('parsed', 'indexed', 'embedded')"""),
    "articles_to_embed": _with(*CATALOG, select="""
SELECT false AS rebuild, id, silver_s3_uri FROM articles WHERE status = 'indexed'
UNION ALL SELECT true, id, silver_s3_uri FROM articles WHERE status IN ('indexed', 'embedded')"""),
    "read_silver": _with(*CATALOG, SILVER, """
asked AS (
  SELECT doc_id AS request_id, toxic, a.*, s.title AS doc_title, s.text, s.canonical_url, s.content_lang AS doc_lang, s.feed_id AS doc_feed
  FROM labels JOIN silver s USING (doc_id) JOIN articles a ON a.id = doc_id)""", select="""
SELECT request_id, CASE WHEN toxic = 1 THEN 'outside silver/' WHEN status = 'fetched' THEN 'not parsed yet' END AS error,
  CASE WHEN toxic = 0 THEN status END AS status, CASE WHEN toxic = 1 THEN s3_uri ELSE silver_s3_uri END AS silver_s3_uri,
  CASE WHEN toxic = 0 THEN content_hash END AS content_hash, CASE WHEN toxic = 0 THEN title END AS title,
  CASE WHEN toxic = 0 THEN feed_id END AS feed_id, CASE WHEN toxic = 0 THEN url END AS canonical_url,
  CASE WHEN toxic = 0 AND status <> 'fetched' THEN 'rss_summary' END AS text_source,
  CASE WHEN toxic = 0 AND status <> 'fetched' THEN doc_lang END AS content_lang,
  CASE WHEN toxic = 0 AND status <> 'fetched' THEN length(text) > 4000 END AS truncated,
  CASE WHEN toxic = 0 AND status <> 'fetched' THEN substring(text, 1, 4000) END AS text
FROM asked"""),
    "feed_language": _with(*CATALOG, FEEDS, select="""
SELECT a.id, feed_id, coalesce(nullif(feed_lang, ''), f.lang, 'und') AS feed_lang
FROM articles a LEFT JOIN feeds f ON f.id = a.feed_id"""),
    "unique_violations": _with(ENTRIES, select="""
SELECT 'url' AS rule, link AS value, count(*) AS n FROM entries GROUP BY link HAVING count(*) > 1
UNION ALL SELECT 'feed_item', feed_id || ':' || item_key, count(*) FROM entries GROUP BY feed_id, item_key HAVING count(*) > 1"""),
    "status_transition": _with(*CATALOG, STATUS_PATH, select=f"""
SELECT id, s3 AS status, CASE WHEN moved THEN '2024-02-01 00:00:00' ELSE {_day('updated_at')} END AS updated_at FROM step3"""),
    "status_reparse": _with(*CATALOG, select=f"""
SELECT id, CASE WHEN doc_id IS NULL THEN status ELSE 'parsed' END AS status,
  CASE WHEN doc_id IS NULL THEN silver_s3_uri ELSE 's3://lake/silver/' || doc_id END AS silver_s3_uri,
  CASE WHEN doc_id IS NULL THEN {_day('updated_at')} ELSE '2024-02-01 00:00:00' END AS updated_at
FROM articles LEFT JOIN labels ON doc_id = id"""),
    "dedup_first_seen": _with(ENTRIES, """
seen AS (SELECT seen_key FROM entries WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))""", select="""
SELECT doc_id, feed_id, seen_key, content_hash FROM entries
WHERE seen_key NOT IN (SELECT seen_key FROM seen)
QUALIFY row_number() OVER (PARTITION BY seen_key ORDER BY doc_id) = 1"""),
    "insert_if_absent": _with(ENTRIES, select="""
SELECT doc_id, feed_id, link AS url,
  link NOT IN (SELECT link FROM entries WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS inserted
FROM entries QUALIFY row_number() OVER (PARTITION BY link ORDER BY doc_id) = 1"""),
    "latest_versions": """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "worker_stats": """
SELECT event_type AS job, count(*) AS runs_total, sum(trunc(value)::BIGINT)::BIGINT AS new_items_total,
  sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS errors_total, epoch_us(max(ts)) / 1e6 AS last_run_epoch
FROM events GROUP BY 1""",
    "ops_status": _with(*CATALOG, """
fresh AS (
  SELECT max(fetched_at) AS w, count(*) AS articles_total,
    date_diff('second', max(fetched_at), TIMESTAMP '2024-02-01 00:00:00') AS age FROM articles)""", select=f"""
SELECT {_day('w')} AS last_write_at, articles_total, age AS seconds_since_write, 21600 AS stale_threshold_seconds,
  age > 21600 AS stale,
  CASE WHEN age > 21600 THEN 'alert: no write for ' || (age // 3600) || 'h (threshold 6h)' ELSE 'ok: recent ingest' END AS message
FROM fresh"""),
    "gauges_long": _with(*CATALOG, """
fresh AS (
  SELECT max(fetched_at) AS w, count(*) AS n,
    date_diff('second', max(fetched_at), TIMESTAMP '2024-02-01 00:00:00') AS age FROM articles),
runs AS (
  SELECT event_type AS job, count(*) AS n, sum(trunc(value)::BIGINT) AS items, sum(json_extract(props, '$.k')::BIGINT) AS errors,
    epoch_us(max(ts)) / 1e6 AS last FROM events GROUP BY 1)""", select="""
SELECT 'catalog_articles_total' AS metric, '' AS label, n::DOUBLE AS value FROM fresh
UNION ALL SELECT 'last_write_timestamp', '', epoch_us(w) / 1e6 FROM fresh
UNION ALL SELECT 'seconds_since_last_write', '', age::DOUBLE FROM fresh
UNION ALL SELECT 'catalog_stale', '', (age > 21600)::INT::DOUBLE FROM fresh
UNION ALL SELECT 'catalog_articles', status, count(*)::DOUBLE FROM articles GROUP BY status
UNION ALL SELECT 'worker_runs_total', job, n::DOUBLE FROM runs
UNION ALL SELECT 'worker_new_items_total', job, items::DOUBLE FROM runs
UNION ALL SELECT 'worker_errors_total', job, errors::DOUBLE FROM runs
UNION ALL SELECT 'worker_last_run_timestamp', job, last FROM runs"""),
    "contract_violations": _with(KEYED, MUTATED, select=f"""
SELECT doc_id, len(errs) AS n_errors, CASE WHEN len(errs) > 0 THEN
  array_to_string(list_transform(errs[1:5], lambda e: CASE WHEN e.p = '' THEN '{rules.ROOT}' ELSE e.p END || ': ' || e.m), chr(10))
  || CASE WHEN len(errs) > 5 THEN chr(10) || '… et ' || (len(errs) - 5) || ' autre(s) erreur(s)' ELSE '' END END AS report
FROM mutated"""),
    "contract_error_counts": _with(KEYED, MUTATED, select="""
SELECT e.p AS path, count(*) AS n FROM (SELECT unnest(errs) AS e FROM mutated) GROUP BY 1"""),
    "contract_audit": _with(KEYED, MUTATED, select="""
SELECT 'bronze' AS layer, count(*) AS ok, 0::BIGINT AS errors FROM documents
UNION ALL SELECT 'silver', count(*) FILTER (len(errs) = 0), count(*) FILTER (len(errs) > 0) FROM mutated
UNION ALL SELECT 'gold', count(*) FILTER (text <> ''), count(*) FILTER (text = '') FROM documents"""),
    "lake_audit": _with(*CATALOG, select="""
SELECT 'bronze' AS layer, count(*) FILTER (lang <> 'es') AS ok, count(*) FILTER (lang = 'es') AS errors
FROM articles JOIN documents ON doc_id = id WHERE status IN ('parsed', 'fetched')
UNION ALL SELECT 'silver', count(*) FILTER (text <> ''), count(*) FILTER (text = '')
FROM articles JOIN documents ON doc_id = id WHERE status = 'parsed'"""),
    "audit_sample": _with(*CATALOG, """
ordered AS (
  SELECT id, status, row_number() OVER (ORDER BY status = 'fetched', fetched_at, id) AS rn,
    row_number() OVER (PARTITION BY status ORDER BY fetched_at, id) AS per_status
  FROM articles WHERE status IN ('parsed', 'fetched'))""", select="""
SELECT id, status FROM ordered WHERE per_status <= 300 ORDER BY rn LIMIT 300"""),
    "gold_projection": _with(KEYED, LOCATED, GOLD, select="SELECT * FROM gold"),
    "gold_partition_counts": _with(KEYED, LOCATED, GOLD, select="SELECT feed_id, dt, count(*) AS n FROM gold GROUP BY ALL"),
    "gold_write_read": _with(KEYED, LOCATED, GOLD, select="SELECT feed_id, dt, count(*) AS n FROM gold GROUP BY ALL"),
    "event_rows": _with(*CATALOG, BUS, EVENT_ROWS, select="SELECT * FROM rows_"),
    "event_error_counts": _with(*CATALOG, BUS, EVENT_ROWS, select="""
SELECT feed_id, count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS errors FROM rows_ GROUP BY 1"""),
    "bus_messages": _with(*CATALOG, select="""
SELECT feed_id AS key, '{"event":"article.ingested","feed_id":' || to_json(feed_id) || ',"url":' || to_json(url) ||
  ',"s3_uri":' || to_json(s3_uri) || ',"content_hash":' || to_json(content_hash) || ',"item_key":' || to_json(item_key) ||
  CASE WHEN feed_lang IS NULL THEN '' ELSE ',"feed_lang":' || to_json(feed_lang) END || '}' AS value
FROM articles"""),
    "stages_run": STAGE_ROWS,
    "stages_resumed": STAGE_ROWS,
    "html_marks": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i
  FROM (SELECT doc_id, 'kept &OUML; öß×•° éé' || chr(1114109) || chr(65533) || ' &lt;' || chr(10) || regexp_replace(text, '[^\\p{L}\\n]+', ' ', 'g') AS t FROM documents)
), once AS (
  SELECT doc_id, trim(line) AS line, min(i) AS i FROM lines WHERE trim(line) <> '' GROUP BY 1, 2)
SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM once GROUP BY doc_id""",
    "html_nested": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i
  FROM (SELECT doc_id, 'kept' || chr(10) || 'also kept' || chr(10) || regexp_replace(text, '[^\\p{L}\\n]+', ' ', 'g') || chr(10) || 'see all of it here' || CASE WHEN doc_id % 3 = 0 THEN chr(10) || 'open' ELSE '' END AS t FROM documents)
), once AS (
  SELECT doc_id, trim(line) AS line, min(i) AS i FROM lines WHERE trim(line) <> '' GROUP BY 1, 2)
SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM once GROUP BY doc_id""",
    "html_text": _with(_html("pages", "page_id", "html", "html_"), select="SELECT k AS page_id, text FROM html_"),
    "text_source_cascade": _with(*CASCADE, select="""
SELECT doc_id, text_source, error, md5(found) AS digest, length(found) AS n_chars FROM sourced"""),
    "silver_build": _with(
        *CATALOG, FEEDS, *CASCADE, PLAIN_GRAMS, PROFILES,
        "detected AS (SELECT doc_id, lang, coalesce(raw_title, '') || chr(10) || coalesce(found, '') AS sample FROM sourced)",
        _detect_grams(r"regexp_replace(sample, '^\s+|\s+$', '', 'g')", "detected"), JUDGED,
        """
langs AS (
  SELECT a.*, coalesce(nullif(a.feed_lang, ''), f.lang, 'und') AS resolved
  FROM articles a LEFT JOIN feeds f ON f.id = a.feed_id)""",
        select="""
SELECT l.url, error, text_source, md5(found) AS digest, resolved AS feed_lang, coalesce(j.content_lang, resolved) AS content_lang,
  confidence AS content_lang_confidence, strftime(l.published_at, '%Y-%m-%d') AS dt,
  replace(l.s3_uri, '/bronze/', '/silver/') AS silver_s3_uri
FROM langs l JOIN sourced s ON s.doc_id = l.id LEFT JOIN judged j ON j.doc_id = l.id"""),
    "published_dates": _with(*CATALOG, select=f"""
SELECT id, CASE WHEN status <> 'fetched' THEN {_day('published_at')} END AS published_at FROM articles"""),
    "landed_feeds": """
SELECT source AS feed_id, lang AS title, 'https://x.example/' || doc_id AS link, doc_id::VARCHAR AS guid, md5(text) AS digest
FROM documents""",
    "feed_dialects": """
SELECT source AS feed_id, lang AS title, 'https://x.example/' || doc_id AS link, CASE WHEN doc_id % 3 > 0 THEN 'urn:doc:' || doc_id END AS id,
  md5(text) AS summary, CASE WHEN doc_id % 3 > 0 THEN '2024-01-02' END AS updated, source AS author, CASE WHEN doc_id % 3 = 0 THEN 'a,b' ELSE 's' END AS terms
FROM documents""",
    "stream_bus": _with(*CATALOG, BUS, EVENT_ROWS, select="SELECT * FROM rows_"),
    "lang_profiles": _with(PLAIN_GRAMS, PROFILES, select="""
SELECT lang, gram AS place, n, round(ln((n + 1) / total), 6) AS log_weight FROM profiles"""),
    "lang_detect": _with(PLAIN_GRAMS, PROFILES, _detect_grams(SAMPLE, "documents"), JUDGED, select="""
SELECT d.doc_id, coalesce(content_lang, 'und') AS content_lang, confidence FROM documents d LEFT JOIN judged USING (doc_id)"""),
    "chunk_documents": _with(*DOCS, CHUNKS, select="""
SELECT chunk_id, content_hash, chunk_index, char_start, char_end, feed_id, content_lang, text FROM chunks"""),
    "lexical_query_rewrite": _with(_rewritten("conversations", "text"), select="SELECT conv_id, turn, lexical_query FROM rewritten"),
    "lexical_documents": _with(*DOCS, select="""
SELECT content_hash, feed_lang, content_lang, title, CASE WHEN content_lang = 'fr' THEN title ELSE '' END AS title_fr,
  CASE WHEN content_lang = 'en' THEN title ELSE '' END AS title_en, canonical_url, '' AS author,
  CASE WHEN content_lang = 'fr' THEN length(text) ELSE 0 END AS n_fr, CASE WHEN content_lang = 'en' THEN length(text) ELSE 0 END AS n_en
FROM silver"""),
    "term_stats": _with(*DOCS, QUESTIONS, _bm25("question", "questions", "silver", 1), select="SELECT * FROM tstats"),
    "field_stats": _with(*DOCS, QUESTIONS, _bm25("question", "questions", "silver", 1), select="""
SELECT field, n_docs, round(avg_dl, 6) AS avg_dl, n_tokens FROM fstats"""),
    "bm25_topk": _with(*DOCS, QUESTIONS, _bm25("question", "questions", "silver", DEPTH), select="""
SELECT query_id, rank, content_hash, score FROM found"""),
    "bm25_topk_lang": _with(*DOCS, QUESTIONS, select=f"""
SELECT query_id, lang, rank, content_hash, score FROM ({_bm25_lang("fr")}) UNION ALL
SELECT query_id, lang, rank, content_hash, score FROM ({_bm25_lang("en")})"""),
    "lexical_branch": _with(*DOCS, *LEXICAL_BRANCH, select="""
SELECT query_id, rank, content_hash, score, feed_id, title, content_lang, snippet FROM hits"""),
    "snippets": _with(_html("pages", "page_id", "html", "html_"), select=r"""
SELECT k AS page_id, CASE WHEN length(flat) > 120 THEN substring(flat, 1, 120) || '…' ELSE flat END AS snippet
FROM (SELECT k, trim(regexp_replace(regexp_replace(text, '</?em>', '', 'g'), '\s+', ' ', 'g')) AS flat FROM html_)"""),
    "encoded_questions": _with(QUESTIONS, QUESTION_VECTORS, select="""
SELECT k AS query_id, pos, round(x, 6) AS x FROM qvec_f WHERE x <> 0"""),
    "centroid_topk": _with("""
flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, round(avg(x), 6) AS x FROM flat GROUP BY ALL),
scored AS (
  SELECT m.label::BIGINT AS query_id, f.vec_id,
    round(sum(m.x * f.x) / (sqrt(sum(m.x * m.x)) * sqrt(sum(f.x * f.x))), 6) AS score
  FROM means m JOIN flat f USING (pos) GROUP BY m.label, f.vec_id)""", select=f"""
SELECT * FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
WHERE rank <= {DEPTH}"""),
    "cosine_topk": _with(*DOCS, QUESTIONS, *VECTOR_BRANCH, select="SELECT query_id, rank, chunk_id, score FROM near"),
    "vector_index_topk": _with(*DOCS, QUESTIONS, *VECTOR_BRANCH, select="""
SELECT query_id, rank, chunk_id, score, md5(text) AS digest FROM near JOIN chunks USING (chunk_id)"""),
    "cosine_topk_lang": _with(
        *DOCS, QUESTIONS, QUESTION_VECTORS, CHUNKS, CHUNK_VECTORS, _cosine(DEPTH, "WHERE content_lang = 'de'"),
        select="SELECT query_id, rank, chunk_id, score FROM near"),
    "vector_dimensions": _with(*DOCS, CHUNKS, select=f"""
SELECT 'given' AS origin, len(embedding) AS dims, count(*) AS n FROM embeddings GROUP BY ALL
UNION ALL SELECT 'encoded', {EMBEDDING_DIMS}, count(*) FROM chunks"""),
    "rrf_fusion": _with(*_hybrid(20, 0, *BOTH), select=SHOWN),
    "rrf_merged": _with(*DOCS, QUESTIONS, *VECTOR_BRANCH, GERMAN_NEAR, """
merged AS (
  SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score, min(list * 1000000 + rank) AS first_at,
    string_agg(source, '+' ORDER BY list) AS sources, nullif(max(score), 0) AS vector_score
  FROM (SELECT *, 1 AS list, 'vector' AS source FROM near UNION ALL SELECT *, 2, 'german' FROM near_de) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_at) AS rank FROM merged)""", select="""
SELECT query_id, rank, content_hash, chunk_index, sources, score, NULL::DOUBLE AS lexical_score, vector_score, text
FROM placed JOIN chunks USING (chunk_id) WHERE rank <= 20"""),
    "relevance_gate": _with(*_hybrid(20, 0.3, *BOTH), select=SHOWN),
    "hybrid_retrieve": _with(*_hybrid(10, 0.2, *BOTH), select=SHOWN),
    "vector_only_retrieve": _with(*_hybrid(10, 0, "vector"), select=SHOWN),
    "lexical_only_retrieve": _with(*_hybrid(10, 0.45, "lexical"), select=SHOWN),
    "search_response": _with(*_hybrid(5, 0, *BOTH), select="""
SELECT query_id, rank, title, round(score, 4) AS score, sources, content_hash, chunk_index, feed_id, content_lang,
  canonical_url, silver_s3_uri, substring(text, 1, 800) AS text FROM gated"""),
    "citations": _with(*DOCS, CHUNKS, select=f"SELECT chunk_id AS passage_key, {LABEL} AS label FROM chunks"),
    "prompt_assembly": _with(*_hybrid(4, 0, *BOTH), select=f"""
SELECT query_id, 'Extraits du corpus :' || chr(10) || chr(10) ||
  string_agg('[' || n || '] (' || sources || ') ' || {TITLED} || chr(10) || '    feed: ' || feed_id || chr(10) || '    silver: ' || silver_s3_uri
    || chr(10) || '    extrait: ' || regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) ORDER BY n)
  || chr(10) || chr(10) || 'Question : ' || any_value(question) AS user_message
FROM final JOIN questions USING (query_id) GROUP BY query_id"""),
    "sources_footer": _with(*_hybrid(4, 0, *BOTH), TEXTS, select="SELECT query_id, n_passages, footer FROM texts"),
    "answer_routing": _with(*STRICT, TEXTS, select=f"""
SELECT query_id, coalesce(n_passages, 0) AS n_passages, n_passages IS NULL AS refused,
  coalesce(preview, {REFUSAL}) AS answer FROM questions LEFT JOIN texts USING (query_id)"""),
    "case_scores": _with(*SCORED_CASES, select="SELECT * FROM scores"),
    "eval_summary": _with(*SCORED_CASES, select="""
SELECT coalesce(difficulty, '(all)') AS difficulty, count(*) FILTER (ok) AS passed, count(*) AS total
FROM scores GROUP BY ROLLUP (difficulty)"""),
    "recall_report": _with(*STRICT, CASES, f"""
hits_ AS (SELECT expect, case_id IN (SELECT query_id FROM gated) AS hit FROM cases)""", select=f"""
SELECT 'hashing' AS model, {EMBEDDING_DIMS} AS vector_size, 4 AS k, 'benchmark' AS eval_set,
  round(coalesce(count(*) FILTER (expect = 'grounded' AND hit) / nullif(count(*) FILTER (expect = 'grounded'), 0), 0), 6) AS recall_at_k,
  count(*) FILTER (expect = 'grounded') AS n_grounded, count(*) FILTER (expect = 'grounded' AND hit) AS n_hits,
  count(*) FILTER (expect <> 'grounded') AS n_refuse, count(*) FILTER (expect <> 'grounded' AND NOT hit) AS n_refuse_ok
FROM hits_"""),
    "recall_cases": _with(*STRICT, CASES, select="""
SELECT case_id, expect, case_id IN (SELECT query_id FROM gated) AS hit FROM cases"""),
    "baseline_check": _with(*STRICT, CASES, """
reports AS (
  SELECT gate, coalesce(count(*) FILTER (expect = 'grounded' AND case_id IN (SELECT query_id FROM gated WHERE vector_score >= gate))
    / nullif(count(*) FILTER (expect = 'grounded'), 0), 0) AS recall FROM cases, unnest([0.3, 0.5]) AS g(gate) GROUP BY gate)""", select=f"""
SELECT 'benchmark' AS eval_set, 'hashing ' || r.gate AS model, round(r.recall, 6) AS recall_at_k, 'hashing 0.3' AS baseline_model,
  round(b.recall, 6) AS baseline_recall, r.recall < b.recall AS worse,
  CASE WHEN r.recall < b.recall THEN 'roll back to hashing 0.3 ({EMBEDDING_DIMS} dimensions), then embed again' ELSE 'keep' END AS advice
FROM reports r JOIN reports b ON b.gate = 0.3"""),
    "last_user_message": r"""
SELECT conv_id, arg_max(t, turn) FILTER (role = 'user' AND t <> '') AS question,
  CASE WHEN count(*) FILTER (role = 'user' AND t <> '') = 0 THEN 'no user message' END AS error
FROM (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations) GROUP BY conv_id""",
    "answer_citations": f"""
SELECT conv_id, turn, contains(text, '[1]') OR contains(text, 'Sources {LAKE_NAME}') AS has_citation
FROM conversations WHERE role = 'assistant'""",
    "stream_dedup": "SELECT DISTINCT source || ':' || sha256(text) AS seen_key FROM documents",
    "stream_upsert": """
SELECT 'https://x.example/' || sha256(text) AS url, 1 AS n, min(doc_id) AS doc_id FROM documents GROUP BY 1""",
    "stream_earliest": """
SELECT source || ':' || sha256(text) AS seen_key, min(doc_id) AS doc_id FROM documents GROUP BY 1""",
    "stream_in_order": """
SELECT doc_id, source, row_number() OVER w - 1 AS number, row_number() OVER w - 1 AS position, 0 AS missing
FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)""",
    "stream_run_log": _with(*CATALOG, BUS, EVENT_ROWS, select="""
SELECT 'parse' AS job, 2 AS runs_total, count(*) FILTER (error IS NULL) AS new_items_total, count(error) AS errors_total,
  epoch(TIMESTAMP '2024-02-01 02:00:00') AS last_run_epoch FROM rows_"""),
    "stages_limited": """
WITH articles AS (SELECT DISTINCT source, doc_id // 2 AS item FROM documents)
SELECT source AS feed_id, count(*) AS parsed, 1 AS limited, sum(count(*)) OVER () AS total FROM articles GROUP BY source""",
    "stream_replay": """
SELECT event_type AS key, count(*) AS streamed, count(*) AS replayed, max(event_id) AS last_offset FROM events GROUP BY 1""",
}
ORACLE["vector_cells_topk"] = ORACLE["vector_index_topk"]
ORACLE["bm25_index_topk"] = ORACLE["bm25_index_updated"] = ORACLE["bm25_topk"]
ORACLE["chunk_replacement"] = None  # filled below


def _resized(size: int, overlap: int) -> str:
    return CHUNKS.replace("799", str(size - 1)).replace("800", str(size)).replace("b - 100", f"b - {overlap}")


ORACLE["chunk_replacement"] = (
    _with(*DOCS, CHUNKS, """
small AS (
  SELECT content_hash, count(*) AS n_chunks, max(char_end) AS last_char FROM chunks
  WHERE content_hash NOT IN (SELECT content_hash FROM silver JOIN labels USING (doc_id)) GROUP BY 1)""",
          select="SELECT * FROM small")
    + "\nUNION ALL\n"
    + "SELECT * FROM ("
    + _with(*DOCS, _resized(2000, 100), """
large AS (
  SELECT content_hash, count(*) AS n_chunks, max(char_end) AS last_char FROM chunks
  WHERE content_hash IN (SELECT content_hash FROM silver JOIN labels USING (doc_id)) GROUP BY 1)""",
            select="SELECT * FROM large")
    + ")"
)
