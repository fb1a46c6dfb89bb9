"""Parameters of the engine, and the fixed values its results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: limits, thresholds and names that results depend on ---------
SCHEMA_VERSION = 1
ENTRY_SOURCE = "rss_item"
EVENT_INGESTED = "article.ingested"
STATUSES = ("fetched", "parsed", "indexed", "embedded")
JOBS = ("poll", "parse", "index", "embed")
TEXT_SOURCES = ("rss_summary", "permalink", "title_only")
UNKNOWN_LANG = "und"
MIN_TEXT_CHARS = 80
MIN_LANG_CHARS = 40
CHUNK_CHARS = 800
CHUNK_OVERLAP = 100
EMBEDDING_DIMS = 384
RRF_K = 60
MIN_DEPTH = 10
TOP_K_DEFAULT, TOP_K_MAX = 4, 20
MIN_VECTOR_SCORE = 0.45
BM25_K1, BM25_B, TITLE_BOOST = 1.2, 0.75, 2.0
ANALYZED_LANGS = ("fr", "en")
SNIPPET_CHARS = 120
RARE_TERM_CHARS = 12
PASSAGE_KEY_CHARS = 80
LABEL_TITLE_CHARS = 60
UNTITLED = "(sans titre)"
UNKNOWN_URI = "(uri inconnue)"
SEARCH_TEXT_CHARS = 800
READ_CHARS_DEFAULT, READ_CHARS_MIN, READ_CHARS_MAX = 4000, 200, 12000
PAGE_LIMIT_DEFAULT, PAGE_LIMIT_MAX = 50, 200
STALE_HOURS = 6.0
MAX_REPORTED_ERRORS = 5
UUID_NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"
# ------------------------------------------------------------------------------

LAKE_NAME = "corpuslake"
SCORE_DIGITS = 6
#: Parquet files of layers, tables and stored results: texts take about half of what snappy leaves.
COMPRESSION = "zstd"

# Largest row counts that are ever handed to every task. Each has an exact plan
# for inputs beyond it (see operators/lexical.py, operators/vector.py).
MAX_BROADCAST_ROWS = 200_000
MAX_QUERY_BLOCK = 4_096


def clamp(value, low, high):
    return max(low, min(high, value))


@dataclass(frozen=True)
class RetrievalSettings:
    """Validated retrieval parameters; out-of-range values are clamped."""

    top_k: int = TOP_K_DEFAULT
    depth: int | None = None
    lang: str | None = None
    min_vector_score: float = MIN_VECTOR_SCORE
    lexical: bool = True
    vector: bool = True
    rrf_k: int = RRF_K

    def __post_init__(self):
        if not (self.lexical or self.vector):
            raise ValueError("lexical-only and vector-only are mutually exclusive")
        object.__setattr__(self, "top_k", clamp(int(self.top_k), 1, TOP_K_MAX))
        object.__setattr__(
            self, "min_vector_score", clamp(float(self.min_vector_score), 0.0, 1.0)
        )

    @property
    def per_engine(self) -> int:
        return self.depth if self.depth is not None else max(self.top_k, MIN_DEPTH)
