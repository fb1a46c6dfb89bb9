"""Text columns: analysis, query rewriting, snippets and HTML to text."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake.functions.keys import blank_to_null, strip
from corpuslake.functions.stems import ELIDED, STEMMERS
from corpuslake.settings import LAKE_NAME, RARE_TERM_CHARS, SNIPPET_CHARS

# --- Fixed values: word lists, token and HTML patterns -------------------------
# Words a question is stripped of before the lexical search.
QUESTION_STOP_WORDS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were
    au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma
    mais me mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se
    ses son sur ta te tes toi ton tu un une vos votre vous y
    quel quelle quels quelles comment combien
    dit parle selon donne corpus flux rss aujourd hui aujourd'hui
    article articles question réponse
    """.split()
) | {LAKE_NAME}
QUESTION_TOKEN = r"[0-9A-Za-zÀ-ÿ_-]+"
WORD_TOKEN = r"[\p{L}\p{N}]+"
SENTENCE = r"[^.!?\n]+[.!?]*"
FRAGMENT_WORDS = 20
POSSESSIVE = r"['’][sS]($|[^\p{L}\p{N}])"
# Stop words of the per-language analysis (the usual English and French lists).
ANALYSIS_STOP_WORDS = {
    "en": tuple(
        """
        a an and are as at be but by for if in into is it no not of on or such
        that the their then there these they this to was will with
        """.split()
    ),
    "fr": tuple(
        """
        au aux avec ce ces dans de des du elle en et eux il je la le leur lui ma
        mais me même mes moi mon ne nos notre nous on ou par pas pour qu que qui
        sa se ses son sur ta te tes toi ton tu un une vos votre vous c d j l à m
        n s t y été étée étées étés étant suis es est sommes êtes sont serai seras
        sera serons serez seront serais serait serions seriez seraient étais était
        étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez
        soient fusse fusses fût fussions fussiez fussent ayant eu eue eues eus ai
        as avons avez ont aurai auras aura aurons aurez auront aurais aurait
        aurions auriez auraient avais avait avions aviez avaient eut eûmes eûtes
        eurent aie aies ait ayons ayez aient eusse eusses eût eussions eussiez
        eussent ceci cela cet cette ici ils les leurs quel quels quelle quelles
        sans soi
        """.split()
    ),
}
# Elements whose content is never article text; the second kind may hold elements of its own name.
RAW_ELEMENTS = ("script", "style", "noscript", "template", "head")
DROPPED_ELEMENTS = ("nav", "header", "footer", "aside", "form", "table", "iframe", "svg", "button")
# Classes of block elements that hold advertising, comments or navigation.
DROPPED_CLASSES = ("ad", "ads", "advert", "comment", "comments", "sidebar", "share", "related")
BLOCK_ELEMENTS = (
    "address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li",
    "main", "ol", "p", "pre", "section", "ul",
)
# A shorter block of which at least this share is link text leads elsewhere.
LINK_BLOCK_CHARS, LINK_SHARE = 100, 0.8
# ------------------------------------------------------------------------------


def words(col: Column) -> Column:
    """Lower-case runs of letters and digits (standard analysis)."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD_TOKEN), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """Distinct tokens with their counts, as ``array<struct<term, tf>>``.

    The tokens are sorted, and the counts are the distances between the places where
    the token changes. This needs no grouping across rows, hence no shuffle.
    """

    def runs(sorted_: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(sorted_) - 1),
            lambda i: (i == 0) | (F.get(sorted_, i) != F.get(sorted_, i - 1)),
        )
        return bind(
            starts,
            lambda at: F.transform(
                at,
                lambda p, j: F.struct(
                    F.get(sorted_, p).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(sorted_)) - p).cast("long").alias("tf"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, bind(F.sort_array(tokens), runs))


def kept_words(col: Column, lang: str | None = None) -> Column:
    """Tokens without the stop words of ``lang``, possessive endings and elided words."""
    if lang == "en":
        col = F.regexp_replace(col, POSSESSIVE, "$1")
    tokens = words(col)
    stop = ANALYSIS_STOP_WORDS.get(lang or "", ()) + (ELIDED if lang == "fr" else ())
    return F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens


def analyzed(
    col: Column, lang: str | None = None, stemmer: Callable[[Column], Column] | None = None
) -> Column:
    """Tokens of the analysis used for ``lang``: stop words dropped, then stemmed.

    English and French have stemmers of their own; ``stemmer``, which maps one token
    column, takes their place.
    """
    stem = stemmer or STEMMERS.get(lang or "")
    tokens = kept_words(col, lang)
    return F.transform(tokens, stem) if stem else tokens


def analyzed_counts(
    col: Column, lang: str | None = None, stemmer: Callable[[Column], Column] | None = None
) -> Column:
    """``struct<dl, terms>`` of a text: number of its tokens, and the analysed ones with counts.

    Only distinct words are stemmed; the counts of words with one stem are then added up.
    """
    stem = stemmer or STEMMERS.get(lang or "")

    def merged(sorted_: Column) -> Column:
        term = lambda i: F.get(sorted_, i)["term"]
        starts = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda i: (i == 0) | (term(i) != term(i - 1)))
        return bind(starts, lambda at: F.transform(at, lambda p, j: F.struct(
            term(p).alias("term"),
            F.aggregate(
                F.slice(sorted_, p + 1, F.coalesce(F.get(at, j + 1), F.size(sorted_)) - p),
                F.lit(0).cast("long"), lambda total, entry: total + entry["tf"],
            ).alias("tf"),
        )))

    def counted(tokens: Column) -> Column:
        terms = term_counts(tokens)
        if stem:
            named = F.transform(terms, lambda e: F.struct(stem(e["term"]).alias("term"), e["tf"].alias("tf")))
            terms = F.when(F.size(tokens) > 0, bind(F.sort_array(named), merged))
        return F.struct(F.size(tokens).alias("dl"), terms.alias("terms"))

    return bind(kept_words(col, lang), counted)


def lexical_terms(question: Column) -> Column:
    """Tokens of a question worth searching; only the rare ones when there are any."""
    kept = F.filter(
        F.regexp_extract_all(question, F.lit(QUESTION_TOKEN), F.lit(0)),
        lambda t: (F.length(t) > 2) & ~F.lower(t).isin(*sorted(QUESTION_STOP_WORDS)),
    )
    rare = F.filter(kept, lambda t: (F.length(t) >= RARE_TERM_CHARS) | t.rlike("[0-9]"))
    return F.when(F.size(rare) > 0, rare).otherwise(kept)


def lexical_query(question: Column) -> Column:
    """Rewritten lexical query, null when no term is left."""
    return blank_to_null(F.array_join(lexical_terms(question), " "))


def snippet(text: Column, term: Column, width: int = SNIPPET_CHARS) -> Column:
    """A window of ``width`` characters around ``term``, or the text's start."""
    at = F.position(term, F.lower(text))
    start = F.greatest(F.lit(1), at - F.lit(width // 4))
    return F.when(at > 0, F.substring(text, start, F.lit(width))).otherwise(
        F.substring(text, 1, width)
    )


def fragments(text: Column) -> Column:
    """A text's sentences, long ones in runs of ``FRAGMENT_WORDS`` words, blanks evened."""
    sentences = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))

    def runs(sentence: Column) -> Column:
        def cut(found: Column) -> Column:
            starts = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found), F.lit(FRAGMENT_WORDS)))
            return F.transform(starts, lambda at: F.array_join(F.slice(found, at, F.lit(FRAGMENT_WORDS)), " "))

        return bind(F.regexp_extract_all(sentence, F.lit(r"\S+"), F.lit(0)), cut)

    return F.flatten(F.filter(F.transform(sentences, runs), lambda found: found.isNotNull()))


def best_fragment(text: Column, terms: Column, lang: str | None = None, width: int = SNIPPET_CHARS) -> Column:
    """The fragment with the most of the analysed ``terms``, cut to ``width``; the text's start without any.

    Every distinct term counts with its length, as long words are the rarer ones. Of equal
    fragments the first is shown.
    """

    def scored(fragment: Column, at: Column) -> Column:
        held = F.array_intersect(F.array_distinct(analyzed(fragment, lang)), terms)
        score = F.aggregate(held, F.lit(0), lambda total, term: total + F.length(term))
        return F.struct(score.alias("score"), (-at).alias("at"), fragment.alias("fragment"))

    best = F.array_max(F.transform(fragments(text), scored))
    start = F.substring(text, 1, width)
    return bind(best, lambda b: F.when(b["score"] > 0, F.substring(b["fragment"], 1, width)).otherwise(start))


def clean_snippet(col: Column, width: int = SNIPPET_CHARS) -> Column:
    """Plain one-line snippet: no emphasis marks, single spaces, cut with an ellipsis."""
    flat = strip(F.regexp_replace(F.regexp_replace(col, "</?em>", ""), r"(?U)\s+", " "))
    return F.when(
        F.length(flat) > width, F.concat(F.substring(flat, 1, width), F.lit("…"))
    ).otherwise(flat)


def _elements(names) -> str:
    return "|".join(rf"<{n}\b[^>]*>.*?</{n}\s*>" for n in names)


_CLASS = "(?:" + "|".join(DROPPED_CLASSES) + ")"
# One of the classes as a whole word of the attribute, in double, single or no quotes.
CLASSED_TAG = (
    r'<div\b[^>]*\bclass\s*=\s*(?:"(?:[^"]*\s)?' + _CLASS + r'(?:\s[^"]*)?"[^>]*'
    + r"|'(?:[^']*\s)?" + _CLASS + r"(?:\s[^']*)?'[^>]*|" + _CLASS + r"(?:\s[^>]*)?)>"
)
#: Comments, and elements whose content is no markup, so that their first end tag ends them.
RAW = r"(?is)<!--.*?-->|" + _elements(RAW_ELEMENTS)
# Where a tag begins that opens or closes an element that may be dropped.
_NESTING_TAG = r"(?i)(?=</?(?:" + "|".join((*DROPPED_ELEMENTS, "div")) + r")\b)"
_LINK, _LINK_END = "\u0001", "\u0002"
BLOCK_TAG = r"(?i)</?(?:" + "|".join(BLOCK_ELEMENTS) + r")\b[^>]*>"
ANY_TAG = r"</?[A-Za-z!][^>]*>"
ARTICLE = r"(?is)<article\b[^>]*>(.*)</article\s*>"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entities() -> Column:
    """All named characters of HTML, a constant map from name to text."""
    return F.from_json(F.lit(json.dumps({n[:-1]: c for n, c in html5.items() if n.endswith(";")})), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a code point; those that are none become the replacement character."""
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")


def unescape(col: Column) -> Column:
    """Named and numeric entities as characters, each decoded once; unknown names stay."""

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,40});", 1)
        dec = F.regexp_extract(piece, r"^#0*([0-9]+);", 1)
        hexa = F.regexp_extract(piece, r"^#[xX]0*([0-9A-Fa-f]+);", 1)
        char = (
            F.when(name != "", F.try_element_at(_entities(), name))
            .when(dec != "", _character(F.when(F.length(dec) <= 7, dec).otherwise("0").cast("long")))
            .when(hexa != "", _character(F.conv(F.when(F.length(hexa) <= 6, hexa).otherwise("0"), 16, 10).cast("long")))
        )
        return bind(char, lambda c: F.when(c.isNull(), F.concat(F.lit("&"), piece)).otherwise(
            F.concat(c, F.regexp_replace(piece, "^[^;]*;", ""))
        ))

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
        return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))

    return F.when(col.contains("&"), bind(F.split(col, "&"), joined)).otherwise(col)


def _without_dropped(body: Column) -> Column:
    """Markup without the dropped elements, whatever they hold, also elements of their own name.

    The markup is cut before every tag that matters. One scan over the pieces counts how
    deep it is inside the dropped element it is in; that one ends where its own end tag
    brings the count to zero. An element that never ends is kept.
    """
    tag = "struct<name string, opens int, drops boolean>"
    state = "struct<name string, depth int, since int, at int, cuts array<struct<a int, b int>>>"

    def read(piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, "^</?([A-Za-z]+)", 1))
        opening = F.regexp_extract(piece, "^<[A-Za-z][^>]*>", 0)
        opens = F.when(piece.startswith("</"), -1).when((opening == "") | opening.endswith("/>"), 0).otherwise(1)
        drops = (opens == 1) & F.when(name == "div", opening.rlike("(?i)^" + CLASSED_TAG)).otherwise(name.isin(*DROPPED_ELEMENTS))
        return F.struct(name.alias("name"), opens.alias("opens"), drops.alias("drops")).cast(tag)

    def scan(s: Column, t: Column) -> Column:
        same = (s["depth"] > 0) & (t["name"] == s["name"])
        enters = (s["depth"] == 0) & t["drops"]
        depth = F.when(enters, 1).when(same, s["depth"] + t["opens"]).otherwise(s["depth"])
        ends = same & (s["depth"] + t["opens"] == 0)
        cut = F.struct(s["since"].alias("a"), s["at"].alias("b"))
        return F.struct(
            F.when(enters, t["name"]).otherwise(s["name"]).alias("name"), depth.alias("depth"),
            F.when(enters, s["at"]).otherwise(s["since"]).alias("since"), (s["at"] + 1).alias("at"),
            F.when(ends, F.array_append(s["cuts"], cut)).otherwise(s["cuts"]).alias("cuts"),
        ).cast(state)

    def kept(pieces: Column) -> Column:
        start = F.struct(
            F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(0).alias("since"), F.lit(0).alias("at"),
            F.array().cast("array<struct<a int, b int>>").alias("cuts"),
        ).cast(state)
        cuts = F.aggregate(F.transform(pieces, read), start, scan, lambda s: s["cuts"])

        def between(c: Column) -> Column:
            starts, ends = F.array_prepend(c["b"], F.lit(0)), F.array_append(c["a"], F.size(pieces))
            return F.array_join(
                F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), "")), ""
            )

        return bind(cuts, between)

    return bind(F.split(body, _NESTING_TAG), kept)


def _leads_elsewhere(line: Column) -> Column:
    """Whether a block is short and hardly more than links, whose ends are marked."""
    whole = F.length(F.translate(line, _LINK + _LINK_END, ""))
    plain = F.length(F.translate(F.regexp_replace(line, f"{_LINK}[^{_LINK_END}]*({_LINK_END}|$)", ""), _LINK_END, ""))
    return line.contains(_LINK) & (whole < LINK_BLOCK_CHARS) & (whole - plain >= LINK_SHARE * whole)


def html_text(html: Column) -> Column:
    """Main text of a page or fragment, one distinct line per block; null if blank.

    Comments, tables, scripts, navigation and advertising are dropped with all they hold,
    the article element is preferred when there is one, short blocks that are hardly more
    than links go, and repeated lines are kept once.
    """

    def main_part(body: Column) -> Column:
        return bind(
            F.regexp_extract(body, ARTICLE, 1), lambda a: F.when(a != "", a).otherwise(body)
        )

    raw = F.regexp_replace(F.translate(html, _LINK + _LINK_END, ""), RAW, "")
    body = bind(_without_dropped(raw), main_part)
    linked = F.regexp_replace(F.regexp_replace(body, r"(?i)<a\b[^>]*>", _LINK), r"(?i)</a\s*>", _LINK_END)
    plain = F.regexp_replace(F.regexp_replace(linked, BLOCK_TAG, "\n"), ANY_TAG, "")
    told = F.filter(F.split(plain, "\n"), lambda line: ~_leads_elsewhere(line))
    lines = F.transform(
        told, lambda line: F.trim(F.regexp_replace(unescape(F.translate(line, _LINK + _LINK_END, "")), "[\\s\u00a0]+", " ")),
    )
    kept = F.array_distinct(F.filter(lines, lambda line: line != ""))
    return blank_to_null(F.array_join(kept, "\n"))
