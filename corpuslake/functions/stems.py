"""Stemming of single words, as expressions over a column of lower-case words.

English follows Porter's published algorithm; French strips the endings of the light
stemmer published by Savoy (plurals, feminines and some derivations) and then evens out
accents, doubled letters and final vowels. Both are rule tables compiled to one
expression: endings are compared as strings, and only words that have one meet a pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the rules of the two published stemmers ----------------------
# Runs of consonants and vowels; y is a vowel after a consonant, and written Y at a word's start, where it is none.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
#: Stems with more than zero, exactly one and more than one vowel-consonant sequence.
SOME, ONE, MANY = f"^({_C})?{_V}{_C}", f"^({_C})?{_V}{_C}({_V})?$", f"^({_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^({_C})?[aeiouy]"
#: Consonant, vowel, consonant other than w, x and y at the end.
SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"
DOUBLED_END = r"(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"
# Ending and what takes its place.
PORTER_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
PORTER_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
PORTER_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# Ending, least length of the word, letters to cut, what to append; the first that fits counts.
FRENCH_ENDINGS = (
    ("issement", 10, 7, "r"), ("issant", 9, 5, "r"), ("ivement", 7, 6, "if"), ("ement", 7, 4, ""), ("ficatrice", 12, 7, "er"),
    ("ficateur", 11, 6, "er"), ("catrice", 10, 7, "quer"), ("cateur", 9, 6, "quer"), ("isateur", 10, 7, ""), ("atrice", 9, 6, "er"), ("ateur", 8, 5, "er"),
    ("trice", 7, 4, "er"), ("ième", 6, 4, ""), ("teuse", 8, 3, "r"), ("teur", 7, 2, "r"), ("euse", 6, 2, ""), ("ère", 9, 3, "er"),
    ("ive", 8, 2, "f"), ("folle", 5, 3, "u"), ("molle", 5, 3, "u"), ("nnelle", 10, 5, ""), ("nnel", 10, 3, ""), ("ète", 5, 3, "et"),
    ("ique", 9, 4, ""), ("esse", 9, 3, ""), ("inage", 8, 3, ""), ("ualisation", 13, 9, "el"), ("isation", 10, 7, ""),
    ("ation", 9, 5, ""), ("ition", 9, 5, ""),
)
FRENCH_ACCENTS = ("àáâäèéêëìíîïòóôöùúûüç", "aaaaeeeeiiiioooouuuuc")
# After at least three letters one of these goes at the end.
FRENCH_FINALS = "^(.{3,}?)(ie|i?er?e?|re?)$"
#: Elided words that stand before an apostrophe, beside those of one letter and qu, which are stop words.
ELIDED = ("jusqu", "lorsqu", "puisqu", "quoiqu")
# ---------------------------------------------------------------------------------

Step = Callable[[Column], Column]


def _bind(value: Column, use: Step) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chain(word: Column, *steps: Step) -> Column:
    for step in steps:
        word = _bind(word, step)
    return word


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _endings(rules, condition: Callable[[Column], Column]) -> Step:
    """The longest of the endings that fits is replaced if the stem before it meets ``condition``."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))

    def step(word: Column) -> Column:
        out = None
        for ending, new in ordered:
            stem = _cut(word, len(ending))
            changed = F.when(condition(stem), F.concat(stem, F.lit(new))).otherwise(word)
            fits = F.endswith(word, F.lit(ending))
            out = F.when(fits, changed) if out is None else out.when(fits, changed)
        return out.otherwise(word)

    return step


def _plural(word: Column) -> Column:
    ends = lambda s: F.endswith(word, F.lit(s))
    return F.when(ends("sses") | ends("ies"), _cut(word, 2)).when(ends("ss"), word).when(ends("s"), _cut(word, 1)).otherwise(word)


def _past(word: Column) -> Column:
    def mended(stem: Column) -> Column:
        ends = lambda s: F.endswith(stem, F.lit(s))
        return (
            F.when(ends("at") | ends("bl") | ends("iz"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(DOUBLED_END), _cut(stem, 1))
            .when(stem.rlike(SHORT_END), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    out = F.when(F.endswith(word, F.lit("eed")), F.when(_cut(word, 3).rlike(SOME), _cut(word, 1)).otherwise(word))
    for ending in ("ed", "ing"):
        stem = _cut(word, len(ending))
        out = out.when(F.endswith(word, F.lit(ending)), F.when(stem.rlike(HAS_VOWEL), _bind(stem, mended)).otherwise(word))
    return out.otherwise(word)


def _final_y(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("y")) & _cut(word, 1).rlike(HAS_VOWEL), F.concat(_cut(word, 1), F.lit("i"))).otherwise(word)


def _fourth(word: Column) -> Column:
    """Endings that go after two sequences; ion only after s or t."""
    plain = [(e, "") for e in PORTER_4]
    ion = F.when(_cut(word, 3).rlike(MANY) & _cut(word, 3).rlike("[st]$"), _cut(word, 3)).otherwise(word)
    return F.when(F.endswith(word, F.lit("ion")), ion).otherwise(_endings(plain, lambda s: s.rlike(MANY))(word))


def _final_e(word: Column) -> Column:
    stem = _cut(word, 1)
    gone = stem.rlike(MANY) | (stem.rlike(ONE) & ~stem.rlike(SHORT_END))
    return F.when(F.endswith(word, F.lit("e")) & gone, stem).otherwise(word)


def _final_l(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("ll")) & word.rlike(MANY), _cut(word, 1)).otherwise(word)


def english(word: Column) -> Column:
    """Porter's stem of a lower-case word; words of one or two letters stay."""
    some = lambda s: s.rlike(SOME)
    marked = F.when(word.startswith("y"), F.concat(F.lit("Y"), F.substring(word, F.lit(2), F.length(word)))).otherwise(word)
    stem = _chain(marked, _plural, _past, _final_y, _endings(PORTER_2, some), _endings(PORTER_3, some), _fourth, _final_e, _final_l)
    return F.when(F.length(word) <= 2, word).otherwise(F.translate(stem, "Y", "y"))


def _french_plural(word: Column) -> Column:
    n = F.length(word)
    al = F.endswith(word, F.lit("aux")) & ~F.endswith(word, F.lit("eaux"))
    return (
        F.when((n > 5) & al, F.concat(_cut(word, 2), F.lit("l")))
        .when((n > 3) & F.endswith(word, F.lit("x")), _cut(word, 1))
        .when((n > 3) & F.endswith(word, F.lit("s")), _cut(word, 1))
        .otherwise(word)
    )


def _french_ending(word: Column) -> Column:
    out = None
    for ending, least, cut, new in FRENCH_ENDINGS:
        fits = F.endswith(word, F.lit(ending)) & (F.length(word) >= least)
        changed = F.concat(_cut(word, cut), F.lit(new)) if new else _cut(word, cut)
        out = F.when(fits, changed) if out is None else out.when(fits, changed)
    return out.otherwise(word)


def _french_evened(word: Column) -> Column:
    plain = F.regexp_replace(F.translate(word, *FRENCH_ACCENTS), r"([a-z])\1", "$1")
    return F.when(F.length(word) > 4, plain).otherwise(word)


def _french_final(word: Column) -> Column:
    return F.when(F.length(word) > 4, F.regexp_replace(word, FRENCH_FINALS, "$1")).otherwise(word)


def french(word: Column) -> Column:
    """The light stem of a lower-case word; words of up to four letters lose a plural ending only."""
    return _chain(word, _french_plural, _french_ending, _french_evened, _french_final)


STEMMERS: dict[str, Step] = {"en": english, "fr": french}
