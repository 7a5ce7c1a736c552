"""Column expressions over a text or over its array of tokens.

A post is one row, so everything that looks at a single post is an expression
over that row: nothing here shuffles, and all of it also runs on a stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Letters, digits and underscore, joined by single ' @ . - : keeps e-mail
# addresses, hyphenated words and possessives in one piece.
WORD = r"[\p{L}\p{N}_]+(?:['@.-][\p{L}\p{N}_]+)*"
WORD_OR_MARK = WORD + r"|[^\s\p{L}\p{N}_]"
NUMBER = r"^[\p{N}.-]+$"
SENTENCE = r"[^.!?]+[.!?]*"
URL = r"(?:https?://|ftp://|www\.)\S+"
EMAIL = r"^[\w.-]+@([\w-]+\.)+\w{2,4}$"
POSSESSIVE = r"([\p{L}\p{N}_]+)'s$"


def tokens(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def without_numbers(toks: Column) -> Column:
    return F.filter(toks, lambda t: ~t.rlike(NUMBER))


def without_emails(toks: Column) -> Column:
    return F.filter(toks, lambda t: ~t.rlike(EMAIL))


def without_words(toks: Column, words: Iterable[str]) -> Column:
    """Drop a short fixed list; a list that is itself data needs an anti join."""
    words = list(words)
    return F.filter(toks, lambda t: ~t.isin(words))


def at_least(toks: Column, chars: int) -> Column:
    return F.filter(toks, lambda t: F.char_length(t) >= chars)


def lowered(toks: Column) -> Column:
    return F.transform(toks, F.lower)


def without_possessive(toks: Column) -> Column:
    return F.transform(toks, lambda t: F.regexp_replace(t, POSSESSIVE, "$1"))


def without_tag_marks(toks: Column) -> Column:
    """Strip leading # and @ (for tokens cut by a pattern that keeps them)."""
    return F.transform(toks, lambda t: F.regexp_replace(t, "^[#@]+", ""))


def ngrams(toks: Column, n: int, sep: str = "_") -> Column:
    """Runs of n neighbouring tokens of a post, in order.

    Zips the array with its shifted copies; `toks` never appears inside a lambda, where
    an inlined expression would be computed again for every token.
    """
    grams = toks
    for shift in range(1, n):
        moved = F.slice(toks, shift + 1, F.size(toks))
        grams = F.zip_with(grams, moved, lambda a, b: F.concat(a, F.lit(sep), b))
    return F.array_compact(grams)


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SENTENCE))


# --- vectors -------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def unit_hash(seed: int, *key: Column) -> Column:
    """md5 of 'seed:key', the source of every reproducible random order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))
