"""Column-expression builders for cleaning and tokenising.

Everything here is a pure ``Column -> Column`` function: it runs inside
whole-stage codegen next to the scan, with no shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import TextOptions

# Java regexes.  ``(?U)`` makes \s, \d, \w and \b Unicode-aware, as Python's
# ``re`` is; \p{Punct} *without* (?U) is exactly the 32 ASCII punctuation
# characters of Python's ``string.punctuation``.
URL_RE = r"(?U)(http|www)\S+"
PUNCT_RE = r"\p{Punct}"
DIGITS_RE = r"(?U)\d+"
SPACES_RE = r"(?U)\s+"

# The tokenizer rules that can still fire on lowercase,
# punctuation-free text -- curly/angle quotes become their own tokens, and
# these contractions split in two (cannot gimme gonna gotta lemme wanna).
QUOTE_CHARS = "«“‘„»”’"
CONTRACTIONS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"),
                ("lem", "me"), ("wan", "na"))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_py(col: Column | str) -> Column:
    """Python ``str.strip()``: trim all Unicode whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def has_text(col: Column | str) -> Column:
    """True for non-null, non-empty text."""
    return _c(col).isNotNull() & (F.length(_c(col)) > 0)


def clean_text(col: Column | str, remove_numbers: bool = True) -> Column:
    """Lowercase, drop URLs, punctuation to space, drop digits, collapse spaces."""
    c = F.lower(_c(col))
    c = F.regexp_replace(c, URL_RE, "")
    c = F.regexp_replace(c, PUNCT_RE, " ")
    if remove_numbers:
        c = F.regexp_replace(c, DIGITS_RE, "")
    return F.trim(F.regexp_replace(c, SPACES_RE, " "))


def remove_phrases(col: Column | str, phrases: Iterable[str]) -> Column:
    """Optional: remove multi-word stop phrases (whole words) from cleaned text."""
    multi = [p for p in phrases if " " in p]
    if not multi:
        return _c(col)
    alt = "|".join(p.replace(" ", r"\s+") for p in sorted(multi, key=len, reverse=True))
    return F.trim(F.regexp_replace(F.regexp_replace(_c(col), rf"(?U)\b(?:{alt})\b", " "),
                                   SPACES_RE, " "))


def word_tokens(col: Column | str) -> Column:
    """Tokenise cleaned text (split quotes and the fixed contractions, then split on spaces)."""
    c = F.regexp_replace(_c(col), f"([{QUOTE_CHARS}])", " $1 ")
    # one pass for all contractions: a space after the first part
    words = "|".join(a + b for a, b in CONTRACTIONS)
    firsts = "|".join(sorted({a for a, _ in CONTRACTIONS}))
    c = F.regexp_replace(c, rf"(?U)\b(?=(?:{words})\b)({firsts})", "$1 ")
    return F.filter(F.split(c, " "), lambda x: x != "")


def default_stopwords(opts: TextOptions) -> list[str]:
    """The stop list: explicit list (or Spark's English list) plus custom words."""
    if opts.stopwords is not None:
        base = list(opts.stopwords)
    else:
        from pyspark.ml.feature import StopWordsRemover
        base = StopWordsRemover.loadDefaultStopWords("english")
    return sorted(set(base) | set(opts.custom_stopwords))


def filter_tokens(tokens: Column, stopwords: Iterable[str] | None, min_len: int) -> Column:
    """Drop stop words (order and repeats kept) and short tokens.

    ``isin`` over more than ten literals is planned as a hash-set lookup
    (InSet), so the stop list costs O(1) per token.
    """
    stop = sorted(set(stopwords or ()))
    if stop:
        tokens = F.filter(tokens, lambda x: ~x.isin(stop))
    if min_len and min_len > 0:
        tokens = F.filter(tokens, lambda x: F.length(x) >= min_len)
    return tokens


def word_count(col: Column | str) -> Column:
    """P10: number of whitespace-separated words of the raw text."""
    return F.size(F.filter(F.split(_c(col), SPACES_RE), lambda x: x != ""))


def vader_tokens(col: Column | str) -> Column:
    """A1: whitespace tokens of at least two characters (the scorer's own split)."""
    return F.filter(F.split(_c(col), SPACES_RE), lambda x: F.length(x) > 1)


def alpha_tokens(col: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """Alternative cleaning -- lowercase alphabetic tokens minus stop words, no length rule."""
    toks = F.filter(F.split(F.lower(_c(col)), SPACES_RE), lambda x: x.rlike(r"^\p{L}+$"))
    stop = sorted(set(stopwords or ()))
    return F.filter(toks, lambda x: ~x.isin(stop)) if stop else toks
