"""Utterance and session text preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..options import TextOptions
from .lookup import explode_lookup_regroup, inline_lookup, lookup_regroup

UTTERANCE_KEYS = ("session_key", "dialogue_idx")


def preprocess(utterances: DataFrame, opts: TextOptions = TextOptions(),
               stopwords: Sequence[str] | None = None, lemmas: DataFrame | None = None,
               keys: Sequence[str] = UTTERANCE_KEYS) -> DataFrame:
    """P1-P11 on every utterance.

    Adds ``processed_text``, ``tokens``, ``token_count`` and ``word_count``;
    rows whose raw text is null or empty get nulls (P11).  ``text`` is read
    through ``coalesce`` so a null text never fails the row (P14).
    """
    ok = tx.has_text("text")
    cleaned = tx.clean_text("text", opts.remove_numbers)
    stop = None
    if opts.remove_stopwords:
        stop = list(stopwords) if stopwords is not None else tx.default_stopwords(opts)
        if opts.remove_stop_phrases:
            cleaned = tx.remove_phrases(cleaned, stop)
    out = utterances.withColumn("processed_text", F.when(ok, cleaned))
    toks = tx.filter_tokens(tx.word_tokens("processed_text"), stop, opts.min_word_length)
    out = out.withColumn("tokens", F.when(ok, toks))
    if opts.lemmatize and lemmas is not None:
        out = lemmatize(out, lemmas, keys)
    return (out.withColumn("token_count", F.when(ok, F.size("tokens")))
               .withColumn("word_count", F.when(ok, tx.word_count("text"))))


def lemmatize(df: DataFrame, lemmas: DataFrame, keys: Sequence[str] = UTTERANCE_KEYS,
              col: str = "tokens") -> DataFrame:
    """Replace each token by its lemma when the table has one (applied after P7/P8).

    ``lemmas(surface, lemma)`` is a user dictionary; a small one is looked up inside the row, a larger one is
    broadcast after a size check and joined to the exploded tokens (see ``lookup``).  Rows of equal ``keys`` become one.
    """
    lem = lemmas.groupBy("surface").agg(F.min("lemma").alias("lemma"))
    inside = inline_lookup(lem, "surface", "lemma")
    if inside is not None:
        g = lookup_regroup(df, keys, col, inside, "lemma")
        has = F.col("_arr").isNotNull()
    else:
        g = explode_lookup_regroup(df, keys, F.col(col), lem, "surface", ["lemma"])
        has = F.col(col).isNotNull()
    lemmas_of = F.when(has, F.transform("_arr", lambda x: F.coalesce(x["lemma"], x["_tok"])))
    return g.select(*[lemmas_of.alias(c) if c == col else F.col(c) for c in df.columns])


def session_text(processed: DataFrame, session_keys: Sequence[str] = ("session_key",),
                 idx: str = "dialogue_idx") -> DataFrame:
    """Per session, text joined by one space in dialogue order, and its tokens.

    The session tokens are the ordered concatenation of the utterance tokens:
    no cleaning rule can match across the joining space, so re-cleaning the
    joined text gives the same list (kept as a test).
    """
    ordered = F.array_sort(F.collect_list(F.struct(
        F.col(idx).alias("i"), F.coalesce(F.col("text"), F.lit("")).alias("t"),
        F.coalesce(F.col("processed_text"), F.lit("")).alias("p"),
        F.coalesce(F.col("tokens"), F.array().cast("array<string>")).alias("k"))))
    g = processed.groupBy(*session_keys).agg(ordered.alias("_u"))
    return g.select(
        *session_keys,
        F.array_join(F.transform("_u", lambda u: u["t"]), " ").alias("combined_text"),
        F.trim(F.regexp_replace(F.array_join(F.transform("_u", lambda u: u["p"]), " "),
                                tx.SPACES_RE, " ")).alias("processed_combined_text"),
        F.flatten(F.transform("_u", lambda u: u["k"])).alias("combined_tokens"),
    )
