"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables under ``sf_dir`` (``conversations`` is
the utterance table) or data Spark derives from them; the fixture
dictionaries are parameters of the operators, inlined identically on both
sides.  Each key of ``QUERIES`` with an entry in ``ORACLE`` is checked by
value; the others (model fits) by rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import preprocess as pp
from ..operators import sentiment as se
from ..options import TextOptions
from ..session import read_parquet
from . import fixtures as fx
from . import sql as q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

FIXTURE_TEXT = TextOptions(stopwords=tuple(fx.STOPWORDS), custom_stopwords=())


def decimal_round6(sql: str) -> str:
    """Rewrite ``round(x, 6)`` as a decimal rounding (same tie rule as ``r6`` on Spark)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + 6:k]
        if inner.rstrip().endswith(", 6"):
            expr = decimal_round6(inner.rstrip()[:-3])
            out.append(sql[i:j] + f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 6) AS DOUBLE)")
        else:
            out.append(sql[i:j] + "round(" + decimal_round6(inner) + ")")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = decimal_round6(sql.strip())
        return fn
    return deco


_SHARED: dict = {}


def shared(fn):
    """Memoise a derived DataFrame per (session, data folder, args).

    Queries that use the same intermediate (scored utterances, documents,
    session index) get the same plan object, so planning is done once and
    Spark reuses the identical exchanges inside one query.
    """
    def wrapper(spark, sf_dir, *args):
        key = (fn.__module__, fn.__name__, spark.sparkContext.applicationId, sf_dir, args)
        if key not in _SHARED:
            _SHARED[key] = fn(spark, sf_dir, *args)
        return _SHARED[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@shared
def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")


# ------------------------------------------------------------ shared inputs
@shared
def utterances(spark, sf_dir) -> DataFrame:
    return fx.utterances(read(spark, sf_dir, "conversations"))


@shared
def sessions(spark, sf_dir) -> DataFrame:
    return fx.sessions(read(spark, sf_dir, "conversations"))


@shared
def processed(spark, sf_dir, lemmas: bool = True) -> DataFrame:
    return pp.preprocess(utterances(spark, sf_dir), FIXTURE_TEXT,
                         lemmas=fx.lemmas_df(spark) if lemmas else None)


@shared
def scored(spark, sf_dir) -> DataFrame:
    return se.score_utterances(processed(spark, sf_dir, False), fx.lexicon_df(spark),
                               fx.boosters_df(spark), fx.negators_df(spark))


def r6(c):
    """Round doubles to 6 places through decimal(38,10), so ties round the same in both engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,10)"), 6).cast("double")


# ============================================================== P: text
@register("clean_text", f"""
SELECT session_key, dialogue_idx,
       CASE WHEN length(text) > 0 THEN {q.clean('text')} END AS processed_text,
       CASE WHEN length(text) > 0 THEN CAST({q.word_count("text")} AS INTEGER) END AS word_count
FROM ({fx.SQL_UTTERANCES})""")
def clean_text(spark, sf_dir):
    return processed(spark, sf_dir, False).select(
        "session_key", "dialogue_idx", "processed_text", "word_count")


_TOKS = q.filter_tokens(q.word_tokens(q.clean("text")), fx.STOPWORDS, 3)
_LEMMA_SQL = f"""
WITH u AS ({fx.SQL_UTTERANCES}),
t AS (SELECT session_key, dialogue_idx, {_TOKS} AS a FROM u WHERE length(text) > 0),
e AS (SELECT session_key, dialogue_idx, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t),
l AS (SELECT surface, min(lemma) AS lemma FROM {fx.values_sql(fx.LEMMAS, ['surface', 'lemma'])} GROUP BY surface),
m AS (SELECT e.session_key, e.dialogue_idx,
             string_agg(coalesce(l.lemma, e.tok), ' ' ORDER BY e.pos) AS tokens_text, count(*) AS n
      FROM e LEFT JOIN l ON e.tok = l.surface GROUP BY e.session_key, e.dialogue_idx)
SELECT t.session_key, t.dialogue_idx, coalesce(m.tokens_text, '') AS tokens_text,
       CAST(len(t.a) AS INTEGER) AS token_count
FROM t LEFT JOIN m USING (session_key, dialogue_idx)"""


@register("tokens", _LEMMA_SQL)
def tokens(spark, sf_dir):
    """P6-P10 with the fixture stop list and lemma table."""
    return processed(spark, sf_dir).where(tx.has_text("text")).select(
        "session_key", "dialogue_idx", F.array_join("tokens", " ").alias("tokens_text"),
        "token_count")


@register("session_text", f"""
WITH u AS ({fx.SQL_UTTERANCES}),
c AS (SELECT session_key, string_agg(text, ' ' ORDER BY dialogue_idx) AS combined_text FROM u GROUP BY session_key)
SELECT session_key, combined_text, {q.clean('combined_text')} AS processed_combined_text,
       array_to_string({q.filter_tokens(q.word_tokens(q.clean('combined_text')), fx.STOPWORDS, 3)}, ' ')
         AS combined_tokens
FROM c""")
def session_text(spark, sf_dir):
    """Session text and tokens (no lemma table: P13 twin of the raw rules)."""
    s = pp.session_text(processed(spark, sf_dir, False))
    return s.select("session_key", "combined_text", "processed_combined_text",
                    F.array_join("combined_tokens", " ").alias("combined_tokens"))


# ======================================================== A: sentiment
UTT_COLS = ["session_key", "dialogue_idx", "speaker", "patient_id", "pos_score", "neg_score",
            "neu_score", "compound_score", "sentiment_category"]


@register("utterance_sentiment", f"""
WITH {q.scored_utterances_cte()}
SELECT session_key, dialogue_idx, speaker, patient_id, pos_score, neg_score, neu_score,
       compound_score, {q.polarity('compound_score')} AS sentiment_category
FROM scored""")
def utterance_sentiment(spark, sf_dir):
    return scored(spark, sf_dir).select(*UTT_COLS)


SESSION_COLS = ["session_key", "file_name", "session_date", "session_number", "patient_id"]
_SQL_SESSION_SENT = f"""
ss AS (SELECT s.*, coalesce(a.ac, 0.0) AS avg_compound, coalesce(a.ap, 0.0) AS avg_positive,
         coalesce(a.an, 0.0) AS avg_negative, coalesce(a.au, 0.0) AS avg_neutral,
         coalesce(a.pc, 0) AS positive_count, coalesce(a.uc, 0) AS neutral_count,
         coalesce(a.nc, 0) AS negative_count, coalesce(a.c, 0) AS scored_count,
         {q.polarity('coalesce(a.ac, 0.0)')} AS overall_sentiment
       FROM ({fx.SQL_SESSIONS}) s LEFT JOIN (
         SELECT session_key, avg(compound_score) AS ac, avg(pos_score) AS ap, avg(neg_score) AS an,
                avg(neu_score) AS au,
                count(*) FILTER (WHERE {q.polarity('compound_score')} = 'positive') AS pc,
                count(*) FILTER (WHERE {q.polarity('compound_score')} = 'neutral') AS uc,
                count(*) FILTER (WHERE {q.polarity('compound_score')} = 'negative') AS nc,
                count(*) AS c
         FROM scored GROUP BY session_key) a USING (session_key))"""


@register("session_sentiment", f"""
WITH {q.scored_utterances_cte()}, {_SQL_SESSION_SENT}
SELECT session_key, file_name, session_date, session_number, patient_id,
       round(avg_compound, 6) AS avg_compound, round(avg_positive, 6) AS avg_positive,
       round(avg_negative, 6) AS avg_negative, round(avg_neutral, 6) AS avg_neutral,
       positive_count, neutral_count, negative_count, scored_count,
       {q.polarity('avg_compound')} AS overall_sentiment
FROM ss""")
def session_sentiment(spark, sf_dir):
    s = se.session_sentiment(scored(spark, sf_dir), sessions(spark, sf_dir))
    return s.select(*SESSION_COLS, *[r6(c).alias(c) for c in
                                     ("avg_compound", "avg_positive", "avg_negative", "avg_neutral")],
                    "positive_count", "neutral_count", "negative_count", "scored_count",
                    "overall_sentiment")


@register("speaker_sentiment", f"""
WITH {q.scored_utterances_cte()},
a AS (SELECT patient_id, speaker, count(*) AS total_entries,
        sum(compound_score) AS compound_sum, sum(pos_score) AS pos_sum, sum(neg_score) AS neg_sum,
        sum(neu_score) AS neu_sum,
        count(*) FILTER (WHERE {q.polarity('compound_score')} = 'positive') AS positive_count,
        count(*) FILTER (WHERE {q.polarity('compound_score')} = 'neutral') AS neutral_count,
        count(*) FILTER (WHERE {q.polarity('compound_score')} = 'negative') AS negative_count
      FROM scored WHERE speaker IS NOT NULL AND speaker <> '' GROUP BY patient_id, speaker)
SELECT patient_id, speaker, total_entries, round(compound_sum, 6) AS compound_sum,
       round(pos_sum, 6) AS pos_sum, round(neg_sum, 6) AS neg_sum, round(neu_sum, 6) AS neu_sum,
       positive_count, neutral_count, negative_count,
       round(compound_sum / total_entries, 6) AS avg_compound,
       round(pos_sum / total_entries, 6) AS avg_positive,
       round(neg_sum / total_entries, 6) AS avg_negative,
       round(neu_sum / total_entries, 6) AS avg_neutral,
       {q.polarity('compound_sum / total_entries')} AS overall_sentiment
FROM a""")
def speaker_sentiment(spark, sf_dir):
    s = se.speaker_sentiment(scored(spark, sf_dir), ["patient_id"])
    num = ["compound_sum", "pos_sum", "neg_sum", "neu_sum", "avg_compound", "avg_positive",
           "avg_negative", "avg_neutral"]
    return s.select("patient_id", "speaker", "total_entries",
                    *[r6(c).alias(c) if c in num else F.col(c) for c in
                      ["compound_sum", "pos_sum", "neg_sum", "neu_sum", "positive_count",
                       "neutral_count", "negative_count", "avg_compound", "avg_positive",
                       "avg_negative", "avg_neutral", "overall_sentiment"]])


_SQL_PROGRESSION = f"""
r AS (SELECT session_key, dialogue_idx, compound_score,
        row_number() OVER (PARTITION BY session_key ORDER BY dialogue_idx) AS rn,
        count(*) OVER (PARTITION BY session_key) AS n FROM scored),
p AS (SELECT session_key,
        avg(compound_score) FILTER (WHERE rn <= greatest(1, n // 3)) AS start_sentiment,
        avg(compound_score) FILTER (WHERE rn > n - greatest(1, n // 3)) AS end_sentiment,
        stddev_pop(compound_score) AS vol
      FROM r GROUP BY session_key),
prog AS (SELECT s.*, p.start_sentiment, p.end_sentiment,
        coalesce(p.end_sentiment - p.start_sentiment, 0.0) AS sentiment_shift,
        coalesce(p.vol, 0.0) AS sentiment_volatility,
        CASE WHEN p.start_sentiment IS NULL THEN 'none'
             ELSE {q.trend('p.end_sentiment - p.start_sentiment')} END AS sentiment_trend
      FROM ({fx.SQL_SESSIONS}) s LEFT JOIN p USING (session_key))"""


@register("session_progression", f"""
WITH {q.scored_utterances_cte()}, {_SQL_PROGRESSION}
SELECT session_key, file_name, session_date, session_number, patient_id,
       round(start_sentiment, 6) AS start_sentiment, round(end_sentiment, 6) AS end_sentiment,
       round(sentiment_shift, 6) AS sentiment_shift, round(sentiment_volatility, 6) AS sentiment_volatility,
       sentiment_trend
FROM prog""")
def session_progression(spark, sf_dir):
    p = se.session_progression(scored(spark, sf_dir), sessions(spark, sf_dir))
    return p.select(*SESSION_COLS, *[r6(c).alias(c) for c in
                                     ("start_sentiment", "end_sentiment", "sentiment_shift",
                                      "sentiment_volatility")], "sentiment_trend")


from . import queries_more  # noqa: E402,F401  (registers the second half)


# ======================================================== heavier text: documents
SQL_DOCUMENTS = ("SELECT doc_id AS session_key, CAST(0 AS BIGINT) AS dialogue_idx, source AS speaker, text, "
                 "doc_id % 10 AS patient_id FROM documents")


def document_utterances(spark, sf_dir) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("session_key"), F.lit(0).cast("bigint").alias("dialogue_idx"),
                    F.col("source").alias("speaker"), "text", (F.col("doc_id") % 10).alias("patient_id"))


@register("document_sentiment", f"""
WITH {q.scored_utterances_cte(SQL_DOCUMENTS)}
SELECT session_key AS doc_id, speaker AS source, pos_score, neg_score, neu_score, compound_score,
       {q.polarity('compound_score')} AS sentiment_category
FROM scored""")
def document_sentiment(spark, sf_dir):
    """A1-A6 over whole documents (up to 20,000 words each)."""
    p = pp.preprocess(document_utterances(spark, sf_dir), FIXTURE_TEXT)
    s = se.score_utterances(p, fx.lexicon_df(spark), fx.boosters_df(spark), fx.negators_df(spark))
    return s.select(F.col("session_key").alias("doc_id"), F.col("speaker").alias("source"), "pos_score",
                    "neg_score", "neu_score", "compound_score", "sentiment_category")


@register("document_tokens", f"""
SELECT doc_id, array_to_string({_TOKS}, ' ') AS tokens_text, CAST(len({_TOKS}) AS INTEGER) AS token_count
FROM documents WHERE length(text) > 0""")
def document_tokens(spark, sf_dir):
    """P1-P8 over whole documents (fixture stop list, no lemma table)."""
    p = pp.preprocess(document_utterances(spark, sf_dir), FIXTURE_TEXT)
    return p.where(tx.has_text("text")).select(
        F.col("session_key").alias("doc_id"), F.array_join("tokens", " ").alias("tokens_text"), "token_count")
