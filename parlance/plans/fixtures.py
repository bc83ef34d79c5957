"""Test fixtures derived from the driver tables, written once for Spark and DuckDB.

``conversations(conv_id, turn, role, text)`` *is* an utterance table.  The
derivations below (speaker, dates, numbers, patient) and the small inline
reference tables are the same on both engines: Spark builds DataFrames from
them, the oracle SQL embeds them as ``VALUES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Fixture lexicon (term, valence) over frequent fixture words.
LEXICON = [("the", 0.5), ("and", 1.2), ("of", -0.8), ("in", -1.5), ("der", 1.0),
           ("die", -1.1), ("que", 0.9), ("le", -0.4), ("to", 1.9), ("la", -0.6),
           ("des", 0.7), ("von", -1.3)]
# Fixture boosters (term, scalar); bigram entries act only in the idiom step.
BOOSTERS = [("is", 0.293), ("was", 0.293), ("de", 0.293), ("it", -0.293),
            ("for", -0.293), ("very", 0.293), ("sort of", -0.293)]
# Fixture negators.
NEGATORS = ["on", "with", "not", "never", "nicht", "pas"]
# Fixture stop words (replace the English list in oracle checks).
STOPWORDS = ["is", "that", "it", "for", "was", "on", "as", "with", "by", "be", "from",
             "this", "are", "an", "at", "he", "or", "und", "en", "es", "el"]
# Fixture lemma table (surface -> lemma).
LEMMAS = [("tion", "tio"), ("ther", "there"), ("than", "then"), ("les", "le"),
          ("des", "de"), ("den", "de"), ("von", "vo"), ("thre", "three"), ("gas", "ga")]
# The scorer's special-case idioms (phrase -> valence).
IDIOMS = [("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("yeah right", -2.0),
          ("cut the mustard", 2.0), ("kiss of death", -1.5), ("hand to mouth", -2.0)]

#: conversations of this client have no client key: a group of null keys in every query by client
NO_PATIENT = 3
NUM_FIXED_TOPICS = 5
TERMS_PER_FIXED_TOPIC = 20


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values_sql(rows, cols: list[str]) -> str:
    """``(VALUES ...) AS t(cols)`` text for DuckDB."""
    body = []
    for r in rows:
        r = r if isinstance(r, tuple) else (r,)
        body.append("(" + ", ".join(_sql_str(v) if isinstance(v, str) else repr(float(v))
                                    for v in r) + ")")
    return f"(VALUES {', '.join(body)}) AS t({', '.join(cols)})"


def lexicon_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, S.LEXICON)


def boosters_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOOSTERS, S.BOOSTERS)


def negators_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in NEGATORS], S.TERMS)


def lemmas_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMAS, S.LEMMAS)


def idioms_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(IDIOMS, S.IDIOMS)


# ---------------------------------------------------------------- derivations
def speaker_col() -> F.Column:
    r = F.col("role")
    return F.when(r == "user", "Client").when(r == "assistant", "Therapist").otherwise("")


def session_date_col(key: str = "conv_id") -> F.Column:
    k = F.col(key)
    return F.when(k % 17 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit("2023-01-01").cast("date"), (k * 7).cast("int")))


def utterances(conversations: DataFrame) -> DataFrame:
    """FIXTURES §2: one utterance per conversation turn, plus the patient key."""
    return conversations.select(
        F.col("conv_id").alias("session_key"),
        F.col("turn").alias("dialogue_idx"),
        speaker_col().alias("speaker"),
        F.col("text"),
        F.nullif(F.col("conv_id") % 10, F.lit(NO_PATIENT)).alias("patient_id"),
    )


def sessions(conversations: DataFrame) -> DataFrame:
    """Metadata-only session table (one row per conversation; no text carried)."""
    keys = conversations.select("conv_id").distinct()
    return keys.select(
        F.col("conv_id").alias("session_key"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".txt")).alias("file_name"),
        session_date_col().alias("session_date"),
        (F.col("conv_id") % 13).cast("int").alias("session_number"),
        F.nullif(F.col("conv_id") % 10, F.lit(NO_PATIENT)).alias("patient_id"),
    )


# SQL twins of the derivations above.
SQL_SPEAKER = "CASE WHEN role = 'user' THEN 'Client' WHEN role = 'assistant' THEN 'Therapist' ELSE '' END"
SQL_SESSION_DATE = ("CASE WHEN conv_id % 17 = 0 THEN NULL "
                    "ELSE DATE '2023-01-01' + CAST(conv_id * 7 AS INTEGER) END")
SQL_UTTERANCES = (f"SELECT conv_id AS session_key, turn AS dialogue_idx, {SQL_SPEAKER} AS speaker, "
                  f"text, nullif(conv_id % 10, {NO_PATIENT}) AS patient_id FROM conversations")
SQL_SESSIONS = ("SELECT conv_id AS session_key, 'conv_' || CAST(conv_id AS VARCHAR) || '.txt' AS file_name, "
                f"{SQL_SESSION_DATE} AS session_date, CAST(conv_id % 13 AS INTEGER) AS session_number, "
                f"nullif(conv_id % 10, {NO_PATIENT}) AS patient_id FROM (SELECT DISTINCT conv_id FROM conversations)")


# ------------------------------------------------------------ fixed mixtures
def mixture_weight(conv: F.Column, turn: F.Column, topic: F.Column) -> F.Column:
    return F.lit(1) + (conv * 7 + turn * 3 + topic * 5) % 11


SQL_MIXTURE_WEIGHT = "1 + (conv_id * 7 + turn * 3 + topic_id * 5) % 11"


TRANSCRIPT_TURN = 1000  # stands in for the turn of a session-level document in the weight formula


def fixed_document_topics(docs: DataFrame, k: int = NUM_FIXED_TOPICS) -> DataFrame:
    """FIXTURES §3 mixtures: w = 1 + (conv*7 + turn*3 + topic*5) % 11, prob = w / sum(w)."""
    from ..operators import topics as tp
    turn = F.when(F.col("doc_type") == "transcript", F.lit(TRANSCRIPT_TURN)).otherwise(F.col("dialogue_idx"))
    w = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda t: mixture_weight(F.col("session_key"), turn, t.cast("bigint")))
    tot = F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + x)
    probs = F.transform(w, lambda x: x / tot)
    d = docs.select("doc_type", "session_key", "dialogue_idx",
                    tp.mixture_column(probs, 0.01).alias("topic_distribution"))
    return tp.with_dominant(d)


def fixed_topic_terms(processed: DataFrame, n_topics: int = NUM_FIXED_TOPICS,
                      per_topic: int = TERMS_PER_FIXED_TOPIC) -> DataFrame:
    """Fixture topics: the top n_topics*per_topic terms by count (ties by term), dealt round-robin.

    rank r (0-based) -> topic r % n_topics, weight (N - r) / N with N = n_topics*per_topic.
    """
    n = n_topics * per_topic
    c = processed.where(F.col("tokens").isNotNull()).select(F.explode("tokens").alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("c"))
    top = c.orderBy(F.col("c").desc(), F.col("term").asc()).limit(n)
    from pyspark.sql.window import Window
    r = top.withColumn("r", F.row_number().over(Window.orderBy(F.col("c").desc(), F.col("term").asc())) - 1)
    return r.select((F.col("r") % n_topics).cast("int").alias("topic_id"), "term",
                    ((F.lit(n) - F.col("r")) / F.lit(float(n))).alias("weight"))
