"""Fixed StructTypes of the library's tables."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = T.MapType(T.StringType(), T.StringType())
DIALOGUE_ENTRY = T.StructType([
    T.StructField("speaker", T.StringType()),
    T.StructField("text", T.StringType()),
])

SESSIONS = T.StructType([
    T.StructField("session_key", T.LongType(), False),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("metadata", METADATA),
    T.StructField("raw_content", T.StringType()),
    T.StructField("session_date", T.DateType()),
    T.StructField("session_number", T.IntegerType()),
    T.StructField("dialogue", T.ArrayType(DIALOGUE_ENTRY)),
])

UTTERANCES = T.StructType([
    T.StructField("session_key", T.LongType(), False),
    T.StructField("dialogue_idx", T.LongType(), False),
    T.StructField("speaker", T.StringType()),
    T.StructField("text", T.StringType()),
])

REJECTS = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("error", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])
BOOSTERS = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("scalar", T.DoubleType(), False),
])
TERMS = T.StructType([T.StructField("term", T.StringType(), False)])
LEMMAS = T.StructType([
    T.StructField("surface", T.StringType(), False),
    T.StructField("lemma", T.StringType(), False),
])
IDIOMS = T.StructType([
    T.StructField("phrase", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])

TOPIC_TERMS = T.StructType([
    T.StructField("topic_id", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
    T.StructField("weight", T.DoubleType(), False),
])
TOPIC_PROB = T.StructType([
    T.StructField("topic_id", T.IntegerType(), False),
    T.StructField("prob", T.DoubleType(), False),
])
MIXTURE = T.ArrayType(TOPIC_PROB)
