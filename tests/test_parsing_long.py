"""Transcripts of thousands of lines parse in linear time."""

import time

from pyspark.sql import functions as F

from parlance.sources import transcripts as tr


def test_long_transcripts(spark):
    n = 1000
    colon = "\n".join(f"{'Ann' if i % 2 else 'Bob'}: line {i}\nmore {i}\n" for i in range(n))
    bold = "\n".join(f"**{'Ann' if i % 2 else 'Bob'}**\n line {i} \n" for i in range(n))
    df = spark.createDataFrame([(1, colon, bold)], "session_key long, colon string, bold string")
    began = time.time()
    c = tr.utterances_of(tr.colon_dialogue(df, "colon")).orderBy("dialogue_idx").collect()
    b = tr.utterances_of(tr.bold_dialogue(df, "bold")).orderBy("dialogue_idx").collect()
    assert time.time() - began < 60
    assert [(r["speaker"], r["text"]) for r in c] == [("Ann" if i % 2 else "Bob", f"line {i} more {i}") for i in range(n)]
    assert [(r["speaker"], r["text"]) for r in b] == [("Ann" if i % 2 else "Bob", f"line {i}") for i in range(n)]


def test_amplifier_needs_never(spark):
    from parlance.operators import sentiment as se
    texts = ["we love this great day", "we love that great day", "never so great day", "never this great day"]
    u = spark.createDataFrame([(1, i, "a", t, t) for i, t in enumerate(texts)],
                              "session_key long, dialogue_idx long, speaker string, text string, processed_text string")
    lex = spark.createDataFrame([("great", 3.1), ("love", 3.2)], "term string, valence double")
    neg = spark.createDataFrame([("never",)], "term string")
    got = [r["compound_score"] for r in se.score_utterances(u, lex, None, neg).orderBy("dialogue_idx").collect()]
    assert got[0] == got[1] and got[2] > 0 and got[3] > 0
