"""Dictionaries meet tokens without a shuffle of every token and its text; what is read twice is made once."""

import pytest
from pyspark.sql import functions as F

from parlance.functions.ordering import rank_within
from parlance.operators import charts as ch
from parlance.operators import lookup
from parlance.operators import preprocess as pp
from parlance.operators import prompt_parts as pt
from parlance.operators import sentiment as se
from parlance.operators import topics as tp
from parlance.options import TextOptions
from parlance.session import broadcast_dictionary, stored

OPTS = TextOptions(stopwords=("the",), custom_stopwords=())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def said(spark):
    return spark.createDataFrame(
        [(1, 0, "Client", "Geese and geese see the gander"), (1, 1, "Client", None), (1, 2, "Therapist", ""),
         (2, 0, "Client", "ox cart"), (2, 0, "Client", "mice geese"), (None, 3, "Client", "oxen mice"), (3, 0, None, "the")],
        "session_key long, dialogue_idx long, speaker string, text string")


@pytest.fixture()
def lemmas(spark):
    return spark.createDataFrame([("geese", "goose"), ("geese", "zoo"), ("mice", "mouse"), ("oxen", None), (None, "x"), ("cart", "Wagen\"\\")],
                                 "surface string, lemma string")


def _rows(df):
    return sorted(df.select("session_key", "dialogue_idx", "tokens", "token_count").collect(), key=str)


def test_lemmas_need_no_row_per_token(spark, said, lemmas):
    plan = _plan(pp.preprocess(said, OPTS, lemmas=lemmas))
    assert "Join" not in plan and "posexplode" not in plan


def test_small_and_large_lemma_tables_agree(spark, said, lemmas, monkeypatch):
    small = _rows(pp.preprocess(said, OPTS, lemmas=lemmas))
    assert [r["tokens"] for r in small if r["session_key"] == 1 and r["dialogue_idx"] == 0] == [["goose", "and", "goose", "see", "gander"]]
    # rows of one key are one row, with the tokens of both by position
    assert [sorted(r["tokens"]) for r in small if r["session_key"] == 2] == [["Wagen\"\\", "goose", "mouse"]]
    assert [r["tokens"] for r in small if r["session_key"] is None] == [["oxen", "mouse"]]
    monkeypatch.setattr(lookup, "INLINE_ENTRIES", 2)
    joined = pp.preprocess(said, OPTS, lemmas=lemmas)
    assert "BroadcastHashJoin" in _plan(joined) and "SortMergeJoin" not in _plan(joined)
    assert _rows(joined) == small
    monkeypatch.setattr(lookup, "broadcast_dictionary", lambda d: d)  # a dictionary too large to broadcast
    shuffled = pp.preprocess(said, OPTS, lemmas=lemmas)
    assert "SortMergeJoin" in _plan(shuffled) and _rows(shuffled) == small


def test_scored_tokens_meet_a_broadcast_dictionary(spark, said):
    lexicon = spark.createDataFrame([("geese", 1.5), ("ox", -1.0)], "term string, valence double")
    boosters = spark.createDataFrame([("very", 0.293), ("sort of", -0.293)], "term string, scalar double")
    s = se.score_utterances(pp.preprocess(said.where("session_key < 3"), OPTS), lexicon, boosters)
    assert "SortMergeJoin" not in _plan(s)
    got = {(r["session_key"], r["dialogue_idx"], r["text"]): r["compound_score"] for r in s.collect()}
    assert got[1, 0, "Geese and geese see the gander"] > 0


def test_size_of_a_dictionary_is_counted(spark):
    d = spark.createDataFrame([("a" * 100, 1.0)], "term string, v double")
    assert "ResolvedHint" in broadcast_dictionary(d)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_dictionary(d, max_bytes=100)._jdf.queryExecution().analyzed().toString()


def test_text_is_processed_once(spark, said, lemmas):
    """Corpus, counts and histogram read what was written, not the raw text again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(t):
        seen.add(1)
        return t

    p = pp.preprocess(said.where("session_key = 1").withColumn("text", look("text")), OPTS, lemmas=lemmas)
    c = tp.corpus(p)
    after = seen.value
    v = tp.vocabulary(c)
    tp.bag_of_words(c, v).collect()
    tp.tfidf(c).collect()
    assert after > 0 and seen.value == after
    scores = spark.createDataFrame([(0.5,), (-0.5,)], "compound_score double").withColumn("compound_score", look("compound_score").cast("double"))
    ch.compound_histogram(scores, 2).collect()
    assert seen.value == after + 2


def test_tokens_are_counted_inside_the_row(spark):
    """A row's counts and stretches are made where its tokens are, also those of null and empty words."""
    lists = [["b", "a", "b", "a", "b"], ["x"], ["", None, "", None], ["a"] * 3 + ["b"] * 9 + ["a"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, tokens array<string>")
    counts = df.select("i", F.explode(tp.term_counts(F.col("tokens"))).alias("c")).select("i", "c.*")
    assert "Exchange" not in _plan(counts)
    assert {(r["i"], r["term"], r["count"]) for r in counts.collect()} == {
        (i, w, t.count(w)) for i, t in enumerate(lists) for w in t}
    got = df.where("i in (0, 3)").select("i", F.explode(tp.term_stretches(F.col("tokens"), 2)).alias("c")).select("i", "c.*").collect()
    assert sorted(map(tuple, got)) == [(0, "a", 1, 3), (0, "b", 0, 4), (3, "a", 0, 2), (3, "a", 12, 12), (3, "b", 3, 11)]


def test_packed_token_lists_lose_nothing(spark):
    lists = [None, [], [""], ["", ""], ["a", None], [None], ["a" + lookup.SEPARATOR + "b"], ["a", lookup.SEPARATOR], ["a", "b c", ""]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, tokens array<string>")
    back = df.select("i", lookup.packed("tokens").alias("p")).select("i", lookup.unpacked("p").alias("t")).orderBy("i").collect()
    assert [r["t"] for r in back] == lists


def test_corpus_with_repeated_keys_counts_them_together(spark):
    rows = [(1, 0, ["a", "b"]), (1, 0, ["a"]), (1, 1, ["a"]), (None, 0, ["b"]), (None, None, ["b"])]
    c = tp.corpus(spark.createDataFrame(rows, "session_key long, dialogue_idx long, tokens array<string>"))
    got = {(r["doc_type"], r["session_key"], r["dialogue_idx"], r["term"]): r["count"] for r in c.counts.collect()}
    assert got == {("dialogue", 1, 0, "a"): 2, ("dialogue", 1, 0, "b"): 1, ("dialogue", 1, 1, "a"): 1, ("dialogue", None, 0, "b"): 1,
                   ("dialogue", None, None, "b"): 1, ("transcript", 1, -1, "a"): 3, ("transcript", 1, -1, "b"): 1,
                   ("transcript", None, -1, "b"): 2}
    assert {r["term"]: r["df"] for r in tp.document_frequency(c).collect()} == {"a": 3, "b": 5}


def test_counts_meet_a_broadcast_vocabulary(spark):
    """The vocabulary is as small as it is, not as large as the counts it was made of; utterance counts need no shuffle."""
    rows = [(s, i, ["a", "b", "a", "w%d" % (i % 3)]) for s in range(20) for i in range(5)]
    c = tp.corpus(spark.createDataFrame(rows, "session_key long, dialogue_idx long, tokens array<string>"))
    assert c.unique
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (tp.bag_of_words(c, tp.vocabulary(c)), tp.tfidf(c)):
            plan = _plan(df)
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
            df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prompt_parts_read_the_entries_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(t):
        seen.add(1)
        return t

    said = spark.createDataFrame([(s, i, "Client", "word " * 9) for s in (1, 2) for i in range(5)],
                                 "session_key long, dialogue_idx long, speaker string, text string").withColumn("text", look("text"))
    sessions = spark.createDataFrame([(1, 0, 1, None), (2, 1, 2, None)],
                                     "session_key long, transcript_idx long, session_number int, session_date date")
    info = "session_key long, {} string"
    parts = pt.progress_prompt_parts(sessions, said, spark.createDataFrame([], info.format("sentiment_info")),
                                     spark.createDataFrame([], info.format("topic_info")), budget=200).collect()
    assert len(parts) > 1 and sum(p["prompt"].count("word") for p in parts) == 90 and seen.value == 10


def test_stretches_of_an_utterance_are_made_in_its_row(spark):
    rows = [(1, 0, list("abab")), (1, 1, list("ccca")), (2, 0, list("a")), (None, 0, list("bca"))]
    c = tp.corpus(spark.createDataFrame(rows, "session_key long, dialogue_idx long, tokens array<string>"))
    alone, met = c.stretches(spark.createDataFrame([("a",), ("c",)], "term string"), 2)
    keys = ("session_key", "dialogue_idx", "n_tokens", "term", "first", "last")
    assert {tuple(r[k] for k in keys) for r in alone.collect()} == {
        (1, 0, 4, "a", 0, 2), (1, 1, 4, "a", 3, 3), (1, 1, 4, "c", 0, 2), (2, 0, 1, "a", 0, 0), (None, 0, 3, "a", 2, 2), (None, 0, 3, "c", 1, 1)}
    assert {tuple(r[k] for k in keys) for r in met.collect()} == {
        (1, -1, 8, "a", 0, 2), (1, -1, 8, "a", 7, 7), (1, -1, 8, "c", 4, 6), (2, -1, 1, "a", 0, 0), (None, -1, 3, "a", 2, 2), (None, -1, 3, "c", 1, 1)}


def test_rank_shuffles_the_rows_once(spark):
    """Window and offsets meet by one key: the rows are not shuffled again, and null keys are a group."""
    rows = [(s, i, "x") for s in (1, 2, None) for i in range(7)] + [(5, 3, "x"), (5, None, "x")]
    df = spark.createDataFrame(rows, "session_key long, i long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = rank_within(df, ["session_key"], "i", "rk", "n", block=3)
        assert _plan(r).count("hashpartitioning") == 4  # rows; counts: by block, by group, with the rows
        got = sorted(((x["session_key"] or 0, x["rk"], x["n"], x["i"]) for x in r.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert r.columns == ["session_key", "i", "text", "n", "rk"]
    assert got == sorted([(s, i + 1, 7, i) for s in (0, 1, 2) for i in range(7)] + [(5, 1, 2, None), (5, 2, 2, 3)], key=str)


def test_parts_of_a_session_rank_once(spark):
    rows = [(s, i) for s, n in ((1, 1), (2, 2), (3, 7), (4, 9)) for i in range(n)]
    mix = spark.createDataFrame(rows, "session_key long, dialogue_idx long").select(
        F.lit("dialogue").alias("doc_type"), "*", F.expr("array(named_struct('topic_id', 0, 'prob', 1.0D))").alias("topic_distribution"))
    t = tp.topics_along_session(mix, mix.select("session_key").distinct())
    assert _plan(t).count("row_number()") == 1
    sizes = {}
    for x in t.collect():
        assert x["prevalence"] == 1.0
        sizes.setdefault(x["session_key"], {})[x["part"]] = x["utterances"]
    assert sizes == {1: {1: 1}, 2: {1: 1, 2: 1}, 3: {1: 3, 2: 2, 3: 2}, 4: {1: 3, 2: 3, 3: 3}}


def test_what_is_written_is_compressed(spark):
    words = spark.range(20000).select(F.array(*[F.concat(F.lit("word"), (F.col("id") * k % 9973).cast("string"))
                                                for k in range(1, 9)]).alias("tokens"))
    t = stored(words, "tokens")
    assert all(f.endswith(".zstd.parquet") for f in t.inputFiles())
    assert t.exceptAll(words).isEmpty() and t.count() == 20000
