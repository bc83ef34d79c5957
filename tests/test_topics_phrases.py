"""Topics from token positions, the distributed dictionary, phrase joins and null groups against plain Python."""

import math
import random
from collections import Counter

from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from parlance.functions import ordering
from parlance.operators import progress as pg
from parlance.operators import sentiment as se
from parlance.operators import topics as tp
from parlance.options import TopicOptions


def talk(spark, seed=3, sessions=6):
    rng = random.Random(seed)
    rows = []
    for s in range(sessions):
        for i in range(rng.randint(1, 40) if s else 700):  # the first session holds most rows
            rows.append((s, i * 2, [rng.choice("abcdefghijklmno") * 3 for _ in range(rng.randint(0, 9))]))
    return rows, spark.createDataFrame(rows, "session_key long, dialogue_idx long, tokens array<string>").repartition(5)


def both_grains(rows):
    docs = {}
    for s, i, t in sorted(rows):
        if t:
            docs[("dialogue", s, i)] = t
            docs[("transcript", s, -1)] = docs.get(("transcript", s, -1), []) + t
    return docs


def test_corpus_counts_positions_and_dictionary(spark):
    rows, df = talk(spark)
    docs, c = both_grains(rows), tp.corpus(df)
    assert {(r.doc_type, r.session_key, r.dialogue_idx): r.n_tokens for r in c.docs.collect()} == {k: len(v) for k, v in docs.items()}
    want = {(*k, t): n for k, v in docs.items() for t, n in Counter(v).items()}
    assert {(r.doc_type, r.session_key, r.dialogue_idx, r.term): r["count"] for r in c.counts.collect()} == want
    terms = spark.createDataFrame([("aaa",), ("ccc",), ("zzz",)], "term string")
    got = sorted((r.doc_type, r.session_key, r.dialogue_idx, r.p, r.term, r.n_tokens) for r in c.occurrences(terms).collect())
    assert got == sorted((*k, i, t, len(v)) for k, v in docs.items() for i, t in enumerate(v) if t in ("aaa", "ccc"))
    df_of = Counter(t for v in docs.values() for t in set(v))
    kept = sorted(((-n, t) for t, n in df_of.items() if n >= 5 and n <= math.floor(0.9 * len(docs))))
    vocab = tp.vocabulary(c, TopicOptions())
    assert [(r.term, r.df) for r in vocab.orderBy("term_index").collect()] == [(t, -n) for n, t in kept]
    assert [r.term_index for r in vocab.orderBy("term_index").collect()] == list(range(len(kept)))


def test_feature_vectors_are_the_counts(spark):
    rows, df = talk(spark, 4)
    rows.append((99, 0, ["zzzz"]))
    df = df.unionByName(spark.createDataFrame(rows[-1:], df.schema))
    c = tp.corpus(df)
    vocab = tp.vocabulary(c, TopicOptions(min_df=3, max_df=0.95))
    at = {r.term: r.term_index for r in vocab.collect()}
    got = {(r.doc_type, r.session_key, r.dialogue_idx): r.features for r in tp.feature_vectors(c, vocab, len(at)).collect()}
    for k, tokens in both_grains(rows).items():
        n = Counter(at[t] for t in tokens if t in at)
        assert got[k] == SparseVector(len(at), sorted(n.items()))
    assert len(got) == len(both_grains(rows)) and got[("dialogue", 99, 0)].numNonzeros() == 0


def test_coherence_of_several_models_is_that_of_each(spark):
    rows, df = talk(spark, 5, 4)
    rng = random.Random(1)
    terms = [(k, t, "abcdefghijklmno"[(t * 4 + i) % 15] * 3, rng.random()) for k in (2, 3) for t in range(k) for i in range(4)]
    both = spark.createDataFrame(terms, "k int, topic_id int, term string, weight double")
    c = tp.corpus(df)
    many = {(r.k, r.topic_id): r.coherence for r in tp.coherence_cv(both, c, 4, 20, 16, models=["k"]).collect()}
    for k in (2, 3):
        one = tp.coherence_cv(both.where(F.col("k") == k).drop("k"), c, 4, 20).collect()
        assert len(one) == k + 1
        for r in one:  # also: cutting the windows into small blocks changes nothing
            assert math.isclose(many[k, r.topic_id], r.coherence, rel_tol=1e-9)


def test_topics_along_a_session(spark):
    mix = [("dialogue", s, i, [(i % 2, 0.75), (2, 0.25)]) for s, n in ((1, 7), (2, 1), (3, 2)) for i in range(n)]
    mix.append(("transcript", 1, -1, [(0, 1.0)]))
    df = spark.createDataFrame(mix, "doc_type string, session_key long, dialogue_idx long, "
                                    "topic_distribution array<struct<topic_id:int,prob:double>>")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "session_key long")
    got = {(r.session_key, r.part, r.topic_id): (round(r.prevalence, 6), r.utterances) for r in tp.topics_along_session(df, ids).collect()}
    parts = {}
    for s, n in ((1, 7), (2, 1), (3, 2)):
        for i in range(n):
            parts.setdefault((s, i * 3 // n + 1), []).append(i)
    want = {}
    for (s, part), rows in parts.items():
        for i in rows:
            for t, p in ((i % 2, 0.75), (2, 0.25)):
                want[s, part, t] = want.get((s, part, t), 0) + p / len(rows)
    assert {k: v[0] for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}
    assert got[1, 1, 2][1] == len(parts[1, 1])


def test_a_hundred_thousand_phrases(spark):
    n = 100_000
    phrases = spark.range(n).select(
        F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" of x"), (F.col("id") % 977).cast("string")).alias("phrase"),
        (F.col("id") % 7 - 3.0).cast("double").alias("valence"))
    texts = ["aa bb cc w5 of x5", "aa bb cc w99999 of x349 end", "aa bb cc w8 of x9", "bb cc dd kk"]
    u = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(texts)],
                              "session_key long, dialogue_idx long, text string, processed_text string")
    lex = spark.createDataFrame([("x5", 1.0), ("x349", 1.0), ("x9", 1.0), ("kk", 1.0)], "term string, valence double")
    got = [r.compound_score for r in se.score_utterances(u, lex, idioms=phrases).orderBy("dialogue_idx").collect()]
    score = lambda v: round(v / math.sqrt(v * v + 15), 4)
    assert got == [score(5 % 7 - 3.0), score(99_999 % 7 - 3.0), score(1.0), score(1.0)]


def test_idiom_positions_follow_the_scorer(spark):
    """An idiom that ends before the word, at it or starts with it; the later lookups win."""
    idioms = [("good day", 2.0), ("day good", -1.0), ("a good", 3.0), ("a good day", 4.0), ("xx yy good", -2.0)]
    texts = ["pp qq rr good day", "pp qq day good rr", "pp qq xx yy good", "pp qq rr good", "good day rr"]
    u = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(texts)],
                              "session_key long, dialogue_idx long, text string, processed_text string")
    lex = spark.createDataFrame([("good", 1.5)], "term string, valence double")
    got = [r.compound_score for r in se.score_utterances(u, lex, idioms=idioms).orderBy("dialogue_idx").collect()]
    score = lambda v: round(v / math.sqrt(v * v + 15), 4)
    assert got == [score(2.0), score(-1.0), score(-2.0), score(1.5), score(1.5)]  # the first three words know no idiom


def test_sessions_without_a_client_stay(spark):
    rows = [("a" if k % 3 else None, k, k, f"2024-01-{k + 1:02d}", k / 10 * (-1) ** k, "neutral") for k in range(9)]
    f = spark.createDataFrame(rows, "patient_id string, session_key long, transcript_idx long, day string, avg_compound double, "
                                    "overall_sentiment string").withColumn("session_date", F.to_date("day")).drop("day")
    trend = {r.patient_id: r for r in pg.corpus_trend(f, ["patient_id"]).collect()}
    for client, mine in ((None, [0, 3, 6]), ("a", [1, 2, 4, 5, 7, 8])):
        v = [k / 10 * (-1) ** k for k in mine]
        assert trend[client].sessions == len(mine)
        assert math.isclose(trend[client].between_session_volatility, sum(abs(a - b) for a, b in zip(v, v[1:])) / (len(v) - 1))
    assert pg.moving_average(f, 3, ["patient_id"]).count() == 9
    assert pg.change_flags(f, 0.05, ["patient_id"]).where("delta IS NULL").count() == 2
    idx = ordering.dense_index(f.drop("transcript_idx").withColumn("session_number", F.lit(1)).withColumn("file_name", F.lit("x")),
                               ordering.session_order(), "transcript_idx", ["patient_id"])
    assert sorted(r.transcript_idx for r in idx.where("patient_id IS NULL").collect()) == [0, 1, 2]


def test_running_sums_over_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", None, "b"]), i, rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(7)
    got = {(r.g, r.i): (r.n, r.s) for r in ordering.running_sums(df, ["g"], ["i"], {"n": F.lit(1), "s": F.col("v")}).collect()}
    seen = {}
    for g, i, v in rows:
        n, s = seen.get(g, (0, 0))
        assert got[g, i] == (n, s)
        seen[g] = (n + 1, s + v)
    assert len(got) == 3000
