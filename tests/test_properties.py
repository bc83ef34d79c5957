"""Properties of the scorer and roll-ups on the driver data."""

import os

import pytest
from pyspark.sql import functions as F

from parlance.operators import preprocess as pp
from parlance.operators import sentiment as se
from parlance.plans import catalog as c
from parlance.plans import fixtures as fx

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_score_ranges_and_shares(spark):
    s = c.scored(spark, SF)
    bad = s.where((F.abs("compound_score") > 1)
                  | ((F.abs(F.col("pos_score") + F.col("neg_score") + F.col("neu_score") - 1) > 0.0021)
                     & ((F.col("pos_score") + F.col("neg_score") + F.col("neu_score")) != 0))).count()
    assert bad == 0


def test_counts_add_up_and_short_sessions(spark):
    s = c.scored(spark, SF)
    ss = se.session_sentiment(s, c.sessions(spark, SF))
    assert ss.where(F.col("positive_count") + F.col("neutral_count") + F.col("negative_count")
                    != F.col("scored_count")).count() == 0
    assert ss.agg(F.sum("scored_count")).first()[0] == s.count()
    prog = se.session_progression(s, c.sessions(spark, SF))
    n = s.groupBy("session_key").count()
    one = prog.join(n.where(F.col("count") <= 1), "session_key")
    assert one.where(F.col("start_sentiment") != F.col("end_sentiment")).count() == 0


def test_invariant_to_input_partitioning(spark):
    u = fx.utterances(spark.read.parquet(f"{SF}/conversations.parquet"))
    lex, bst, neg = fx.lexicon_df(spark), fx.boosters_df(spark), fx.negators_df(spark)

    def run(df):
        p = pp.preprocess(df, c.FIXTURE_TEXT)
        return sorted(tuple(r) for r in se.score_utterances(p, lex, bst, neg)
                      .select("session_key", "dialogue_idx", "compound_score", "pos_score").collect())

    assert run(u.repartition(1)) == run(u.repartition(13, "speaker"))


def test_session_tokens_equal_concatenated_utterance_tokens(spark):
    """Cleaning the joined text gives the concatenation of the utterance tokens."""
    from parlance.functions import text as tx
    st = pp.session_text(c.processed(spark, SF, False))
    again = st.select("session_key", "combined_tokens",
                      tx.filter_tokens(tx.word_tokens(tx.clean_text("combined_text")), fx.STOPWORDS, 3)
                      .alias("recleaned"))
    assert again.where(F.col("combined_tokens") != F.col("recleaned")).count() == 0
