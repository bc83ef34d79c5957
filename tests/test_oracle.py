"""DuckDB oracle on the smallest scale for a sample of registered queries.

The full catalogue is checked with ``python tests/oracle_check.py /root/testdata/sf0.01``.
"""

import os

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = ["clean_text", "tokens", "utterance_sentiment", "session_progression", "session_index_global",
          "transcript_roundtrip", "vocabulary", "topic_prevalence", "corpus_trend", "session_facts",
          "chart_compound_histogram", "summary_prompts"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, name):
    r = compare(spark, SF, name, E.queries()[name], E.oracle_sql()[name], duck(SF))
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "sentiment_trend" in df.columns
