"""Literal cases (FIXTURES §4) and rule checks on small inputs."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from parlance.functions import labels as lb
from parlance.functions import ordering
from parlance.functions import text as tx
from parlance.operators import enrich as en
from parlance.operators import preprocess as pp
from parlance.operators import sentiment as se
from parlance.options import TextOptions
from parlance.plans import fixtures as fx
from parlance.sources import transcripts as tr

# an invented session of ten turns
SESSION_MDX = """---
title: 'Tuesday, second talk'
patient: 'Ida Quist'
therapist: 'M. Oduya'
session_type: 'Pair'
---

Therapist: Where shall we begin today, with the garden or with your brother?

Client: With the garden, please. The frost took the beans, but the good news is that the pears held out.

Therapist: You sound calmer about losses than in spring. What changed?

Client: I wrote the list that we spoke of. Reading it each evening helped, oddly enough.

Therapist: An excellent use of a plain list. Does it reach as far as your brother?

Client: Not yet. He rang on Sunday at 7 and I let it ring, twice.

Therapist: What would you have told him on the second ring?

Client: That the house is too quiet, and that I keep his chair where it was.

Therapist: Would a letter be easier than the telephone?

Client: Perhaps a short one. I could post it with the pears.
"""


def _write(d, name, content, mode="w"):
    with open(os.path.join(d, name), mode, newline="") as f:
        f.write(content)


def _dialogue(spark, content, fmt="txt"):
    d = tempfile.mkdtemp(prefix="parlance-t-")
    _write(d, f"x.{fmt}", content)
    t = tr.read_transcripts(spark, d, fmt)
    return [(r.speaker, r.text) for r in t.utterances.orderBy("dialogue_idx").collect()]


def test_session_mdx(spark):
    d = tempfile.mkdtemp(prefix="parlance-t-")
    _write(d, "session_2023-07-15_new.mdx", SESSION_MDX)
    t = tr.read_transcripts(spark, d, "mdx")
    s = t.sessions.collect()[0]
    assert s.metadata == {"title": "'Tuesday, second talk'", "patient": "'Ida Quist'",
                          "therapist": "'M. Oduya'", "session_type": "'Pair'"}
    assert str(s.session_date) == "2023-07-15" and s.session_number is None
    u = t.utterances.collect()
    assert len(u) == 10
    assert sum(r.speaker == "Therapist" for r in u) == 5 and sum(r.speaker == "Client" for r in u) == 5


def test_plain_text_and_names(spark):
    assert [s for s, _ in _dialogue(spark, "Therapist: How are you feeling today?\nClient: I'm doing better.\n"
                                           "Therapist: Can you tell me more?\n")] == ["Therapist", "Client", "Therapist"]
    names = spark.createDataFrame([("session_2023-05-15_001.mdx",), ("2023-02-30_session_7.txt",)], "n string")
    got = names.select(tr.file_date(F.col("n")).alias("d"), tr.file_number(F.col("n")).alias("k")).collect()
    assert str(got[0].d) == "2023-05-15" and got[0].k == 1
    assert got[1].d is None and got[1].k == 7


def test_segmentation_literals(spark):
    assert _dialogue(spark, "A: x\n  y\n\nz") == [("A", "x   y z")]
    assert _dialogue(spark, "A:\nB: hi") == [("B", "hi")]
    assert _dialogue(spark, "intro\nA: x") == [("A", "x")]
    assert _dialogue(spark, "A: x\nI said: y") == [("A", "x"), ("I said", "y")]
    assert _dialogue(spark, "Thérapeute: oui") == [("Thérapeute", "oui")]
    assert _dialogue(spark, "A: x\r\nB: y") == [("A", "x"), ("B", "y")]
    assert _dialogue(spark, "# t\n**Client**\nhi\nthere\n", "md") == [("Client", "hi there")]


def test_json_alias_and_reject(spark):
    d = tempfile.mkdtemp(prefix="parlance-t-")
    _write(d, "a.json", '{"transcript":[{"speaker":"A","text":"x"}]}')
    _write(d, "b.json", '{"dialogue":')
    t = tr.read_transcripts(spark, d, "json")
    assert [(r.speaker, r.text) for r in t.utterances.collect()] == [("A", "x")]
    assert t.sessions.collect()[0].metadata == {}
    assert t.rejects.count() == 1


def test_missing_dir_is_empty(spark):
    t = tr.read_transcripts(spark, "/nonexistent/parlance", "mdx")
    assert t.sessions.count() == 0 and t.utterances.count() == 0


def test_cleaning_literal(spark):
    df = spark.createDataFrame([("See HTTPS://a.b/c now! It's 42",)], "text string")
    assert df.select(tx.clean_text("text").alias("c")).first().c == "see now it s"


def test_lemma_after_length(spark):
    u = spark.createDataFrame([(1, 0, "A", "gas gas xy")], "session_key long, dialogue_idx long, speaker string, text string")
    out = pp.preprocess(u, TextOptions(stopwords=(), custom_stopwords=()), lemmas=fx.lemmas_df(spark)).first()
    assert out.tokens == ["ga", "ga"]


def test_label_and_tone_bounds(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,)], "x double")
    assert [r.l for r in df.select(lb.polarity_label("x").alias("l")).collect()] == ["positive", "negative", "neutral"]
    df = spark.createDataFrame([(0.5,), (0.05,), (0.0,), (-0.05,), (-0.5,)], "x double")
    assert [r.t for r in df.select(lb.tone_description("x").alias("t")).collect()] == [
        "positive", "slightly positive", "neutral", "negative", "very negative"]


def _score(spark, texts, idioms=None):
    u = spark.createDataFrame([(1, i, "A", t) for i, t in enumerate(texts)],
                              "session_key long, dialogue_idx long, speaker string, text string")
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "term string, valence double")
    bst = spark.createDataFrame([("very", 0.293)], "term string, scalar double")
    neg = spark.createDataFrame([("not",)], "term string")
    s = se.score_utterances(u, lex, bst, neg, idioms=idioms)
    return {r.dialogue_idx: r for r in s.collect()}


def _compound(x):
    return round(x / math.sqrt(x * x + 15), 4)


def test_scorer_rules(spark):
    r = _score(spark, ["good", "very good", "not good", "good but bad", "x"])
    assert r[0].compound_score == _compound(1.9)
    assert r[1].compound_score == _compound(1.9 + 0.293)
    assert r[2].compound_score == _compound(1.9 * -0.74)
    assert r[3].compound_score == _compound(1.9 * 0.5 + -2.5 * 1.5)
    assert r[4].compound_score == 0.0 and r[4].neu_score == 0.0  # one-character token only
    assert abs(r[0].pos_score + r[0].neg_score + r[0].neu_score - 1) < 1e-9


def test_idiom_rule(spark):
    r = _score(spark, ["a b c the bomb"], idioms=fx.IDIOMS)
    # 'bomb' is not in the lexicon, so no valence is produced even with the idiom table
    assert r[0].compound_score == 0.0


def test_progression_thirds(spark):
    rows = []
    for key, n in ((1, 1), (2, 2), (3, 3), (7, 7)):
        rows += [(key, i, "A", float(i)) for i in range(n)]
    sc = spark.createDataFrame(rows, "session_key long, dialogue_idx long, speaker string, compound_score double")
    sessions = spark.createDataFrame([(k,) for k in (1, 2, 3, 7, 9)], "session_key long")
    p = {r.session_key: r for r in se.session_progression(sc, sessions).collect()}
    assert p[1].start_sentiment == 0.0 and p[1].end_sentiment == 0.0
    assert p[2].start_sentiment == 0.0 and p[2].end_sentiment == 1.0
    assert p[7].start_sentiment == 0.5 and p[7].end_sentiment == 5.5  # thirds of 2
    assert p[9].start_sentiment is None and p[9].sentiment_trend == "none" and p[9].sentiment_volatility == 0.0


def test_reply_sections(spark):
    df = spark.createDataFrame([("Summary:\n\nShort.\n\nKey insights: a\n\nEmotional tone: b\n\nFocus: c",),
                                ("hello",)], "r string")
    out = df.select(en.parse_reply(F.col("r")).alias("p")).collect()
    a, b = out[0].p, out[1].p
    assert a.summary == "Short." and len(a.insights) == 1 and len(a.emotional_themes) == 1
    assert len(a.therapeutic_focus) == 1
    assert b.summary == "hello"


def test_dense_index_global(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("session_key"),
                                     (F.col("id") % 7).alias("session_number"),
                                     F.lit(None).cast("date").alias("session_date"),
                                     F.lit("f").alias("file_name")).repartition(5)
    out = ordering.dense_index(df, ordering.session_order(), "i").collect()
    assert len(out) == 1000
    assert sorted(r.i for r in out) == list(range(1000))
    first = min(out, key=lambda r: r.i)
    assert first.session_number == 1  # 0 counts as missing and sorts last


def test_streaming_ingest(spark):
    from parlance.streaming import ingest
    from parlance.streaming.ingest import start_scoring
    d = tempfile.mkdtemp(prefix="parlance-s-")
    src, sink = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)
    _write(src, "session_2023-07-15_new.mdx", SESSION_MDX)
    lex = spark.createDataFrame([("good", 1.9), ("excellent", 3.2)], "term string, valence double")
    q = start_scoring(spark, src, sink, lex, checkpoint=os.path.join(d, "ck"), available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(sink, "utterance_sentiment")).count() == 10
    assert spark.read.parquet(os.path.join(sink, "sessions")).count() == 1
    # a batch that runs again replaces what it wrote; a broken file is kept as a reject
    _write(src, "x.json", '{"dialogue":')
    _write(src, "y.json", '{"dialogue":[{"speaker":"A","text":"good"}]}')
    files = spark.read.text(src, wholetext=True, pathGlobFilter="*.json").select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("content"))
    for _ in range(2):
        ingest.score_batch(files, 9, os.path.join(d, "again"), "json", lex)
    again = {t: spark.read.parquet(os.path.join(d, "again", t)).count() for t in ("sessions", "utterance_sentiment", "rejects")}
    assert again == {"sessions": 1, "utterance_sentiment": 1, "rejects": 1}


def test_sinks(spark):
    from parlance.sources import report_files, sinks
    d = tempfile.mkdtemp(prefix="parlance-k-")
    _write(d, "session_2023-07-15_new.mdx", SESSION_MDX)
    t = tr.read_transcripts(spark, d, "mdx")
    flat = sinks.flat_utterances(t.sessions, t.utterances)
    assert {"metadata_title", "metadata_patient", "metadata_therapist", "metadata_session_type"} <= set(flat.columns)
    assert flat.count() == 10
    out = os.path.join(d, "out")
    sinks.write_flat_csv(t.sessions, t.utterances, os.path.join(out, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(out, "csv")).count() == 10
    sinks.write_raw_json(t.sessions, os.path.join(out, "json"))
    assert spark.read.json(os.path.join(out, "json")).first().session_date == "2023-07-15"
    rep = spark.createDataFrame([("session 1", "# r\\nx"), ("overall", "# o")], "report_name string, content string")
    sinks.write_reports(rep, os.path.join(out, "rep"), fmt="pdf")
    assert spark.read.parquet(os.path.join(out, "rep")).first().format == "md"
    sinks.write_reports(rep, os.path.join(out, "txt"), as_text_files=True)
    assert spark.read.text(os.path.join(out, "txt")).count() == 2
    both = spark.createDataFrame([("p1", 1, "session_1", "a"), ("p2", 2, "session_1", "b"), ("p2", None, "overall_progress", "c")],
                                 "patient_id string, session_key long, report_name string, content string")
    sinks.write_reports(both, os.path.join(out, "two"), as_text_files=True)
    got = {(r.patient_id, r.session_key, r.value) for r in spark.read.text(os.path.join(out, "two")).collect()}
    assert got == {("p1", 1, "a"), ("p2", 2, "b"), ("p2", None, "c")}
    name = spark.range(1).select(report_files.report_file_name(F.lit("session 1"), "html", "20240101").alias("n")).first().n
    assert name == "session_1_20240101.html"


def test_chart_catalogue_and_density(spark):
    from parlance.operators import charts as ch
    sc = spark.createDataFrame([(1, i, "A", float(i) / 10 - 0.5) for i in range(11)],
                               "session_key long, dialogue_idx long, speaker string, compound_score double")
    h = ch.compound_histogram(sc, 30)
    assert h.agg(F.sum("count")).first()[0] == 11
    assert h.agg(F.max("bin")).first()[0] == 30  # the maximum lands in the last bin
    dens = ch.density_curve(h, grid=50)
    assert dens.count() == 50
    cat = ch.chart_catalogue({"hist": h, "empty": h.where(F.lit(False))})
    assert list(cat) == ["hist"]


def test_oov_document_gets_prior(spark):
    from parlance.operators import topics as tp
    from parlance.options import TopicOptions
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [("dialogue", 1, i, [words[i % 4], words[(i + 1) % 4]] * 3) for i in range(40)]
    rows.append(("dialogue", 2, 0, ["zzz"]))  # all out of vocabulary
    docs = spark.createDataFrame(rows, "doc_type string, session_key long, dialogue_idx long, tokens array<string>")
    m = tp.fit_topics(docs, TopicOptions(num_topics=2, passes=2, min_df=2, max_df=0.95))
    oov = m.document_topics.where(F.col("session_key") == 2).first()
    probs = sorted(x.prob for x in oov.topic_distribution)
    alpha = m.doc_concentration
    assert abs(sum(probs) - 1.0) < 1e-9
    assert abs(max(probs) - max(alpha) / sum(alpha)) < 1e-9


def test_completion_failure_is_isolated(spark):
    pr = spark.createDataFrame([(1, "p1", None), (2, None, "no content")], "session_key long, prompt string, error string")

    def boom(prompts):
        raise RuntimeError("service down")

    out = {r.session_key: r for r in en.complete(pr, boom).collect()}
    assert out[1].response is None and "service down" in out[1].error
    assert out[2].error == "no content"
    ok = {r.session_key: r for r in en.complete(pr, lambda ps: [p.upper() for p in ps]).collect()}
    assert ok[1].response == "P1" and ok[1].error is None

    def picky(prompts):
        if "p2" in prompts:
            raise RuntimeError("refused")
        return [p.upper() for p in prompts]

    three = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3")], "session_key long, prompt string").coalesce(1)
    out = {r.session_key: r for r in en.complete(three, picky).collect()}
    assert [out[i].response for i in (1, 2, 3)] == ["P1", None, "P3"]
    assert out[1].error is None and "refused" in out[2].error


def test_analysis_prompt_without_content(spark):
    rows = spark.createDataFrame([(1, None, 1, ""), (2, None, 2, "A: x")],
                                 "session_key long, session_date date, session_number int, content string")
    info = spark.createDataFrame([], "session_key long, sentiment_info string")
    topics = spark.createDataFrame([], "session_key long, topic_info string")
    got = {r.session_key: r for r in en.analysis_prompts(rows, info, topics).collect()}
    assert got[1].prompt is None and got[1].error == "No content found in transcript"
    assert got[2].prompt.endswith("A: x") and got[2].error is None


def test_prompts_carry_whole_texts(spark):
    from parlance.options import EnrichOptions
    long = "A: " + "x" * 5000 + " end"
    rows = spark.createDataFrame([(1, None, 1, long)], "session_key long, session_date date, session_number int, content string")
    info = spark.createDataFrame([], "session_key long, sentiment_info string")
    topics = spark.createDataFrame([], "session_key long, topic_info string")
    assert en.analysis_prompts(rows, info, topics).first().prompt.endswith(long)
    cut = en.analysis_prompts(rows, info, topics, EnrichOptions(compat=True)).first().prompt
    assert cut.endswith(long[:4000] + "...") and "end" not in cut[-10:]
    sessions = spark.createDataFrame([(k, None, k, k - 1) for k in (1, 2)],
                                     "session_key long, session_date timestamp, session_number int, transcript_idx long")
    u = spark.createDataFrame([(k, i, "A", f"{k}.{i} " + "y" * 120 + " z") for k in (1, 2) for i in range(7)],
                              "session_key long, dialogue_idx long, speaker string, text string")
    whole = en.progress_prompts(sessions, u, info, topics).first().prompt
    assert all(f"A: {k}.{i} " + "y" * 120 + " z\n" in whole for k in (1, 2) for i in range(7))
    preview = en.progress_prompts(sessions, u, info, topics, compat=True).first().prompt
    assert "A: 2.4 " + "y" * 96 + "...\n" in preview and "2.5" not in preview


def test_end_to_end_directory(spark):
    from parlance.options import TopicOptions
    from parlance.plans.analysis import analyze_directory, write_outputs
    d = tempfile.mkdtemp(prefix="parlance-e-")
    src, out = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)
    _write(src, "session_2023-07-15_001.mdx", SESSION_MDX)
    _write(src, "session_2023-07-22_002.mdx", SESSION_MDX.replace("excellent", "terrible"))
    lex = spark.createDataFrame([("good", 1.9), ("excellent", 3.2), ("terrible", -2.5), ("helped", 1.7)],
                                "term string, valence double")
    a = analyze_directory(spark, src, "mdx", lex, topic_opts=TopicOptions(num_topics=2, passes=2, min_df=1),
                          completer=lambda ps: ["Summary:\n\nok\n\nKey insights: x"] * len(ps))
    write_outputs(a, out)
    rep = {r.report_name: r.content for r in spark.read.parquet(os.path.join(out, "reports")).collect()}
    assert set(rep) == {"session_1", "session_2", "overall_progress"}
    assert rep["session_1"].startswith("# Session 1 Report (2023-07-15)")
    assert "## LLM-Generated Insights" in rep["session_1"] and "### Contextual Analysis" in rep["session_1"]
    assert "## LLM-Generated Progress Insights" in rep["overall_progress"]
    assert "**Sessions Analyzed**: 2" in rep["overall_progress"]
    assert spark.read.parquet(os.path.join(out, "utterance_sentiment")).count() == 20


def test_speaker_allow_list(spark):
    d = tempfile.mkdtemp(prefix="parlance-a-")
    _write(d, "x.txt", "Client: x\nI said: fine\nTherapist: ok")
    t = tr.read_transcripts(spark, d, "txt", speakers=("Client", "Therapist"))
    got = [(r.speaker, r.text) for r in t.utterances.orderBy("dialogue_idx").collect()]
    assert got == [("Client", "x I said: fine"), ("Therapist", "ok")]


def test_idiom_replaces_valence(spark):
    u = spark.createDataFrame([(1, 0, "A", "xx yy zz the bomb")],
                              "session_key long, dialogue_idx long, speaker string, text string")
    lex = spark.createDataFrame([("bomb", -2.0)], "term string, valence double")
    r = se.score_utterances(u, lex, idioms=fx.IDIOMS).first()
    assert r.compound_score == _compound(3.0)
    r2 = se.score_utterances(u, lex).first()
    assert r2.compound_score == _compound(-2.0)


def test_scorer_context_rules(spark):
    texts = ["not very good", "very bad", "kind of good", "kind good", "the least good", "at least good",
             "never so good"]
    u = spark.createDataFrame([(1, i, "A", t) for i, t in enumerate(texts)],
                              "session_key long, dialogue_idx long, speaker string, text string")
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("kind", 1.0)], "term string, valence double")
    bst = spark.createDataFrame([("very", 0.293)], "term string, scalar double")
    neg = spark.createDataFrame([("not",), ("never",)], "term string")
    r = {x.dialogue_idx: x.compound_score for x in se.score_utterances(u, lex, bst, neg).collect()}
    assert r[0] == _compound((1.9 + 0.293) * -0.74)   # booster at 1, negation at distance 2
    assert r[1] == _compound(-2.5 - 0.293)            # booster follows the sign of the valence
    assert r[2] == _compound(1.9)                     # 'kind' before 'of' scores 0
    assert r[3] == _compound(1.0 + 1.9)
    assert r[4] == _compound(1.9 * -0.74)             # 'least' negates
    assert r[5] == _compound(1.9)                     # ... but not after 'at'
    assert r[6] == _compound(1.9 * 1.5)               # 'never so' amplifies at distance 2
