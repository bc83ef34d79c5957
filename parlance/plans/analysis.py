"""End-to-end composition: transcripts -> scores, topics, progress, charts, reports.

This is the library's equivalent of the reference's command-line run, as one
lazily composed set of DataFrames.  Nothing is collected: each table is a
plan; ``write_outputs`` materialises them with the sinks.  Intermediates
that feed several branches (cleaned utterances, scores, documents) are
persisted for the run (recomputed from lineage if an executor is lost).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ordering
from ..operators import charts as ch
from ..operators import enrich as en
from ..operators import preprocess as pp
from ..operators import progress as pg
from ..operators import prompt_parts as pt
from ..operators import reports as rp
from ..operators import sentiment as se
from ..operators import topics as tp
from ..options import EnrichOptions, ReportOptions, SentimentOptions, TextOptions, TopicOptions
from ..session import ensure_checkpoint_dir
from ..sources import line_scan, report_files, sinks
from ..sources import transcripts as tr


@dataclass
class Analysis:
    sessions: DataFrame
    utterances: DataFrame
    rejects: DataFrame | None
    processed: DataFrame
    scored: DataFrame
    session_sentiment: DataFrame
    speaker_sentiment: DataFrame
    progression: DataFrame
    documents: DataFrame
    topic_terms: DataFrame | None
    document_topics: DataFrame | None
    prevalence: DataFrame | None
    coherence: DataFrame | None
    facts: DataFrame
    trend: DataFrame
    reports: DataFrame
    charts: dict = field(default_factory=dict)
    enrichment: DataFrame | None = None
    progress_replies: DataFrame | None = None
    held: list = field(default_factory=list)

    def release(self) -> None:
        """Give up the tables that were persisted for the run."""
        for df in self.held:
            df.unpersist()


def analyze(spark: SparkSession, sessions: DataFrame, utterances: DataFrame, lexicon: DataFrame,
            boosters: DataFrame | None = None, negators: DataFrame | None = None,
            lemmas: DataFrame | None = None, idioms=None, group_cols: tuple[str, ...] = (),
            text_opts: TextOptions = TextOptions(), sent_opts: SentimentOptions = SentimentOptions(),
            topic_opts: TopicOptions = TopicOptions(), report_opts: ReportOptions = ReportOptions(),
            completer=None, rejects: DataFrame | None = None,
            enrich_opts: EnrichOptions = EnrichOptions()) -> Analysis:
    """Run every stage on a session table (with ``transcript_idx``) and its utterances."""
    keys = list(group_cols)
    if keys:
        utterances = utterances.join(sessions.select("session_key", *keys), "session_key")
    processed = pp.preprocess(utterances, text_opts, lemmas=lemmas).persist()
    scored = se.score_utterances(processed, lexicon, boosters, negators, idioms, sent_opts).persist()
    ss = se.session_sentiment(scored, sessions.select("session_key"), opts=sent_opts)
    spk = se.speaker_sentiment(scored, keys, sent_opts)
    prog = se.session_progression(scored, sessions.select("session_key"))
    docs = tp.corpus(processed)
    model = tp.fit_topics(docs, topic_opts)
    if model is not None:
        terms, dtop = model.topic_terms, model.document_topics
        idx = sessions.select("session_key", "transcript_idx", "session_date", "session_number", *keys)
        prev = tp.topic_prevalence(dtop, idx)
        coh = tp.coherence_cv(terms, docs, topic_opts.top_terms, topic_opts.coherence_window)
        ttop = dtop.where(F.col("doc_type") == "transcript")
    else:
        terms = dtop = prev = coh = ttop = None
    facts = pg.session_facts(sessions, ss, prog, ttop, terms)
    trend = pg.corpus_trend(facts, keys)
    enrichment = progress = None
    if completer is not None and report_opts.include_enrichment:
        ensure_checkpoint_dir(spark)
        content = en.session_content(sessions, utterances)
        sent = en.sentiment_highlights(ss, prog)
        topic = en.topic_highlights(ttop, terms) if ttop is not None else sent.select(
            "session_key", F.lit(None).cast("string").alias("topic_info"))
        # replies cost calls: each table of them is checkpointed, so no prompt is asked again
        replies = en.complete(en.summary_prompts(content), completer, enrich_opts).select(
            "session_key", en.parse_reply(F.col("response")).alias("p")).checkpoint(eager=True)
        combined = en.complete(en.analysis_prompts(content, sent, topic, enrich_opts), completer, enrich_opts).select(
            "session_key", en.paragraphs(F.col("response")).alias("contextual_insights")).checkpoint(eager=True)
        enrichment = replies.join(combined, "session_key", "left").select(
            "session_key", F.col("p.summary").alias("enriched_summary"),
            F.col("p.insights").alias("enriched_insights"), F.col("p.emotional_themes").alias("enriched_themes"),
            F.col("p.therapeutic_focus").alias("enriched_focus"), "contextual_insights")
        parts = pt.progress_prompt_parts(sessions, utterances, sent, topic, keys, enrich_opts.part_chars)
        progress = pt.progress_replies(parts, completer, keys, enrich_opts).select(
            *keys, en.paragraphs(F.col("response")).alias("paragraphs"))
    session_rep = rp.session_reports(facts, report_opts, enrichment, keys)
    overall = rp.overall_reports(
        facts, trend,
        pg.recurrent_topic(facts.select(*keys, "dominant_topic"), keys) if ttop is not None else None,
        pg.theme_evolution(prev, keys) if prev is not None else None,
        pg.consistent_topic(prev, keys) if prev is not None else None,
        pg.emerging_topic(prev, keys) if prev is not None else None,
        pg.speaker_gap(scored, sessions, keys), terms, keys, report_opts, progress)
    reports = rp.all_reports(session_rep, overall)
    dated_ss = ss.join(sessions.select("session_key", "session_date", *keys), "session_key")
    charts = {
        "sentiment_over_time": ch.sentiment_over_time(dated_ss, keys),
        "compound_histogram": ch.compound_histogram(scored),
        "compound_density": ch.density_curve(ch.compound_histogram(scored)),
        "speaker_bars": ch.speaker_bars(spk),
        "progression": ch.progression_bars(prog.join(sessions.select("session_key", "session_date"),
                                                     "session_key")),
    }
    if terms is not None:
        charts["topic_terms"] = ch.topic_term_bars(terms)
        charts["prevalence"] = ch.prevalence_pivot(prev, list(range(topic_opts.num_topics)), keys)
        charts["prevalence_sentiment"] = ch.prevalence_with_sentiment(
            ch.prevalence_pivot(prev, list(range(topic_opts.num_topics))), dated_ss)
        charts["topics_along_session"] = tp.topics_along_session(dtop, sessions.select("session_key"))
        charts["dominant_counts"] = ch.dominant_topic_counts(dtop)
        charts["sentiment_by_topic"] = ch.sentiment_by_topic(dtop, scored)
    return Analysis(sessions=sessions, utterances=utterances, rejects=rejects, processed=processed,
                    scored=scored, session_sentiment=ss, speaker_sentiment=spk, progression=prog,
                    documents=docs.docs, topic_terms=terms, document_topics=dtop, prevalence=prev,
                    coherence=coh, facts=facts, trend=trend, reports=reports, charts=charts,
                    enrichment=enrichment, progress_replies=progress, held=[processed, scored])


def analyze_directory(spark: SparkSession, path: str, fmt: str, lexicon: DataFrame, **kw) -> Analysis:
    """S1-S10 then ``analyze``; ``compat`` and ``speakers`` go to the reader.

    ``split_files`` picks the reader that goes line by line (files larger than a task; no ``raw_content``).
    ``group_by`` names metadata keys that tell clients apart: each becomes a group column (null where a file has no
    such key) and sessions are numbered within a client.
    """
    read = line_scan.read_transcript_lines if kw.pop("split_files", False) else tr.read_transcripts
    t = read(spark, path, fmt, kw.pop("compat", False), tuple(kw.get("group_cols", ())), kw.pop("speakers", None))
    sessions, named = t.sessions, tuple(kw.pop("group_by", ()))
    if named:
        kw["group_cols"] = (*kw.get("group_cols", ()), *named)
        sessions = sessions.drop("transcript_idx").select("*", *[F.col("metadata")[k].alias(k) for k in named])
        sessions = ordering.dense_index(sessions, ordering.session_order(), "transcript_idx", kw["group_cols"])
    return analyze(spark, sessions, t.utterances, lexicon, rejects=t.rejects, **kw)


def write_outputs(a: Analysis, out: str, report_format: str = "md", stamp: str | None = None) -> None:
    """Materialise every table as Parquet under ``out`` (reports also as one file each, named with ``stamp``)."""
    tables = {
        "sessions": a.sessions.drop("dialogue"), "utterance_sentiment": a.scored,
        "session_sentiment": a.session_sentiment, "speaker_sentiment": a.speaker_sentiment,
        "session_progression": a.progression, "session_facts": a.facts, "corpus_trend": a.trend,
    }
    if a.topic_terms is not None:
        tables.update(topic_terms=a.topic_terms, document_topics=a.document_topics,
                      topic_prevalence=a.prevalence, coherence=a.coherence)
    if a.rejects is not None:
        tables["rejects"] = a.rejects
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(out, name))
    for name, df in a.charts.items():
        df.write.mode("overwrite").parquet(os.path.join(out, "charts", name))
    sinks.write_reports(a.reports, os.path.join(out, "reports"), report_format)
    report_files.write_report_files(a.reports, os.path.join(out, "report_files"), report_format, stamp)
