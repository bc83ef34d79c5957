"""Registered queries whose groups are cut into bounded pieces: files over splits, prompt parts, report lines."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import ordering
from ..operators import enrich as en
from ..operators import progress as pg
from ..operators import preprocess as pp
from ..operators import prompt_parts as pt
from ..operators import sentiment as se
from ..operators import topics as tp
from ..options import EnrichOptions, TopicOptions
from ..session import ensure_checkpoint_dir
from ..sources import line_scan
from . import fixtures as fx
from . import sql as q
from .catalog import _SQL_PROGRESSION, _SQL_SESSION_SENT, FIXTURE_TEXT, processed, r6, read, register, sessions
from .queries_more import (_FL, _SQL_SENT_INFO, _reports, _sent_info, _sql, _topic_info, BASE, GROUP, SQL_INSIGHTS,
                           SQL_RECOMMENDATIONS, TREND_CTES, TREND_SELECT, _lit, docs, fixed_mix, sessions_idx)


def _with(ctes: str, body: str) -> str:
    """The shared CTEs, more of them (each group starting with a comma) and a query."""
    return BASE + ctes.replace("\n, ", ",\n") + body


def _fix(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', round(CAST({x} AS DECIMAL(38,10)), {digits}))"


# ================================================================ S: sources
@register("transcript_files", """
WITH l AS (SELECT conv_id // 200 AS transcript, role,
                  array_to_string(list_filter(string_split(regexp_replace(text, '^\\s+', ''), chr(10)),
                                              lambda l: regexp_matches(l, '\\S')), ' ') AS text,
                  row_number() OVER (PARTITION BY conv_id // 200 ORDER BY conv_id, turn) - 1 AS dialogue_idx
           FROM conversations)
SELECT transcript, CAST(dialogue_idx AS BIGINT) AS dialogue_idx, role AS speaker, text FROM l""")
def transcript_files(spark, sf_dir):
    """Transcripts written as text files, one for 200 conversations, and read back by the splitting line scan."""
    c = read(spark, sf_dir, "conversations")
    key = F.floor(F.col("conv_id") / 200)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/transcripts-{uuid.uuid4().hex}"
    c.select(key.alias("transcript"), "conv_id", "turn", F.concat(
        F.concat_ws(": ", "role", "text"), F.lit("\n")).alias("value")) \
        .repartition("transcript").sortWithinPartitions("transcript", "conv_id", "turn") \
        .select("transcript", "value").write.partitionBy("transcript").text(path)
    t = line_scan.read_transcript_lines(spark, path, "txt")
    at = F.regexp_extract("file_path", "transcript=(-?[0-9]+)/", 1).cast("long").alias("transcript")
    return t.utterances.join(t.sessions.select("session_key", at), "session_key").select(
        "transcript", "dialogue_idx", "speaker", "text")


# ================================================================ L6: prompts in bounded parts
PART_CHARS = 3_000
_HALF = PART_CHARS // 2
_PARTS = f"""
, it AS (
  SELECT patient_id, transcript_idx, 0 AS kind, 0 AS idx, 'SESSION ' || coalesce(CAST(session_number AS VARCHAR), 'None')
    || ' (' || coalesce(strftime(session_date, '%Y-%m-%d %H:%M:%S'), 'None') || '):' || chr(10) || 'Content:' AS text FROM sidx
  UNION ALL SELECT i.patient_id, i.transcript_idx, 1, u.dialogue_idx,
    coalesce(u.speaker, 'Unknown') || ': ' || coalesce(u.text, '') FROM u JOIN sidx i USING (session_key)
  UNION ALL SELECT i.patient_id, i.transcript_idx, 2, 0,
    'Sentiment: ' || coalesce(si.sentiment_info, {_lit(en.NO_SENTIMENT)}) || chr(10) || 'Topics: '
    || coalesce(ti.topic_info, {_lit(en.NO_TOPIC)})
  FROM sidx i LEFT JOIN sinfo si USING (session_key) LEFT JOIN tinfo ti USING (session_key)),
pl AS (SELECT *, greatest(CAST(ceil(length(text) / {_HALF - 1}.0) AS BIGINT), 1) AS np FROM it),
pb AS (SELECT *, coalesce(sum(length(text) + np) OVER (PARTITION BY patient_id ORDER BY transcript_idx, kind, idx
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pl),
pc AS (SELECT *, unnest(range(0, np)) AS piece FROM pb),
px AS (SELECT patient_id, CAST((before + piece * {_HALF}) // {_HALF} AS BIGINT) AS part, transcript_idx, kind, idx, piece,
         substr(text, CAST(piece * {_HALF - 1} + 1 AS BIGINT), {_HALF - 1}) AS x FROM pc),
pt AS (SELECT patient_id, part, string_agg(x, chr(10) ORDER BY transcript_idx, kind, idx, piece) AS text
       FROM px GROUP BY patient_id, part),
pn AS (SELECT patient_id, max(part) + 1 AS n_parts FROM px GROUP BY patient_id),
cn AS (SELECT patient_id, count(*) AS n FROM sidx GROUP BY patient_id)"""


@register("progress_prompt_parts", _with(_SQL_SENT_INFO + _PARTS, f"""
SELECT pt.patient_id, part, n_parts,
  CASE WHEN n >= 2 THEN 'Please analyze these therapy session transcripts from the client'
    || ' and provide insights about the client''s progress across sessions:' || chr(10) || chr(10)
    || {_lit(en.PROGRESS_ASK)} || 'SESSION DATA (part ' || (part + 1) || ' of ' || n_parts || '):' || chr(10) || chr(10)
    || text END AS prompt,
  CASE WHEN n < 2 THEN 'Need at least 2 transcripts to analyze progress' END AS error
FROM pt JOIN pn ON pt.patient_id IS NOT DISTINCT FROM pn.patient_id JOIN cn ON pt.patient_id IS NOT DISTINCT FROM cn.patient_id
WHERE n >= 2 OR part = 0"""))
def progress_prompt_parts(spark, sf_dir):
    """The progress prompt of every client in numbered parts of at most 3000 characters of session data."""
    u = processed(spark, sf_dir, False).select("session_key", "dialogue_idx", "speaker", "text")
    return pt.progress_prompt_parts(sessions_idx(spark, sf_dir), u, _sent_info(spark, sf_dir), _topic_info(spark, sf_dir),
                                    GROUP, PART_CHARS)


def _counting_completer(prompts):
    """Deterministic stand-in for a model: counts session blocks in a part, adds up the counts in a merge."""
    out = []
    for p in prompts:
        if "PART " in p:
            out.append(str(sum(int(x.split(":\n")[1].split("\n")[0]) for x in p.split("PART ")[1:])))
        else:
            out.append(str(p.count("):\nContent:")))
    return out


@register("progress_replies", _sql("""
SELECT patient_id, CAST(count(*) AS VARCHAR) AS response, CAST(NULL AS VARCHAR) AS error FROM sidx GROUP BY patient_id"""))
def progress_replies(spark, sf_dir):
    """A reply per prompt part, merged three at a time; the stand-in counts sessions, so none may be lost."""
    parts = progress_prompt_parts(spark, sf_dir)
    r = pt.progress_replies(parts, _counting_completer, GROUP, EnrichOptions(fan_in=3))
    return r.select("patient_id", "response", "error")


# ================================================================ R26-R29: report text
_SESSION_REPORT = f"""
, sf AS (SELECT f.*, ss.avg_positive, ss.avg_negative, ss.avg_neutral, prog.start_sentiment, prog.end_sentiment,
    prog.sentiment_shift, f.positive_count + f.neutral_count + f.negative_count AS total,
    {SQL_INSIGHTS} AS ins, {SQL_RECOMMENDATIONS} AS recs, strftime(f.session_date, '%Y-%m-%d') AS day
  FROM facts f JOIN (SELECT session_key, avg_positive, avg_negative, avg_neutral FROM ss) ss USING (session_key)
  JOIN (SELECT session_key, start_sentiment, end_sentiment, sentiment_shift FROM prog) prog USING (session_key)),
tl AS (SELECT topic_id, list('  - ' || term || ' (' || {_fix('weight', 3)} || ')' ORDER BY rn) AS term_lines
       FROM ttr WHERE rn <= 10 GROUP BY topic_id),
sl AS (SELECT session_key, list('  - Topic ' || topic_id || ': ' || {_fix('prob', 3)} ORDER BY rk) AS sec_lines
       FROM fpr WHERE doc_type = 'transcript' AND rk BETWEEN 2 AND 4 GROUP BY session_key),
sr AS (SELECT patient_id, session_key, 'session_' || display_number AS report_name, array_to_string(list_filter(flatten([
  ['# Session ' || display_number || ' Report (' || coalesce(day, 'Unknown Date') || ')', '', '## Session Information', '',
   '- **Date**: ' || coalesce(day, 'Unknown Date'), '- **Session Number**: ' || display_number, '- **File**: ' || file_name, '',
   '## Summary', '',
   'This session had an overall ' || {q.tone('avg_compound')} || ' tone ('
     || CASE overall_sentiment WHEN 'positive' THEN '😊' WHEN 'neutral' THEN '😐' ELSE '😔' END || ' '
     || {_fix('avg_compound', 2)} || ').',
   'The main theme (Topic ' || dominant_topic || ') was present with a strength of ' || {_fix('dominant_topic_prob', 2)} || '.',
   'Key terms: ' || t5 || '.', '', '## Emotional Tone Analysis', '',
   '- **Overall Emotional Tone**: ' || upper(overall_sentiment[1]) || overall_sentiment[2:],
   '  - Compound Score: ' || {_fix('avg_compound', 3)}, '  - Positive Aspects: ' || {_fix('avg_positive', 3)},
   '  - Negative Aspects: ' || {_fix('avg_negative', 3)}, '  - Neutral Aspects: ' || {_fix('avg_neutral', 3)}, ''],
  CASE WHEN total > 0 THEN ['- **Emotional Tone Breakdown**:',
   '  - Positive: ' || positive_count || ' statements (' || {_fix('positive_count / total * 100', 1)} || '%)',
   '  - Neutral: ' || neutral_count || ' statements (' || {_fix('neutral_count / total * 100', 1)} || '%)',
   '  - Negative: ' || negative_count || ' statements (' || {_fix('negative_count / total * 100', 1)} || '%)', ''] ELSE [] END,
  CASE WHEN start_sentiment IS NOT NULL THEN ['- **Session Progression**:', '  - Started: ' || {_fix('start_sentiment', 3)},
   '  - Ended: ' || {_fix('end_sentiment', 3)},
   '  - Shift: ' || {_fix('sentiment_shift', 3)} || ' (' || sentiment_trend || ')', ''] ELSE [] END,
  ['## Theme Analysis', ''],
  CASE WHEN dominant_topic IS NOT NULL THEN ['- **Primary Theme**: Topic ' || dominant_topic,
   '  - Strength: ' || {_fix('dominant_topic_prob', 3)}, '']
   ELSE ['No topic analysis data available for this session.', ''] END,
  CASE WHEN term_lines IS NOT NULL THEN list_concat(['- **Key Terms**:'], term_lines, ['']) ELSE [] END,
  CASE WHEN sec_lines IS NOT NULL THEN list_concat(['- **Secondary Themes**:'], sec_lines, ['']) ELSE [] END,
  ['## Key Insights', ''],
  CASE WHEN len(ins) > 0 THEN list_transform(ins, lambda x, i: i || '. ' || x)
       ELSE ['No specific insights available for this session.'] END,
  ['', '## Recommendations', '', 'Based on the analysis, consider the following for future sessions:', ''],
  list_transform(recs, lambda x, i: i || '. ' || x),
  ['', '---', '', '*Report generated at 1970-01-01 00:00:00*']]), lambda x: x IS NOT NULL), chr(10)) AS content
FROM sf LEFT JOIN tl ON tl.topic_id = sf.dominant_topic LEFT JOIN sl USING (session_key))"""

_numbered = "list_transform({0}, lambda x, i: i || '. ' || x)".format
_OVERALL = f""",
tr AS ({TREND_SELECT}),
rt AS (SELECT patient_id, dominant_topic AS topic FROM (
  SELECT patient_id, dominant_topic, row_number() OVER (PARTITION BY patient_id ORDER BY n DESC, dominant_topic) AS r
  FROM (SELECT patient_id, dominant_topic, count(*) AS n FROM facts WHERE dominant_topic IS NOT NULL GROUP BY ALL)) WHERE r = 1),
{_FL.format(where="").strip().lstrip(", ")},
{_FL.format(where="WHERE session_date IS NOT NULL").strip().lstrip(", ").replace("fl AS", "fd2 AS", 1)},
ct AS (SELECT patient_id, topic_id AS topic FROM (SELECT *, row_number() OVER (
         PARTITION BY patient_id ORDER BY mean_prevalence DESC, topic_id) AS r FROM fl WHERE n > 1) WHERE r = 1),
et AS (SELECT patient_id, topic_id AS topic FROM (SELECT *, row_number() OVER (
         PARTITION BY patient_id ORDER BY last - first DESC, topic_id) AS r FROM fl WHERE n > 1 AND last - first > 0.1) WHERE r = 1),
ev AS (SELECT patient_id, row_number() OVER (PARTITION BY patient_id ORDER BY abs(last - first) DESC, fd2.topic_id) AS rank,
         '- **Topic ' || fd2.topic_id || '** (' || coalesce(t3, '') || '): '
         || CASE WHEN last - first > 0 THEN 'increasing' ELSE 'decreasing' END || ' by ' || {_fix('abs(last - first) * 100', 1)}
         || '% (from ' || {_fix('first', 2)} || ' to ' || {_fix('last', 2)} || ')' AS line
       FROM fd2 LEFT JOIN tops ON tops.topic_id = fd2.topic_id WHERE n > 1 AND abs(last - first) > 0.1),
sp AS (SELECT sc.patient_id, sc.speaker, avg(sc.compound_score) AS ac, min((i.transcript_idx, sc.dialogue_idx)) AS seen
       FROM scored sc JOIN sidx i USING (session_key) WHERE sc.speaker <> '' GROUP BY ALL),
gp AS (SELECT patient_id, min_by(ac, seen) FILTER (WHERE lower(speaker) LIKE '%client%')
         - min_by(ac, seen) FILTER (WHERE lower(speaker) LIKE '%therapist%') AS gap FROM sp GROUP BY patient_id),
oc AS (SELECT tr.*, rt.topic AS rtopic, a.t5 AS rterms, ct.topic AS ctopic, b.t3 AS cterms, et.topic AS etopic, c.t3 AS eterms,
    CASE WHEN gap < -0.2 THEN '{pg.INS_CLIENT_NEGATIVE}' WHEN gap > 0.2 THEN '{pg.INS_CLIENT_POSITIVE}' END AS gap_insight,
    (SELECT count(*) FROM ev WHERE ev.patient_id IS NOT DISTINCT FROM tr.patient_id) AS n_ev
  FROM tr LEFT JOIN rt ON rt.patient_id IS NOT DISTINCT FROM tr.patient_id LEFT JOIN tops a ON a.topic_id = rt.topic
  LEFT JOIN ct ON ct.patient_id IS NOT DISTINCT FROM tr.patient_id LEFT JOIN tops b ON b.topic_id = ct.topic
  LEFT JOIN et ON et.patient_id IS NOT DISTINCT FROM tr.patient_id LEFT JOIN tops c ON c.topic_id = et.topic
  LEFT JOIN gp ON gp.patient_id IS NOT DISTINCT FROM tr.patient_id),
orl AS (SELECT *, list_filter([direction_insight, volatility_insight,
    'Theme ' || ctopic || ' (' || cterms || ') has been consistently present throughout therapy, suggesting an ongoing area of focus or concern.',
    gap_insight], lambda x: x IS NOT NULL) AS ins,
  list_filter([latest_recommendation, stagnation_recommendation, 'Theme ' || etopic || ' (' || eterms
    || ') is becoming increasingly prominent. Consider dedicating more focus to this emerging area.'], lambda x: x IS NOT NULL) AS recs
  FROM oc),
ol AS (
  SELECT patient_id, s.sec, 0 AS pos, generate_subscripts(s.l, 1) AS sub, unnest(s.l) AS line FROM (
    SELECT patient_id, unnest([
      {{'sec': 0, 'l': ['# Therapy Progress Report', '', '**Period**: ' || coalesce(strftime(first_date, '%Y-%m-%d') || ' to '
         || strftime(last_date, '%Y-%m-%d'), 'Unknown date range'), '**Sessions Analyzed**: ' || sessions, '',
         '## Executive Summary', '']}},
      {{'sec': 2, 'l': CASE WHEN dated_sessions > 0 THEN [
         'Over the course of therapy, the emotional tone has shown ' || trend_description || '.',
         'Out of ' || dated_sessions || ' sessions, ' || positive_sessions || ' were predominantly positive, '
         || negative_sessions || ' were negative, and ' || neutral_sessions || ' were neutral.'] ELSE [] END}},
      {{'sec': 4, 'l': CASE WHEN rterms IS NOT NULL THEN ['The most recurrent theme across sessions was Topic ' || rtopic
         || ', which includes terms like ' || rterms || '.'] ELSE [] END}},
      {{'sec': 6, 'l': ['', '## Progress Tracking', '']}},
      {{'sec': 8, 'l': CASE WHEN dated_sessions > 0 THEN ['### Emotional Tone Progression', '',
         '| Session | Date | Sentiment | Score |', '|---------|------|-----------|-------|'] ELSE [] END}},
      {{'sec': 10, 'l': CASE WHEN dated_sessions > 0 THEN [''] ELSE [] END}},
      {{'sec': 12, 'l': CASE WHEN n_ev > 0 OR dated_sessions > 0 THEN ['### Theme Evolution', '',
         'The following themes have shown significant changes in prevalence over time:', ''] ELSE [] END}},
      {{'sec': 14, 'l': CASE WHEN n_ev > 0 THEN [''] WHEN dated_sessions > 0 THEN [
         'No significant changes in theme prevalence were observed.', ''] ELSE [] END}},
      {{'sec': 16, 'l': ['## Key Insights', '']}},
      {{'sec': 18, 'l': CASE WHEN len(ins) > 0 THEN {_numbered('ins')} ELSE ['No specific overall insights available.'] END}},
      {{'sec': 20, 'l': ['', '## Recommendations', '']}},
      {{'sec': 22, 'l': CASE WHEN len(recs) > 0 THEN {_numbered('recs')} ELSE [{", ".join(
         "'" + str(i + 1) + ". " + x + "'" for i, x in enumerate(pg.REC_OVERALL_GENERIC))}] END}},
      {{'sec': 24, 'l': ['', '## Session Summaries', '']}},
      {{'sec': 28, 'l': ['', '---', '', '*Report generated at 1970-01-01 00:00:00*']}}]) AS s FROM orl)
  UNION ALL SELECT patient_id, 9, transcript_idx, 0, '| ' || display_number || ' | ' || day || ' | '
    || upper(overall_sentiment[1]) || overall_sentiment[2:] || ' | ' || {_fix('avg_compound', 2)} || ' |'
  FROM sf WHERE session_date IS NOT NULL
  UNION ALL SELECT patient_id, 13, rank, 0, line FROM ev
  UNION ALL SELECT patient_id, 25, transcript_idx, generate_subscripts(l, 1), unnest(l) FROM (
    SELECT patient_id, transcript_idx, ['### Session ' || display_number || ' (' || coalesce(day, 'Unknown') || ')', '',
      '- **Emotional Tone**: ' || upper(overall_sentiment[1]) || overall_sentiment[2:] || ' (' || {_fix('avg_compound', 2)} || ')',
      '- **Primary Theme**: Topic ' || coalesce(CAST(dominant_topic AS VARCHAR), 'N/A'),
      '- **Key Insight**: ' || coalesce(ins[1], 'No specific insights.'), ''] AS l FROM sf))"""


@register("reports", _with(_SESSION_REPORT + TREND_CTES + _OVERALL, """
SELECT patient_id, session_key, report_name, content FROM sr
UNION ALL SELECT patient_id, NULL, 'overall_progress', string_agg(line, chr(10) ORDER BY sec, pos, sub) FROM ol
GROUP BY patient_id"""))
def reports(spark, sf_dir):
    """The text of every session report plus one overall report per client."""
    return _reports(spark, sf_dir).select("patient_id", "session_key", "report_name", "content")


@register("report_lines", _with(_SESSION_REPORT + TREND_CTES + _OVERALL, """
SELECT patient_id, row_number() OVER (PARTITION BY patient_id ORDER BY sec, pos, sub) - 1 AS line_no, line FROM ol"""))
def report_lines(spark, sf_dir):
    """The overall report of every client as numbered lines, no client collected."""
    return _reports(spark, sf_dir, True)


# ================================================================ R23, D9, T5-T10, D8
@register("emerging_topic_by_number", _with(""",
gidx AS (SELECT *, row_number() OVER (ORDER BY session_date NULLS LAST, nullif(session_number, 0) NULLS LAST,
           file_name, session_key) - 1 AS gi FROM ses)""" + _FL.format(where="").replace("\n, fl", ",\nfl").replace(
    "patient_id", "session_number").replace("transcript_idx", "gi").replace("FROM prev", "FROM (SELECT p.*, g.gi FROM prev p "
    "JOIN gidx g USING (session_key))"), """
SELECT session_number, topic_id AS emerging_topic, round(last - first, 6) AS emerging_change FROM (
  SELECT *, row_number() OVER (PARTITION BY session_number ORDER BY last - first DESC, topic_id) AS r
  FROM fl WHERE n > 1 AND last - first > 0.1) WHERE r = 1"""))
def emerging_topic_by_number(spark, sf_dir):
    """R23 where it fires: sessions grouped by their number."""
    s = ordering.dense_index(sessions(spark, sf_dir), ordering.session_order(), "transcript_idx")
    e = pg.emerging_topic(tp.topic_prevalence(fixed_mix(spark, sf_dir), s), ["session_number"])
    return e.select("session_number", "emerging_topic", r6(F.col("emerging_change")).alias("emerging_change"))


@register("topics_along_session", _with(""",
nt AS (SELECT session_key, dialogue_idx, CAST(floor((row_number() OVER (PARTITION BY session_key ORDER BY dialogue_idx) - 1) * 3
         / count(*) OVER (PARTITION BY session_key)) + 1 AS INTEGER) AS part FROM docs WHERE doc_type = 'dialogue'),
np AS (SELECT session_key, part, count(*) AS utterances FROM nt GROUP BY ALL)""", """
SELECT session_key, part, topic_id, round(sum(prob) / any_value(utterances), 6) AS prevalence, any_value(utterances) AS utterances
FROM fpr JOIN nt USING (session_key, dialogue_idx) JOIN np USING (session_key, part) WHERE doc_type = 'dialogue'
GROUP BY session_key, part, topic_id"""))
def topics_along_session(spark, sf_dir):
    """Topic prevalence in the first, middle and last third of every session (fixture mixtures)."""
    t = tp.topics_along_session(fixed_mix(spark, sf_dir), sessions_idx(spark, sf_dir).select("session_key"))
    return t.select("session_key", "part", "topic_id", r6(F.col("prevalence")).alias("prevalence"), "utterances")


_VOCAB = """,
dfq AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_type, session_key, dialogue_idx, term FROM alltok) GROUP BY term),
nq AS (SELECT count(*) AS n FROM docs),
vq AS (SELECT term FROM dfq, nq WHERE df >= 5 AND df <= floor(0.9 * nq.n))"""


@register("lda_invariants", _with(_VOCAB, """
SELECT CAST(5 AS BIGINT) AS topics, 5 * least(20, (SELECT count(*) FROM vq)) AS topic_terms, CAST(0 AS BIGINT) AS foreign_terms,
  CAST(0 AS BIGINT) AS bad_weights, (SELECT count(*) FROM docs) AS documents, CAST(0 AS BIGINT) AS bad_mixtures,
  CAST(0 AS BIGINT) AS bad_dominant"""))
def lda_invariants(spark, sf_dir):
    """What every fit must hold: terms of the vocabulary, falling weights, a sorted mixture for every document."""
    m = tp.fit_topics(docs(spark, sf_dir), TopicOptions())
    t = m.topic_terms.join(m.vocab.select("term", F.lit(1).alias("known")), "term", "left")
    per_topic = t.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("known").isNull()).alias("foreign"),
        F.count_if((F.col("weight") <= 0) | (F.col("weight") > 1)).alias("bad"), F.sum("weight").alias("w"))
    a = per_topic.agg(F.count(F.lit(1)).alias("topics"), F.sum("n").alias("topic_terms"), F.sum("foreign").alias("foreign_terms"),
                      F.sum(F.col("bad") + F.when(F.col("w") > 1 + 1e-9, 1).otherwise(0)).alias("bad_weights"))
    mix = F.col("topic_distribution")
    total = F.aggregate(mix, F.lit(0.0), lambda s, x: s + x["prob"])
    probs = F.transform(mix, lambda x: x["prob"])
    sorted_down = F.array_sort(probs, lambda x, y: F.when(x > y, -1).when(x < y, 1).otherwise(0)) == probs
    first = F.get(mix, 0)
    b = m.document_topics.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if((total > 1 + 1e-6) | (total < 0.95) | ~sorted_down | F.exists(mix, lambda x: x["prob"] < 0.01)).alias("bad_mixtures"),
        F.count_if((F.col("dominant_topic") != first["topic_id"]) | (F.col("dominant_topic_prob") != first["prob"])).alias("bad_dominant"))
    j = tp.with_scalar(a, b)
    return j.select(*[F.col(c).cast("long").alias(c) for c in j.columns])


@register("choose_k_invariants", _with(_VOCAB, """
SELECT k, CAST(CASE WHEN (SELECT count(*) FROM vq) > 0 THEN k ELSE 0 END AS BIGINT) AS topics, CAST(1 AS BIGINT) AS means,
  CAST(0 AS BIGINT) AS out_of_range, true AS mean_of_topics
FROM (SELECT CAST(unnest([3, 5]) AS INTEGER) AS k)"""))
def choose_k_invariants(spark, sf_dir):
    """Every k has its topics and one mean row, the mean of their coherences, all within [-1, 1]."""
    c = tp.choose_k(docs(spark, sf_dir), [3, 5], TopicOptions())
    topic = F.col("topic_id") >= 0
    return c.groupBy("k").agg(
        F.count_if(topic).alias("topics"), F.count_if(~topic).alias("means"),
        F.count_if(F.abs("coherence") > 1 + 1e-9).alias("out_of_range"),
        (F.abs(F.avg(F.when(topic, F.col("coherence"))) - F.max(F.when(~topic, F.col("coherence")))) < 1e-9).alias("mean_of_topics"))


# ================================================================ texts in which the rare rules fire
# Openings that are put before the texts of the conversations, by conv_id % 14.
OPENINGS = ("the plain and of to ", "the good and but of the bad in ", "to be least the very least of at least and ",
            "x never so and never this the yes never and ", "it is kind of the kind and of ", "we all know the bomb and the rest ",
            "they would cut the mustard and then the kiss of death of it ", "see http://a.b/c?d=1 and www.x.y/z HTTPS://q now ",
            "I cannot, wanna gonna gotta lemme gimme \u201cquote\u201d the ", "sort of and not sort of the in, bad ass to ",
            "yeah right, yeah right and the hand to mouth ", "42 and 3rd of the 1st ", "very and very of it to for of ", "")
SILENT = 13  # conversations of this remainder say nothing: empty sessions
_OPEN = "CASE conv_id % 14 " + " ".join(f"WHEN {i} THEN {fx._sql_str(x)}" for i, x in enumerate(OPENINGS)) + " END"
SQL_RULE_UTTERANCES = (
    f"SELECT conv_id AS session_key, turn AS dialogue_idx, {fx.SQL_SPEAKER} AS speaker, CASE WHEN conv_id % 14 = {SILENT} THEN '' "
    f"WHEN conv_id % 5 = 2 AND turn = 1 THEN NULL WHEN conv_id % 5 = 3 AND turn = 1 THEN ' ' ELSE {_OPEN} || text END AS text, "
    f"nullif(conv_id % 10, {fx.NO_PATIENT}) AS patient_id FROM conversations")


def rule_utterances(spark, sf_dir):
    """The utterances with openings that make every context rule fire, blank and missing texts and silent sessions."""
    c = read(spark, sf_dir, "conversations")
    k = F.col("conv_id")
    opening = F.element_at(F.array(*[F.lit(x) for x in OPENINGS]), (k % 14 + 1).cast("int"))
    text = F.when(k % 14 == SILENT, F.lit("")).when((k % 5 == 2) & (F.col("turn") == 1), F.lit(None).cast("string")) \
        .when((k % 5 == 3) & (F.col("turn") == 1), F.lit(" ")).otherwise(F.concat(opening, F.col("text")))
    return fx.utterances(c.withColumn("text", text))


def _rule_scored(spark, sf_dir):
    p = pp.preprocess(rule_utterances(spark, sf_dir), FIXTURE_TEXT)
    return se.score_utterances(p, fx.lexicon_df(spark), fx.boosters_df(spark), fx.negators_df(spark), fx.IDIOMS)


_RULES = "WITH " + q.scored_utterances_cte(SQL_RULE_UTTERANCES, fx.IDIOMS)


@register("rule_sentiment", _RULES + f"""
SELECT session_key, dialogue_idx, pos_score, neg_score, neu_score, compound_score, {q.polarity('compound_score')} AS sentiment_category
FROM scored""")
def rule_sentiment(spark, sf_dir):
    """A2-A7 where but, least, never, kind of, idioms, boosters, blank and missing texts occur."""
    return _rule_scored(spark, sf_dir).select("session_key", "dialogue_idx", "pos_score", "neg_score", "neu_score",
                                              "compound_score", "sentiment_category")


@register("rule_sessions", _RULES + f""", {_SQL_SESSION_SENT}, {_SQL_PROGRESSION}
SELECT ss.session_key, round(ss.avg_compound, 6) AS avg_compound, {q.polarity('ss.avg_compound')} AS overall_sentiment,
  ss.scored_count, round(start_sentiment, 6) AS start_sentiment, round(end_sentiment, 6) AS end_sentiment,
  round(sentiment_shift, 6) AS sentiment_shift, round(sentiment_volatility, 6) AS sentiment_volatility, sentiment_trend
FROM ss JOIN prog USING (session_key)""")
def rule_sessions(spark, sf_dir):
    """Sessions of which some have no scored utterance."""
    sc, s = _rule_scored(spark, sf_dir), sessions(spark, sf_dir).select("session_key")
    j = se.session_sentiment(sc, s).join(se.session_progression(sc, s), "session_key")
    num = ("avg_compound", "start_sentiment", "end_sentiment", "sentiment_shift", "sentiment_volatility")
    return j.select("session_key", *[r6(F.col(c)).alias(c) for c in num], "overall_sentiment", "scored_count", "sentiment_trend")


_RULE_TOKS = q.filter_tokens(q.word_tokens(q.clean("text")), fx.STOPWORDS, 3)


@register("rule_tokens", f"""
SELECT session_key, dialogue_idx, CASE WHEN length(text) > 0 THEN {q.clean('text')} END AS processed_text,
  CASE WHEN length(text) > 0 THEN array_to_string({_RULE_TOKS}, ' ') END AS tokens_text,
  CASE WHEN length(text) > 0 THEN CAST({q.word_count("text")} AS INTEGER) END AS word_count
FROM ({SQL_RULE_UTTERANCES})""")
def rule_tokens(spark, sf_dir):
    """P2, P4, P6, P11, P14 where links, digits, contractions, quotes, blank and missing texts occur."""
    p = pp.preprocess(rule_utterances(spark, sf_dir), FIXTURE_TEXT)
    return p.select("session_key", "dialogue_idx", "processed_text", F.array_join("tokens", " ").alias("tokens_text"), "word_count")
