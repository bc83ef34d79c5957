"""Registered queries for sources, topics, cross-session analytics (second half of the catalogue)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..operators import progress as pg
from ..operators import sentiment as se
from ..operators import topics as tp
from ..options import TopicOptions
from ..functions import text as tx
from ..session import stored
from ..sources import transcripts as tr
from . import fixtures as fx
from . import sql as q
from .catalog import (_SQL_PROGRESSION, _SQL_SESSION_SENT, _TOKS, processed, r6, read, register,
                      scored, sessions, shared)

GROUP = ["patient_id"]
SCORES = ["pos_score", "neg_score", "neu_score", "compound_score", "sentiment_category"]


# ------------------------------------------------------------ shared inputs
@shared
def sessions_idx(spark, sf_dir) -> DataFrame:
    return ordering.dense_index(sessions(spark, sf_dir), ordering.session_order(), "transcript_idx", GROUP)


@shared
def docs(spark, sf_dir) -> tp.Corpus:
    return tp.corpus(processed(spark, sf_dir))


@shared
def fixed_mix(spark, sf_dir) -> DataFrame:
    return fx.fixed_document_topics(docs(spark, sf_dir).docs)


@shared
def fixed_terms(spark, sf_dir) -> DataFrame:
    return fx.fixed_topic_terms(docs(spark, sf_dir).rows)


@shared
def fixed_prevalence(spark, sf_dir) -> DataFrame:
    return tp.topic_prevalence(fixed_mix(spark, sf_dir), sessions_idx(spark, sf_dir))


@shared
def facts(spark, sf_dir) -> DataFrame:
    s = sessions_idx(spark, sf_dir)
    sc = stored(scored(spark, sf_dir).select("session_key", "dialogue_idx", *SCORES), "scores")
    ss = se.session_sentiment(sc, s.select("session_key"))
    pr = se.session_progression(sc, s.select("session_key"))
    tt = fixed_mix(spark, sf_dir).where(F.col("doc_type") == "transcript")
    return pg.session_facts(s, ss, pr, tt, fixed_terms(spark, sf_dir))


LEM = fx.values_sql(fx.LEMMAS, ["surface", "lemma"])
BASE = f"""WITH {q.scored_utterances_cte()},
ses AS ({fx.SQL_SESSIONS}),
sidx AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY session_date NULLS LAST,
           nullif(session_number, 0) NULLS LAST, file_name, session_key) - 1 AS transcript_idx FROM ses),
{_SQL_SESSION_SENT},
{_SQL_PROGRESSION},
tk AS (SELECT session_key, dialogue_idx, {_TOKS} AS a FROM u WHERE length(text) > 0),
te AS (SELECT session_key, dialogue_idx, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM tk),
lem AS (SELECT surface, min(lemma) AS lemma FROM {LEM} GROUP BY surface),
lt AS (SELECT te.session_key, te.dialogue_idx, te.pos, coalesce(lem.lemma, te.tok) AS term
       FROM te LEFT JOIN lem ON te.tok = lem.surface),
alltok AS (SELECT 'dialogue' AS doc_type, session_key, dialogue_idx, pos - 1 AS p, term FROM lt
           UNION ALL
           SELECT 'transcript', session_key, -1,
                  row_number() OVER (PARTITION BY session_key ORDER BY dialogue_idx, pos) - 1, term FROM lt),
docs AS (SELECT DISTINCT doc_type, session_key, dialogue_idx FROM alltok),
fm AS (SELECT doc_type, session_key, dialogue_idx, topic_id,
         1 + (session_key * 7 + (CASE WHEN doc_type = 'transcript' THEN {fx.TRANSCRIPT_TURN}
              ELSE dialogue_idx END) * 3 + topic_id * 5) % 11 AS w
       FROM docs, (SELECT range AS topic_id FROM range(0, {fx.NUM_FIXED_TOPICS}))),
fp AS (SELECT doc_type, session_key, dialogue_idx, CAST(topic_id AS INTEGER) AS topic_id,
         w / sum(w) OVER (PARTITION BY doc_type, session_key, dialogue_idx) AS prob FROM fm),
fpr AS (SELECT *, row_number() OVER (PARTITION BY doc_type, session_key, dialogue_idx
                                     ORDER BY prob DESC, topic_id) AS rk FROM fp WHERE prob >= 0.01),
dom AS (SELECT doc_type, session_key, dialogue_idx, topic_id AS dominant_topic, prob AS dominant_topic_prob,
          (SELECT count(*) FROM fpr x WHERE x.doc_type = fpr.doc_type AND x.session_key = fpr.session_key
             AND x.dialogue_idx = fpr.dialogue_idx) AS n_topics
        FROM fpr WHERE rk = 1),
tfq AS (SELECT term, count(*) AS c FROM lt GROUP BY term),
tt AS (SELECT CAST(r % {fx.NUM_FIXED_TOPICS} AS INTEGER) AS topic_id, term,
         CAST({fx.NUM_FIXED_TOPICS * fx.TERMS_PER_FIXED_TOPIC} - r AS DOUBLE)
           / {float(fx.NUM_FIXED_TOPICS * fx.TERMS_PER_FIXED_TOPIC)} AS weight
       FROM (SELECT term, row_number() OVER (ORDER BY c DESC, term) - 1 AS r FROM tfq)
       WHERE r < {fx.NUM_FIXED_TOPICS * fx.TERMS_PER_FIXED_TOPIC}),
ndd AS (SELECT session_key, count(*) AS nd FROM docs WHERE doc_type = 'dialogue' GROUP BY session_key),
prev AS (SELECT s.*, x.topic_id, x.prevalence FROM sidx s JOIN (
           SELECT fpr.session_key, fpr.topic_id, sum(fpr.prob) / any_value(ndd.nd) AS prevalence
           FROM fpr JOIN ndd USING (session_key) WHERE fpr.doc_type = 'dialogue'
           GROUP BY fpr.session_key, fpr.topic_id) x USING (session_key)),
ttr AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rn FROM tt),
tops AS (SELECT topic_id, string_agg(term, ', ' ORDER BY rn) FILTER (WHERE rn <= 5) AS t5,
           string_agg(term, ', ' ORDER BY rn) FILTER (WHERE rn <= 3) AS t3 FROM ttr WHERE rn <= 10
         GROUP BY topic_id),
sec AS (SELECT session_key, topic_id AS secondary FROM fpr WHERE doc_type = 'transcript' AND rk = 2),
facts AS (SELECT i.*, ss.avg_compound, ss.overall_sentiment, ss.positive_count, ss.neutral_count,
            ss.negative_count, prog.sentiment_trend, d.dominant_topic, d.dominant_topic_prob, d.n_topics,
            tops.t5, tops.t3, sec.secondary,
            coalesce(CAST(nullif(i.session_number, 0) AS BIGINT), i.transcript_idx + 1) AS display_number
          FROM sidx i JOIN ss USING (session_key) JOIN prog USING (session_key)
          LEFT JOIN (SELECT * FROM dom WHERE doc_type = 'transcript') d USING (session_key)
          LEFT JOIN tops ON tops.topic_id = d.dominant_topic
          LEFT JOIN sec USING (session_key))"""


def _sql(body: str) -> str:
    return f"{BASE}\n{body}"


# ================================================================ S: sources
@register("transcript_roundtrip", """
SELECT conv_id AS session_key, CAST(turn AS BIGINT) AS dialogue_idx, role AS speaker,
       array_to_string(list_filter(string_split(regexp_replace(text, '^\\s+', ''), chr(10)),
                                   lambda l: regexp_matches(l, '\\S')), ' ') AS text
FROM conversations""")
def transcript_roundtrip(spark, sf_dir):
    """Render each conversation as a ``role: text`` transcript, parse it back."""
    c = read(spark, sf_dir, "conversations")
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("l"))))
    files = c.groupBy("conv_id").agg(F.array_join(F.transform(lines, lambda x: x["l"]), "\n\n").alias("content"))
    parsed = tr.colon_dialogue(files.select(F.col("conv_id").alias("session_key"), "content"), "content")
    return tr.utterances_of(parsed)


@register("transcript_roundtrip_long", """
WITH l AS (SELECT conv_id // 200 AS session_key, role,
                  array_to_string(list_filter(string_split(regexp_replace(text, '^\\s+', ''), chr(10)),
                                              lambda l: regexp_matches(l, '\\S')), ' ') AS text,
                  row_number() OVER (PARTITION BY conv_id // 200 ORDER BY conv_id, turn) - 1 AS dialogue_idx
           FROM conversations)
SELECT session_key, CAST(dialogue_idx AS BIGINT) AS dialogue_idx, role AS speaker, text FROM l""")
def transcript_roundtrip_long(spark, sf_dir):
    """S6 on long files: 200 neighbouring conversations are one transcript, parsed back as a whole."""
    c = read(spark, sf_dir, "conversations")
    lines = F.array_sort(F.collect_list(F.struct("conv_id", "turn", F.concat_ws(": ", "role", "text").alias("l"))))
    files = c.groupBy(F.floor(F.col("conv_id") / 200).alias("session_key")).agg(
        F.array_join(F.transform(lines, lambda x: x["l"]), "\n\n").alias("content"))
    return tr.utterances_of(tr.colon_dialogue(files, "content"))


@register("transcript_roundtrip_bold", """
SELECT conv_id AS session_key, CAST(turn AS BIGINT) AS dialogue_idx, role AS speaker,
       array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '\\S')),
                                      lambda l: trim(l, ' ' || chr(9) || chr(13))), ' ') AS text
FROM conversations""")
def transcript_roundtrip_bold(spark, sf_dir):
    """Render each conversation with ``**role**`` lines, parse it back."""
    c = read(spark, sf_dir, "conversations")
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat(
        F.lit("**"), F.col("role"), F.lit("**\n\n"), F.col("text")).alias("l"))))
    files = c.groupBy(F.col("conv_id").alias("session_key")).agg(
        F.array_join(F.transform(lines, lambda x: x["l"]), "\n\n").alias("content"))
    return tr.utterances_of(tr.bold_dialogue(files, "content"))


@register("file_name_fields", """
WITH n AS (SELECT DISTINCT conv_id,
  CASE WHEN conv_id % 5 = 0 THEN '2023-02-30_session_' || CAST(conv_id AS VARCHAR) || '.txt'
       WHEN conv_id % 5 = 1 THEN 'session_' || strftime(DATE '2023-01-01' + CAST(conv_id AS INTEGER), '%Y-%m-%d') || '_' || lpad(CAST(conv_id % 13 AS VARCHAR), 3, '0') || '.mdx'
       WHEN conv_id % 5 = 2 THEN 'notes_' || CAST(conv_id AS VARCHAR) || '.md'
       ELSE 'session_' || strftime(DATE '2023-01-01' + CAST(conv_id AS INTEGER), '%Y-%m-%d') || '_new.mdx' END AS file_name
  FROM conversations)
SELECT conv_id, file_name,
  CAST(try_strptime(nullif(regexp_extract(file_name, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''), '%Y-%m-%d') AS DATE) AS session_date,
  TRY_CAST(nullif(regexp_extract(file_name, '_([0-9]+)\\.\\w+$', 1), '') AS INTEGER) AS session_number
FROM n""")
def file_name_fields(spark, sf_dir):
    """Date and number parsed from file names derived from conversation ids."""
    c = read(spark, sf_dir, "conversations").select("conv_id").distinct()
    k = F.col("conv_id")
    d = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd")
    name = (F.when(k % 5 == 0, F.concat(F.lit("2023-02-30_session_"), k.cast("string"), F.lit(".txt")))
             .when(k % 5 == 1, F.concat(F.lit("session_"), d, F.lit("_"),
                                        F.lpad((k % 13).cast("string"), 3, "0"), F.lit(".mdx")))
             .when(k % 5 == 2, F.concat(F.lit("notes_"), k.cast("string"), F.lit(".md")))
             .otherwise(F.concat(F.lit("session_"), d, F.lit("_new.mdx"))))
    n = c.select("conv_id", name.alias("file_name"))
    return n.select("conv_id", "file_name", tr.file_date(F.col("file_name")).alias("session_date"),
                    tr.file_number(F.col("file_name")).alias("session_number"))


@register("session_index", _sql("SELECT session_key, patient_id, transcript_idx FROM sidx"))
def session_index(spark, sf_dir):
    """Per-client session ordinal (date, number with 0 missing, name)."""
    return sessions_idx(spark, sf_dir).select("session_key", "patient_id", "transcript_idx")


@register("session_index_global", f"""
SELECT session_key, row_number() OVER (ORDER BY session_date NULLS LAST, nullif(session_number, 0) NULLS LAST,
       file_name, session_key) - 1 AS transcript_idx FROM ({fx.SQL_SESSIONS})""")
def session_index_global(spark, sf_dir):
    """S10 without groups: distributed dense index (no single-partition window)."""
    s = ordering.dense_index(sessions(spark, sf_dir), ordering.session_order(), "transcript_idx")
    return s.select("session_key", "transcript_idx")


# ================================================================ T: topics
@register("vocabulary", _sql("""
, df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_type, session_key, dialogue_idx, term FROM alltok)
         GROUP BY term),
n AS (SELECT count(*) AS n FROM docs),
v AS (SELECT term, df FROM df, n WHERE df >= 5 AND df <= floor(0.9 * n.n))
SELECT term, df, CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS term_index FROM v
""").replace("\n, df AS", ",\ndf AS"))
def vocabulary(spark, sf_dir):
    """Two-grain documents, document-frequency filter (min_df 5, max_df 0.9)."""
    return tp.vocabulary(docs(spark, sf_dir), TopicOptions())


@register("bag_of_words", _sql("""
, df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_type, session_key, dialogue_idx, term FROM alltok)
         GROUP BY term),
n AS (SELECT count(*) AS n FROM docs),
v AS (SELECT term FROM df, n WHERE df >= 5 AND df <= floor(0.9 * n.n))
SELECT doc_type, session_key, dialogue_idx, term, count(*) AS count FROM alltok JOIN v USING (term)
GROUP BY doc_type, session_key, dialogue_idx, term
""").replace("\n, df AS", ",\ndf AS"))
def bag_of_words(spark, sf_dir):
    """T4: term counts per document over the filtered vocabulary."""
    d = docs(spark, sf_dir)
    return tp.bag_of_words(d, tp.vocabulary(d, TopicOptions()))


@register("lda_topic_terms")
def lda_topic_terms(spark, sf_dir):
    """Online LDA (k=5, 10 passes, learned alpha, fixed seed); top-20 terms per topic."""
    m = tp.fit_topics(docs(spark, sf_dir), TopicOptions())
    return m.topic_terms if m is not None else tp.empty_topic_terms(spark)


@register("lda_document_topics")
def lda_document_topics(spark, sf_dir):
    """LDA mixtures (prob >= 0.01, sorted), dominant topic, prior for all-OOV documents."""
    m = tp.fit_topics(docs(spark, sf_dir), TopicOptions())
    return m.document_topics.select("doc_type", "session_key", "dialogue_idx", "dominant_topic",
                                    "dominant_topic_prob",
                                    F.size("topic_distribution").alias("n_topics"))


@register("dominant_topic", _sql("""
SELECT doc_type, session_key, dialogue_idx, dominant_topic, round(dominant_topic_prob, 6) AS dominant_topic_prob,
       CAST(n_topics AS INTEGER) AS n_topics FROM dom"""))
def dominant_topic(spark, sf_dir):
    """T8-T9 on the fixture mixtures."""
    return fixed_mix(spark, sf_dir).select("doc_type", "session_key", "dialogue_idx", "dominant_topic",
                                           r6(F.col("dominant_topic_prob")).alias("dominant_topic_prob"),
                                           F.size("topic_distribution").alias("n_topics"))


@register("topic_prevalence", _sql(
    "SELECT session_key, patient_id, transcript_idx, topic_id, round(prevalence, 6) AS prevalence FROM prev"))
def topic_prevalence(spark, sf_dir):
    """T12 on the fixture mixtures."""
    return fixed_prevalence(spark, sf_dir).select("session_key", "patient_id", "transcript_idx", "topic_id",
                                                  r6(F.col("prevalence")).alias("prevalence"))


_COHERENCE = """
, tw AS (SELECT topic_id, term FROM ttr WHERE rn <= 20),
rel AS (SELECT DISTINCT term FROM tw),
lens AS (SELECT doc_type, session_key, dialogue_idx, count(*) AS L FROM alltok GROUP BY ALL),
wins AS (SELECT doc_type, session_key, dialogue_idx, L,
           unnest(range(0, CASE WHEN L >= 110 THEN L - 110 + 1 ELSE 1 END)) AS s FROM lens),
occ AS (SELECT a.doc_type, a.session_key, a.dialogue_idx, a.p, a.term FROM alltok a JOIN rel USING (term)),
wo AS (SELECT DISTINCT w.doc_type, w.session_key, w.dialogue_idx, w.s, o.term FROM wins w JOIN occ o
         ON w.doc_type = o.doc_type AND w.session_key = o.session_key AND w.dialogue_idx = o.dialogue_idx
        AND (w.L < 110 OR (o.p >= w.s AND o.p < w.s + 110))),
nw AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM wins),
cnt AS (SELECT term, count(*) AS c FROM wo GROUP BY term),
co AS (SELECT a.term AS w1, b.term AS w2, count(*) AS co FROM wo a JOIN wo b
         ON a.doc_type = b.doc_type AND a.session_key = b.session_key AND a.dialogue_idx = b.dialogue_idx
        AND a.s = b.s AND a.term < b.term GROUP BY a.term, b.term),
pr AS (SELECT x.topic_id, x.term AS wi, y.term AS wj, ci.c AS ci, cj.c AS cj,
         CASE WHEN x.term = y.term THEN ci.c ELSE coalesce(co.co, 0) END AS cc
       FROM tw x JOIN tw y USING (topic_id) JOIN cnt ci ON ci.term = x.term JOIN cnt cj ON cj.term = y.term
       LEFT JOIN co ON co.w1 = least(x.term, y.term) AND co.w2 = greatest(x.term, y.term)),
np AS (SELECT topic_id, wi, wj, ln((cc / nw.n + 1e-12) / ((ci / nw.n) * (cj / nw.n))) / (-ln(cc / nw.n + 1e-12)) AS npmi
       FROM pr, nw),
vv AS (SELECT topic_id, wj, sum(npmi) AS vj FROM np GROUP BY topic_id, wj),
vn AS (SELECT topic_id, sqrt(sum(vj * vj)) AS vn FROM vv GROUP BY topic_id),
uu AS (SELECT np.topic_id, wi, sum(npmi * vj) AS dot, sqrt(sum(npmi * npmi)) AS un
       FROM np JOIN vv USING (topic_id, wj) GROUP BY np.topic_id, wi),
pt AS (SELECT uu.topic_id, avg(dot / (un * vn)) AS coherence FROM uu JOIN vn USING (topic_id) GROUP BY uu.topic_id)
SELECT topic_id, round(coherence, 6) AS coherence FROM pt
UNION ALL SELECT -1, round(avg(coherence), 6) FROM pt"""


@register("topic_coherence", _sql(_COHERENCE).replace("\n, tw AS", ",\ntw AS"))
def topic_coherence(spark, sf_dir):
    """c_v coherence of the fixture topics over the two-grain documents (window 110)."""
    c = tp.coherence_cv(fixed_terms(spark, sf_dir), docs(spark, sf_dir))
    return c.select(F.col("topic_id").cast("int").alias("topic_id"), r6(F.col("coherence")).alias("coherence"))


@register("tfidf", _sql("""
, df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_type, session_key, dialogue_idx, term FROM alltok)
         GROUP BY term),
n AS (SELECT count(*) AS n FROM docs),
tf AS (SELECT doc_type, session_key, dialogue_idx, term, count(*) AS tf FROM alltok GROUP BY ALL)
SELECT doc_type, session_key, dialogue_idx, term, tf, round(ln((n.n + 1.0) / (df + 1.0)), 6) AS idf,
       round(tf * ln((n.n + 1.0) / (df + 1.0)), 6) AS tfidf
FROM tf JOIN df USING (term), n""").replace("\n, df AS", ",\ndf AS"))
def tfidf(spark, sf_dir):
    """TF-IDF weights of every document term."""
    t = tp.tfidf(docs(spark, sf_dir))
    return t.select("doc_type", "session_key", "dialogue_idx", "term", "tf", r6(F.col("idf")).alias("idf"),
                    r6(F.col("tfidf")).alias("tfidf"))


@register("topic_labels", _sql(
    "SELECT topic_id, string_agg(term, ', ' ORDER BY rn) AS label FROM ttr WHERE rn <= 3 GROUP BY topic_id"))
def topic_labels(spark, sf_dir):
    """Topic label from its top three terms (fixture topics)."""
    return tp.topic_labels(fixed_terms(spark, sf_dir), 3)


# ================================================================ R: progress
_SEP = " | "
SQL_INSIGHTS = f"""list_filter([
    CASE WHEN overall_sentiment = 'positive' THEN '{pg.TXT_SESSION_POSITIVE}'
         WHEN overall_sentiment = 'negative' THEN '{pg.TXT_SESSION_NEGATIVE}' END,
    CASE WHEN sentiment_trend = 'improving' THEN '{pg.TXT_TREND_IMPROVING}'
         WHEN sentiment_trend = 'deteriorating' THEN '{pg.TXT_TREND_DETERIORATING}'
         WHEN sentiment_trend = 'stable' THEN '{pg.TXT_TREND_STABLE}' END,
    CASE WHEN t5 IS NOT NULL THEN 'The session focused on themes related to ' || t5 || '.' END,
    CASE WHEN t5 IS NOT NULL AND dominant_topic_prob > 0.7
              THEN 'The session was strongly focused on a single theme (Topic ' || dominant_topic || ').'
         WHEN t5 IS NOT NULL AND dominant_topic_prob < 0.3 THEN '{pg.TXT_FOCUS_DIVERSE}' END
  ], lambda x: x IS NOT NULL)[1:5]"""
SQL_RECOMMENDATIONS = f"""coalesce(nullif(list_filter([
    CASE WHEN overall_sentiment = 'negative' THEN '{pg.REC_NEGATIVE}' END,
    CASE WHEN sentiment_trend = 'deteriorating' THEN '{pg.REC_DETERIORATING.replace("'", "''")}' END,
    CASE WHEN t3 IS NOT NULL THEN 'Continue exploring themes related to ' || t3 || ' in future sessions.' END,
    CASE WHEN t3 IS NOT NULL AND n_topics > 1 THEN 'Consider exploring Topic ' || secondary ||
         ' in more depth as it appeared as a secondary theme.' END
  ], lambda x: x IS NOT NULL), []), {q.str_list([])[:-1]}{", ".join("'" + x + "'" for x in pg.REC_SESSION_GENERIC)}])[1:5]"""


@register("session_facts", _sql(f"""
SELECT session_key, patient_id, transcript_idx, display_number, round(avg_compound, 6) AS avg_compound,
  overall_sentiment, {q.tone('avg_compound')} AS tone_description,
  CASE WHEN positive_count + neutral_count + negative_count > 0
       THEN round(positive_count / (positive_count + neutral_count + negative_count) * 100, 1) END AS positive_pct,
  CASE WHEN positive_count + neutral_count + negative_count > 0
       THEN round(negative_count / (positive_count + neutral_count + negative_count) * 100, 1) END AS negative_pct,
  dominant_topic, round(dominant_topic_prob, 6) AS dominant_topic_prob,
  array_to_string({SQL_INSIGHTS}, '{_SEP}') AS insights,
  array_to_string({SQL_RECOMMENDATIONS}, '{_SEP}') AS recommendations
FROM facts"""))
def session_facts(spark, sf_dir):
    """Per-session facts, tone words, shares, insight and recommendation rules."""
    f = facts(spark, sf_dir)
    return f.select("session_key", "patient_id", "transcript_idx", "display_number",
                    r6(F.col("avg_compound")).alias("avg_compound"), "overall_sentiment", "tone_description",
                    "positive_pct", "negative_pct", "dominant_topic",
                    r6(F.col("dominant_topic_prob")).alias("dominant_topic_prob"),
                    F.array_join("insights", _SEP).alias("insights"),
                    F.array_join("recommendations", _SEP).alias("recommendations"))


TREND_CTES = f"""
, fd AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY session_date, transcript_idx) AS ra,
           row_number() OVER (PARTITION BY patient_id ORDER BY session_date DESC, transcript_idx DESC) AS rd,
           avg_compound - lag(avg_compound) OVER (PARTITION BY patient_id ORDER BY session_date, transcript_idx) AS dlt
         FROM facts WHERE session_date IS NOT NULL),
da AS (SELECT patient_id, count(*) AS dated_sessions,
         max(CASE WHEN rd = 1 THEN avg_compound END) - max(CASE WHEN ra = 1 THEN avg_compound END) AS chg,
         count(*) FILTER (WHERE overall_sentiment = 'positive') AS positive_sessions,
         count(*) FILTER (WHERE overall_sentiment = 'negative') AS negative_sessions,
         count(*) FILTER (WHERE overall_sentiment = 'neutral') AS neutral_sessions,
         coalesce(avg(abs(dlt)), 0.0) AS vol
       FROM fd GROUP BY patient_id),
al AS (SELECT patient_id, count(*) AS sessions, min(session_date) AS first_date, max(session_date) AS last_date,
         max(CASE WHEN rdi = 1 THEN overall_sentiment END) AS latest,
         max(avg_compound) FILTER (WHERE rdi <= 3) - min(avg_compound) FILTER (WHERE rdi <= 3) AS rng3
       FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY transcript_idx DESC) AS rdi FROM facts)
       GROUP BY patient_id)"""
TREND_SELECT = f"""
SELECT al.patient_id, sessions, first_date, last_date, coalesce(dated_sessions, 0) AS dated_sessions,
  round(chg, 6) AS sentiment_change,
  CASE WHEN chg > 0.2 THEN 'significant improvement' WHEN chg > 0.05 THEN 'moderate improvement'
       WHEN chg < -0.2 THEN 'significant decline' WHEN chg < -0.05 THEN 'moderate decline'
       WHEN chg IS NOT NULL THEN 'relatively stable' END AS trend_description,
  coalesce(positive_sessions, 0) AS positive_sessions, coalesce(negative_sessions, 0) AS negative_sessions,
  coalesce(neutral_sessions, 0) AS neutral_sessions, round(vol, 6) AS between_session_volatility,
  CASE WHEN chg > 0.05 THEN '{pg.INS_IMPROVED}' WHEN chg < -0.05 THEN '{pg.INS_DECLINED}'
       WHEN chg IS NOT NULL THEN '{pg.INS_STABLE}' END AS direction_insight,
  CASE WHEN vol > 0.2 THEN '{pg.INS_VOLATILE}' WHEN vol < 0.05 THEN '{pg.INS_CONSISTENT}' END AS volatility_insight,
  CASE WHEN sessions > 1 AND latest = 'negative' THEN '{pg.REC_LATEST_NEGATIVE}' END AS latest_recommendation,
  CASE WHEN sessions >= 3 AND rng3 < 0.1 THEN '{pg.REC_STAGNATION}' END AS stagnation_recommendation
FROM al LEFT JOIN da ON al.patient_id IS NOT DISTINCT FROM da.patient_id"""


@register("corpus_trend", _sql(TREND_CTES + TREND_SELECT).replace("\n, fd AS", ",\nfd AS"))
def corpus_trend(spark, sf_dir):
    """R11-R13, R17, R18, R21, R22 per client."""
    t = pg.corpus_trend(facts(spark, sf_dir), GROUP)
    return t.select("patient_id", "sessions", "first_date", "last_date", "dated_sessions",
                    r6(F.col("sentiment_change")).alias("sentiment_change"), "trend_description",
                    "positive_sessions", "negative_sessions", "neutral_sessions",
                    r6(F.col("between_session_volatility")).alias("between_session_volatility"),
                    "direction_insight", "volatility_insight", "latest_recommendation",
                    "stagnation_recommendation")


@register("progress_table", _sql("""
SELECT patient_id, CAST(row_number() OVER (PARTITION BY patient_id ORDER BY session_date, transcript_idx) AS INTEGER)
  AS row_order,
  display_number, session_date, upper(overall_sentiment[1]) || lower(overall_sentiment[2:]) AS sentiment,
  printf('%.2f', round(CAST(avg_compound AS DECIMAL(38,10)), 2)) AS score
FROM facts WHERE session_date IS NOT NULL"""))
def progress_table(spark, sf_dir):
    """Dated sessions in date order."""
    return pg.progress_table(facts(spark, sf_dir), GROUP)


@register("recurrent_topic", _sql("""
SELECT patient_id, dominant_topic AS recurrent_topic, n AS recurrent_count FROM (
  SELECT patient_id, dominant_topic, n, row_number() OVER (PARTITION BY patient_id ORDER BY n DESC, dominant_topic) AS r
  FROM (SELECT patient_id, dominant_topic, count(*) AS n FROM facts WHERE dominant_topic IS NOT NULL
        GROUP BY patient_id, dominant_topic)) WHERE r = 1"""))
def recurrent_topic(spark, sf_dir):
    """R14 on the fixture session mixtures."""
    f = facts(spark, sf_dir).select("patient_id", "dominant_topic")
    return pg.recurrent_topic(f, GROUP)


_FL = """
, fl AS (SELECT patient_id, topic_id, count(*) AS n,
           max(CASE WHEN ra = 1 THEN prevalence END) AS first, max(CASE WHEN rd = 1 THEN prevalence END) AS last,
           avg(prevalence) AS mean_prevalence FROM (
           SELECT *, row_number() OVER (PARTITION BY patient_id, topic_id ORDER BY session_date NULLS LAST, transcript_idx) AS ra,
                  row_number() OVER (PARTITION BY patient_id, topic_id ORDER BY session_date DESC NULLS FIRST, transcript_idx DESC) AS rd
           FROM prev {where}) GROUP BY patient_id, topic_id)"""


@register("theme_evolution", _sql(_FL.format(where="WHERE session_date IS NOT NULL").replace("\n, fl AS", ",\nfl AS") + """
SELECT patient_id, topic_id, round(first, 6) AS first, round(last, 6) AS last, round(last - first, 6) AS change,
  CASE WHEN last - first > 0 THEN 'increasing' ELSE 'decreasing' END AS trend,
  CAST(row_number() OVER (PARTITION BY patient_id ORDER BY abs(last - first) DESC, topic_id) AS INTEGER) AS rank
FROM fl WHERE n > 1 AND abs(last - first) > 0.1"""))
def theme_evolution(spark, sf_dir):
    """R16 on the fixture prevalence."""
    e = pg.theme_evolution(fixed_prevalence(spark, sf_dir), GROUP)
    return e.select("patient_id", "topic_id", r6(F.col("first")).alias("first"), r6(F.col("last")).alias("last"),
                    r6(F.col("change")).alias("change"), "trend", "rank")


@register("consistent_topic", _sql(_FL.format(where="").replace("\n, fl AS", ",\nfl AS") + """
SELECT patient_id, topic_id AS consistent_topic, round(mean_prevalence, 6) AS consistent_mean FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY mean_prevalence DESC, topic_id) AS r FROM fl WHERE n > 1)
WHERE r = 1"""))
def consistent_topic(spark, sf_dir):
    """R19 on the fixture prevalence."""
    c = pg.consistent_topic(fixed_prevalence(spark, sf_dir), GROUP)
    return c.select("patient_id", "consistent_topic", r6(F.col("consistent_mean")).alias("consistent_mean"))


@register("emerging_topic", _sql(_FL.format(where="").replace("\n, fl AS", ",\nfl AS") + """
SELECT patient_id, topic_id AS emerging_topic, round(last - first, 6) AS emerging_change FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY last - first DESC, topic_id) AS r
  FROM fl WHERE n > 1 AND last - first > 0.1) WHERE r = 1"""))
def emerging_topic(spark, sf_dir):
    """R23 on the fixture prevalence (undated rows last)."""
    c = pg.emerging_topic(fixed_prevalence(spark, sf_dir), GROUP)
    return c.select("patient_id", "emerging_topic", r6(F.col("emerging_change")).alias("emerging_change"))


@register("speaker_gap", _sql(f"""
, sp AS (SELECT sc.patient_id, sc.speaker, avg(sc.compound_score) AS ac,
           min(i.transcript_idx * 1000000 + sc.dialogue_idx) AS fs
         FROM scored sc JOIN sidx i USING (session_key) WHERE sc.speaker <> '' GROUP BY sc.patient_id, sc.speaker),
g AS (SELECT patient_id,
        arg_min(ac, fs) FILTER (WHERE lower(speaker) LIKE '%client%') AS client_compound,
        arg_min(ac, fs) FILTER (WHERE lower(speaker) LIKE '%therapist%') AS therapist_compound
      FROM sp GROUP BY patient_id)
SELECT patient_id, round(client_compound, 6) AS client_compound, round(therapist_compound, 6) AS therapist_compound,
  round(client_compound - therapist_compound, 6) AS sentiment_gap,
  CASE WHEN client_compound - therapist_compound < -0.2 THEN '{pg.INS_CLIENT_NEGATIVE}'
       WHEN client_compound - therapist_compound > 0.2 THEN '{pg.INS_CLIENT_POSITIVE}' END AS gap_insight
FROM g""").replace("\n, sp AS", ",\nsp AS"))
def speaker_gap(spark, sf_dir):
    """Client vs therapist mean compound per client group."""
    g = pg.speaker_gap(scored(spark, sf_dir), sessions_idx(spark, sf_dir), GROUP)
    return g.select("patient_id", *[r6(F.col(c)).alias(c) for c in
                                    ("client_compound", "therapist_compound", "sentiment_gap")], "gap_insight")


# ================================================================ D: documented extras
@register("moving_average", _sql("""
SELECT patient_id, session_key, session_date, round(avg_compound, 6) AS avg_compound,
  round(avg(avg_compound) OVER (PARTITION BY patient_id ORDER BY session_date, transcript_idx
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM facts WHERE session_date IS NOT NULL"""))
def moving_average(spark, sf_dir):
    """Three-session moving average of session tone."""
    m = pg.moving_average(facts(spark, sf_dir), 3, GROUP)
    return m.select("patient_id", "session_key", "session_date", r6(F.col("avg_compound")).alias("avg_compound"),
                    r6(F.col("moving_avg")).alias("moving_avg"))


@register("linear_trend", _sql("""
SELECT patient_id, round(regr_slope(avg_compound, CAST(transcript_idx AS DOUBLE)), 6) AS slope, count(*) AS n
FROM facts GROUP BY patient_id"""))
def linear_trend(spark, sf_dir):
    """Slope of session tone over session ordinal."""
    t = pg.linear_trend(facts(spark, sf_dir), GROUP)
    return t.select("patient_id", r6(F.col("slope")).alias("slope"), "n")


@register("change_flags", _sql("""
SELECT patient_id, session_key, transcript_idx, round(avg_compound, 6) AS avg_compound, round(d, 6) AS delta,
  abs(d) > 0.05 AS significant FROM (
  SELECT *, avg_compound - lag(avg_compound) OVER (PARTITION BY patient_id ORDER BY transcript_idx) AS d FROM facts)"""))
def change_flags(spark, sf_dir):
    """D3: significant session-to-session changes (threshold 0.05)."""
    c = pg.change_flags(facts(spark, sf_dir), 0.05, GROUP)
    return c.select("patient_id", "session_key", "transcript_idx", r6(F.col("avg_compound")).alias("avg_compound"),
                    r6(F.col("delta")).alias("delta"), "significant")


@register("emotional_peaks", _sql("""
SELECT session_key, dialogue_idx, compound_score, sentiment_category,
  CASE WHEN compound_score > pv AND compound_score > nx THEN 'peak'
       WHEN compound_score < pv AND compound_score < nx THEN 'trough' END AS extremum,
  pc <> sentiment_category AS transition
FROM (SELECT *, lag(compound_score) OVER w AS pv, lead(compound_score) OVER w AS nx, lag(sentiment_category) OVER w AS pc
      FROM (SELECT *, """ + q.polarity("compound_score") + """ AS sentiment_category FROM scored)
      WINDOW w AS (PARTITION BY session_key ORDER BY dialogue_idx))"""))
def emotional_peaks(spark, sf_dir):
    """Peaks, troughs and label transitions inside sessions."""
    return pg.emotional_peaks(scored(spark, sf_dir))


@register("speaker_by_session", _sql("""
SELECT session_key, round(avg(compound_score) FILTER (WHERE speaker = 'Client'), 6) AS Client,
  round(avg(compound_score) FILTER (WHERE speaker = 'Therapist'), 6) AS Therapist
FROM scored GROUP BY session_key"""))
def speaker_by_session(spark, sf_dir):
    """Client and therapist tone per session (pivot)."""
    p = pg.speaker_by_session(scored(spark, sf_dir))
    return p.select("session_key", r6(F.col("Client")).alias("Client"), r6(F.col("Therapist")).alias("Therapist"))


# ================================================================ V: chart tables
from ..operators import charts as ch  # noqa: E402
from ..operators import enrich as en  # noqa: E402
from ..operators import reports as rp  # noqa: E402
from ..options import EnrichOptions, ReportOptions  # noqa: E402


def session_sent_idx(spark, sf_dir) -> DataFrame:
    s = sessions_idx(spark, sf_dir)
    return se.session_sentiment(scored(spark, sf_dir), s)


@register("chart_sentiment_over_time", _sql("""
, b AS (SELECT patient_id, least(min(avg_compound), -0.1) AS lo, greatest(max(avg_compound), 0.1) AS hi
        FROM facts WHERE session_date IS NOT NULL GROUP BY patient_id)
SELECT f.patient_id, session_key, session_date, round(avg_compound, 6) AS avg_compound, overall_sentiment,
  round(lo - (hi - lo) * 0.1, 6) AS y_min, round(hi + (hi - lo) * 0.1, 6) AS y_max
FROM facts f JOIN b ON f.patient_id IS NOT DISTINCT FROM b.patient_id WHERE session_date IS NOT NULL""").replace("\n, b AS", ",\nb AS"))
def chart_sentiment_over_time(spark, sf_dir):
    """V1: dated session tone with padded axis bounds per client."""
    v = ch.sentiment_over_time(session_sent_idx(spark, sf_dir), GROUP)
    return v.select("patient_id", "session_key", "session_date", r6(F.col("avg_compound")).alias("avg_compound"),
                    "overall_sentiment", r6(F.col("y_min")).alias("y_min"), r6(F.col("y_max")).alias("y_max"))


@register("chart_compound_histogram", _sql("""
, rg AS (SELECT min(compound_score) AS lo, max(compound_score) AS hi FROM scored),
bb AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((compound_score - lo) / ((hi - lo) / 30)) AS BIGINT) + 1, 30) END AS bin,
         lo, hi FROM scored, rg)
SELECT CAST(bin AS INTEGER) AS bin, round(min(lo) + (bin - 1) * (min(hi) - min(lo)) / 30, 6) AS bin_start, count(*) AS count
FROM bb GROUP BY bin""").replace("\n, rg AS", ",\nrg AS"))
def chart_compound_histogram(spark, sf_dir):
    """V2: 30 equal-width bins of utterance compound scores."""
    h = ch.compound_histogram(scored(spark, sf_dir), 30)
    return h.select("bin", r6(F.col("bin_start")).alias("bin_start"), "count")


@register("chart_speaker_bars", _sql("""
SELECT speaker, round(avg(compound_score), 6) AS avg_compound,
  CASE WHEN avg(compound_score) > 0.05 THEN 'positive' WHEN avg(compound_score) < -0.05 THEN 'negative'
       ELSE 'neutral' END AS color_class
FROM scored WHERE speaker <> '' GROUP BY speaker"""))
def chart_speaker_bars(spark, sf_dir):
    """V3: speaker bars with a per-row colour class."""
    b = ch.speaker_bars(se.speaker_sentiment(scored(spark, sf_dir)))
    return b.select("speaker", r6(F.col("avg_compound")).alias("avg_compound"), "color_class")


@register("chart_progression", _sql("""
SELECT session_key, session_date, round(start_sentiment, 6) AS start_sentiment, round(end_sentiment, 6) AS end_sentiment,
  round(sentiment_shift, 6) AS sentiment_shift,
  CASE WHEN sentiment_shift > 0 THEN 'up' WHEN sentiment_shift < 0 THEN 'down' ELSE 'flat' END AS direction
FROM prog WHERE session_date IS NOT NULL"""))
def chart_progression(spark, sf_dir):
    """V4: start/end/shift of dated sessions."""
    p = ch.progression_bars(se.session_progression(scored(spark, sf_dir), sessions(spark, sf_dir)))
    return p.select("session_key", "session_date", *[r6(F.col(c)).alias(c) for c in
                                                     ("start_sentiment", "end_sentiment", "sentiment_shift")],
                    "direction")


@register("chart_topic_terms", _sql("""
SELECT topic_id, term, weight, CAST(rn AS INTEGER) AS rank FROM ttr WHERE rn <= 15 AND topic_id < 6"""))
def chart_topic_terms(spark, sf_dir):
    """V5: top 15 terms of the first six topics (fixture topics)."""
    t = ch.topic_term_bars(fixed_terms(spark, sf_dir))
    return t.select("topic_id", "term", "weight", F.col("rank").cast("int").alias("rank"))


@register("chart_prevalence_pivot", _sql("""
SELECT session_date, """ + ", ".join(
    f"round(avg(prevalence) FILTER (WHERE topic_id = {i}), 6) AS \"{i}\"" for i in range(fx.NUM_FIXED_TOPICS)) + """
FROM prev WHERE session_date IS NOT NULL GROUP BY session_date"""))
def chart_prevalence_pivot(spark, sf_dir):
    """V6: date x topic mean prevalence."""
    p = ch.prevalence_pivot(fixed_prevalence(spark, sf_dir), list(range(fx.NUM_FIXED_TOPICS)))
    return p.select("session_date", *[r6(F.col(str(i))).alias(str(i)) for i in range(fx.NUM_FIXED_TOPICS)])


@register("chart_dominant_counts", _sql("""
SELECT dominant_topic, count(*) AS sessions FROM dom WHERE doc_type = 'transcript' GROUP BY dominant_topic"""))
def chart_dominant_counts(spark, sf_dir):
    """V7: sessions per dominant topic."""
    return ch.dominant_topic_counts(fixed_mix(spark, sf_dir))


@register("chart_sentiment_by_topic", _sql("""
SELECT d.dominant_topic, round(avg(s.compound_score), 6) AS avg_compound, count(*) AS utterances,
  CASE WHEN avg(s.compound_score) > 0.05 THEN 'positive' WHEN avg(s.compound_score) < -0.05 THEN 'negative'
       ELSE 'neutral' END AS color_class
FROM dom d JOIN scored s USING (session_key, dialogue_idx) WHERE d.doc_type = 'dialogue' GROUP BY d.dominant_topic"""))
def chart_sentiment_by_topic(spark, sf_dir):
    """V8: mean utterance tone by dominant topic."""
    v = ch.sentiment_by_topic(fixed_mix(spark, sf_dir), scored(spark, sf_dir))
    return v.select("dominant_topic", r6(F.col("avg_compound")).alias("avg_compound"), "utterances", "color_class")


@register("chart_prevalence_sentiment", _sql("""
, pv AS (SELECT session_date, """ + ", ".join(
    f"avg(prevalence) FILTER (WHERE topic_id = {i}) AS \"{i}\"" for i in range(fx.NUM_FIXED_TOPICS)) + """
      FROM prev WHERE session_date IS NOT NULL GROUP BY session_date)
SELECT pv.session_date, """ + ", ".join(f"round(pv.\"{i}\", 6) AS \"{i}\"" for i in range(fx.NUM_FIXED_TOPICS)) + """,
  f.session_key, round(f.avg_compound, 6) AS avg_compound
FROM pv JOIN facts f ON f.session_date = pv.session_date""").replace("\n, pv AS", ",\npv AS"))
def chart_prevalence_sentiment(spark, sf_dir):
    """V9: prevalence pivot joined to session tone on date."""
    p = ch.prevalence_pivot(fixed_prevalence(spark, sf_dir), list(range(fx.NUM_FIXED_TOPICS)))
    j = ch.prevalence_with_sentiment(p, session_sent_idx(spark, sf_dir))
    return j.select("session_date", *[r6(F.col(str(i))).alias(str(i)) for i in range(fx.NUM_FIXED_TOPICS)],
                    "session_key", r6(F.col("avg_compound")).alias("avg_compound"))


# ================================================================ L: enrichment prompts
def _content(spark, sf_dir):
    u = processed(spark, sf_dir, False)
    return en.session_content(sessions(spark, sf_dir), u.select("session_key", "dialogue_idx", "speaker", "text"))


_SQL_CONTENT = """
, content AS (SELECT s.*, coalesce(c.content, '') AS content FROM ses s LEFT JOIN (
    SELECT session_key, string_agg(coalesce(speaker, 'Unknown') || ': ' || coalesce(text, ''), chr(10) || chr(10)
                                   ORDER BY dialogue_idx) AS content FROM u GROUP BY session_key) c USING (session_key))"""


@register("session_content", _sql(_SQL_CONTENT.replace("\n, content AS", ",\ncontent AS") +
                                  "\nSELECT session_key, content FROM content"))
def session_content(spark, sf_dir):
    """L1: session content rebuilt from utterances (no raw file content in the table)."""
    return _content(spark, sf_dir).select("session_key", "content")


@register("summary_prompts", _sql(_SQL_CONTENT.replace("\n, content AS", ",\ncontent AS") + f"""
SELECT session_key,
  CASE WHEN length(content) > 0 THEN '{en.SUMMARY_ASK.replace(chr(10), "' || chr(10) || '")}'
    || 'Session metadata: Date: ' || coalesce(strftime(session_date, '%Y-%m-%d %H:%M:%S'), 'None')
    || ', Session number: ' || coalesce(CAST(session_number AS VARCHAR), 'None') || chr(10)
    || 'Patient: Unknown' || chr(10) || chr(10) || 'TRANSCRIPT:' || chr(10) || content END AS prompt,
  CASE WHEN length(content) = 0 THEN 'No content found in transcript' END AS error
FROM content"""))
def summary_prompts(spark, sf_dir):
    """L2: per-session summary prompt."""
    return en.summary_prompts(_content(spark, sf_dir))


def _fake_completer(prompts):
    """Deterministic stand-in for a model: a sectioned reply derived from each prompt."""
    out = []
    for p in prompts:
        n = len(p)
        out.append(f"Summary:\n\nThe prompt has {n} characters.\n\nKey insights: length {n % 7}\n\n"
                   f"Emotional themes: {n % 3}\n\nTherapeutic focus: {n % 5}")
    return out


@register("enrichment_replies", _sql(_SQL_CONTENT.replace("\n, content AS", ",\ncontent AS") + f""",
pr AS (SELECT session_key, content, length('{en.SUMMARY_ASK.replace(chr(10), "' || chr(10) || '")}'
    || 'Session metadata: Date: ' || coalesce(strftime(session_date, '%Y-%m-%d %H:%M:%S'), 'None')
    || ', Session number: ' || coalesce(CAST(session_number AS VARCHAR), 'None') || chr(10)
    || 'Patient: Unknown' || chr(10) || chr(10) || 'TRANSCRIPT:' || chr(10) || content) AS n FROM content)
SELECT session_key,
  CASE WHEN length(content) > 0 THEN 'The prompt has ' || n || ' characters.' END AS summary,
  CASE WHEN length(content) > 0 THEN 'Key insights: length ' || n % 7 END AS insights,
  CASE WHEN length(content) > 0 THEN 'Emotional themes: ' || n % 3 END AS emotional_themes,
  CASE WHEN length(content) > 0 THEN 'Therapeutic focus: ' || n % 5 END AS therapeutic_focus,
  CASE WHEN length(content) > 0 THEN CAST(5 AS INTEGER) END AS n_paragraphs,
  CASE WHEN length(content) = 0 THEN 'No content found in transcript' END AS error
FROM pr"""))
def enrichment_replies(spark, sf_dir):
    """Batch completion with an injected function, reply sectioning and paragraphs."""
    pr = en.summary_prompts(_content(spark, sf_dir))
    done = en.complete(pr, _fake_completer)
    parsed = done.withColumn("p", en.parse_reply(F.col("response")))
    return parsed.select("session_key", F.col("p.summary").alias("summary"),
                         F.array_join("p.insights", _SEP).alias("insights"),
                         F.array_join("p.emotional_themes", _SEP).alias("emotional_themes"),
                         F.array_join("p.therapeutic_focus", _SEP).alias("therapeutic_focus"),
                         F.when(F.col("response").isNotNull(), F.size(en.paragraphs(F.col("response")))).alias("n_paragraphs"),
                         "error")


# ================================================================ R26-R29: report text
def _reports(spark, sf_dir, as_lines=False):
    """All report inputs, with the tables several branches read checkpointed once.

    The scored utterances (narrow), the session facts and the prevalence
    feed many roll-ups each; materialising them in the checkpoint folder
    keeps every branch from re-deriving them from the raw text.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    s = sessions_idx(spark, sf_dir)
    sc = scored(spark, sf_dir).select("session_key", "dialogue_idx", "speaker", "patient_id", "pos_score",
                                      "neg_score", "neu_score", "compound_score", "sentiment_category") \
        .checkpoint(eager=True)
    mix = fixed_mix(spark, sf_dir).checkpoint(eager=True)
    terms = fixed_terms(spark, sf_dir).checkpoint(eager=True)
    ss = se.session_sentiment(sc, s.select("session_key"))
    pr = se.session_progression(sc, s.select("session_key"))
    f = pg.session_facts(s, ss, pr, mix.where(F.col("doc_type") == "transcript"), terms).checkpoint(eager=True)
    prev = tp.topic_prevalence(mix, s).checkpoint(eager=True)
    args = (f, pg.corpus_trend(f, GROUP), pg.recurrent_topic(f.select("patient_id", "dominant_topic"), GROUP),
            pg.theme_evolution(prev, GROUP), pg.consistent_topic(prev, GROUP), pg.emerging_topic(prev, GROUP),
            pg.speaker_gap(sc, s, GROUP), terms, GROUP, ReportOptions())
    if as_lines:
        return rp.overall_report_lines(*args)
    return rp.all_reports(rp.session_reports(f, ReportOptions()), rp.overall_reports(*args))


# ================================================================ L3-L6 prompt parts, D6, D8, D10, D11
def _sent_info(spark, sf_dir):
    s = sessions_idx(spark, sf_dir)
    sc = stored(scored(spark, sf_dir).select("session_key", "dialogue_idx", *SCORES), "scores")
    return en.sentiment_highlights(se.session_sentiment(sc, s.select("session_key")),
                                   se.session_progression(sc, s.select("session_key")))


def _topic_info(spark, sf_dir):
    return en.topic_highlights(fixed_mix(spark, sf_dir).where(F.col("doc_type") == "transcript"),
                               fixed_terms(spark, sf_dir))


def _p2(x: str) -> str:
    """'%.2f' as Java formats it: half-up on the shortest decimal form of the double."""
    return f"printf('%.2f', round(CAST({x} AS DECIMAL(38,10)), 2))"


_SQL_SENT_INFO = f"""
, sinfo AS (SELECT ss.session_key, 'Overall sentiment: ' || ss.overall_sentiment || chr(10) || 'Compound score: '
    || {_p2('ss.avg_compound')} || chr(10) || 'Positive: ' || {_p2('ss.avg_positive')} || ', Negative: '
    || {_p2('ss.avg_negative')} || ', Neutral: ' || {_p2('ss.avg_neutral')} || chr(10)
    || 'Sentiment trend: ' || prog.sentiment_trend || chr(10) || 'Start sentiment: '
    || coalesce({_p2('prog.start_sentiment')}, 'nan') || ', End sentiment: '
    || coalesce({_p2('prog.end_sentiment')}, 'nan') || chr(10) || 'Sentiment shift: '
    || {_p2('prog.sentiment_shift')} || chr(10) AS sentiment_info
  FROM ss JOIN prog USING (session_key)),
tinfo AS (SELECT d.session_key, 'Dominant topic: Topic ' || CAST(d.dominant_topic AS VARCHAR) || ' (probability: '
    || {_p2('d.dominant_topic_prob')} || ')' || chr(10)
    || coalesce('Top terms: ' || t10.terms || chr(10), '') AS topic_info
  FROM dom d LEFT JOIN (SELECT topic_id, string_agg(term, ', ' ORDER BY rn) AS terms FROM ttr WHERE rn <= 10
                        GROUP BY topic_id) t10 ON t10.topic_id = d.dominant_topic
  WHERE d.doc_type = 'transcript')"""


@register("sentiment_highlights", _sql(_SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS")
                                       + "\nSELECT session_key, sentiment_info FROM sinfo"))
def sentiment_highlights(spark, sf_dir):
    """L3: sentiment highlight text per session."""
    return _sent_info(spark, sf_dir)


@register("topic_highlights", _sql(_SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS")
                                   + "\nSELECT session_key, topic_info FROM tinfo"))
def topic_highlights(spark, sf_dir):
    """L4: dominant topic, probability and top-10 terms per session (fixture topics)."""
    return _topic_info(spark, sf_dir)


_PATIENT = "'Patient: Unknown' || chr(10) || chr(10)"
_META = ("'Session metadata: Date: ' || coalesce(strftime(c.session_date, '%Y-%m-%d %H:%M:%S'), 'None') "
         "|| ', Session number: ' || coalesce(CAST(c.session_number AS VARCHAR), 'None') || chr(10) || " + _PATIENT)


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@register("analysis_prompts_compat", _sql(
    _SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS") + "," +
    _SQL_CONTENT.replace("\n, content AS", "\ncontent AS") + f"""
SELECT c.session_key, {_lit(en.ANALYSIS_ASK)} || {_META} || 'SENTIMENT ANALYSIS:' || chr(10)
  || coalesce(si.sentiment_info, {_lit(en.NO_SENTIMENT)}) || chr(10) || chr(10) || 'TOPIC ANALYSIS:' || chr(10)
  || coalesce(ti.topic_info, {_lit(en.NO_TOPIC)}) || chr(10) || chr(10) || 'TRANSCRIPT:' || chr(10)
  || CASE WHEN length(c.content) > 4000 THEN substr(c.content, 1, 4000) || '...' ELSE c.content END AS prompt,
  CAST(NULL AS VARCHAR) AS error
FROM content c LEFT JOIN sinfo si USING (session_key) LEFT JOIN tinfo ti USING (session_key)"""))
def analysis_prompts_compat(spark, sf_dir):
    """Combined prompt (sentiment + topic highlights + content cut to 4000 characters)."""
    return en.analysis_prompts(_content(spark, sf_dir), _sent_info(spark, sf_dir), _topic_info(spark, sf_dir),
                               EnrichOptions(content_chars=en.COMPAT_CHARS))


@register("analysis_prompts", _sql(
    _SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS") + "," +
    _SQL_CONTENT.replace("\n, content AS", "\ncontent AS") + f"""
SELECT c.session_key, {_lit(en.ANALYSIS_ASK)} || {_META} || 'SENTIMENT ANALYSIS:' || chr(10)
  || coalesce(si.sentiment_info, {_lit(en.NO_SENTIMENT)}) || chr(10) || chr(10) || 'TOPIC ANALYSIS:' || chr(10)
  || coalesce(ti.topic_info, {_lit(en.NO_TOPIC)}) || chr(10) || chr(10) || 'TRANSCRIPT:' || chr(10)
  || c.content AS prompt, CAST(NULL AS VARCHAR) AS error
FROM content c LEFT JOIN sinfo si USING (session_key) LEFT JOIN tinfo ti USING (session_key)"""))
def analysis_prompts(spark, sf_dir):
    """Combined prompt with the whole content (the default)."""
    return en.analysis_prompts(_content(spark, sf_dir), _sent_info(spark, sf_dir), _topic_info(spark, sf_dir))


@register("progress_prompts_compat", _sql(
    _SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS") + f""",
f5 AS (SELECT session_key, string_agg(coalesce(speaker, 'Unknown') || ': ' || substr(coalesce(text, ''), 1, 100) || '...',
                                      chr(10) ORDER BY dialogue_idx) AS preview
       FROM u WHERE dialogue_idx < 5 GROUP BY session_key),
blk AS (SELECT i.patient_id, i.transcript_idx, 'SESSION ' || coalesce(CAST(i.session_number AS VARCHAR), 'None') || ' ('
    || coalesce(strftime(i.session_date, '%Y-%m-%d %H:%M:%S'), 'None') || '):' || chr(10) || 'Content preview: '
    || coalesce(f5.preview, '') || chr(10) || 'Sentiment: ' || coalesce(si.sentiment_info, {_lit(en.NO_SENTIMENT)})
    || chr(10) || 'Topics: ' || coalesce(ti.topic_info, {_lit(en.NO_TOPIC)}) || chr(10) AS block
  FROM sidx i LEFT JOIN f5 USING (session_key) LEFT JOIN sinfo si USING (session_key)
  LEFT JOIN tinfo ti USING (session_key))
SELECT patient_id, CASE WHEN count(*) >= 2 THEN 'Please analyze these therapy session transcripts from the client'
    || ' and provide insights about the client''s progress across sessions:' || chr(10) || chr(10)
    || {_lit(en.PROGRESS_ASK)} || 'SESSION DATA:' || chr(10) || chr(10)
    || string_agg(block, chr(10) || chr(10) ORDER BY transcript_idx) END AS prompt,
  CASE WHEN count(*) < 2 THEN 'Need at least 2 transcripts to analyze progress' END AS error
FROM blk GROUP BY patient_id"""))
def progress_prompts_compat(spark, sf_dir):
    """One progress prompt per client (sessions in index order, the reference's preview)."""
    u = processed(spark, sf_dir, False).select("session_key", "dialogue_idx", "speaker", "text")
    return en.progress_prompts(sessions_idx(spark, sf_dir), u, _sent_info(spark, sf_dir),
                               _topic_info(spark, sf_dir), GROUP, compat=True)


@register("progress_prompts", _sql(
    _SQL_SENT_INFO.replace("\n, sinfo AS", ",\nsinfo AS") + f""",
ent AS (SELECT session_key, string_agg(coalesce(speaker, 'Unknown') || ': ' || coalesce(text, ''),
                                      chr(10) ORDER BY dialogue_idx) AS preview
       FROM u GROUP BY session_key),
blk AS (SELECT i.patient_id, i.transcript_idx, 'SESSION ' || coalesce(CAST(i.session_number AS VARCHAR), 'None') || ' ('
    || coalesce(strftime(i.session_date, '%Y-%m-%d %H:%M:%S'), 'None') || '):' || chr(10) || 'Content: '
    || coalesce(ent.preview, '') || chr(10) || 'Sentiment: ' || coalesce(si.sentiment_info, {_lit(en.NO_SENTIMENT)})
    || chr(10) || 'Topics: ' || coalesce(ti.topic_info, {_lit(en.NO_TOPIC)}) || chr(10) AS block
  FROM sidx i LEFT JOIN ent USING (session_key) LEFT JOIN sinfo si USING (session_key)
  LEFT JOIN tinfo ti USING (session_key))
SELECT patient_id, CASE WHEN count(*) >= 2 THEN 'Please analyze these therapy session transcripts from the client'
    || ' and provide insights about the client''s progress across sessions:' || chr(10) || chr(10)
    || {_lit(en.PROGRESS_ASK)} || 'SESSION DATA:' || chr(10) || chr(10)
    || string_agg(block, chr(10) || chr(10) ORDER BY transcript_idx) END AS prompt,
  CASE WHEN count(*) < 2 THEN 'Need at least 2 transcripts to analyze progress' END AS error
FROM blk GROUP BY patient_id"""))
def progress_prompts(spark, sf_dir):
    """One progress prompt per client with all entries in full (the default)."""
    u = processed(spark, sf_dir, False).select("session_key", "dialogue_idx", "speaker", "text")
    return en.progress_prompts(sessions_idx(spark, sf_dir), u, _sent_info(spark, sf_dir),
                               _topic_info(spark, sf_dir), GROUP)


@register("vocabulary_shift", _sql("""
, ct AS (SELECT session_key, term, count(*) AS n FROM lt JOIN u USING (session_key, dialogue_idx)
         WHERE u.speaker = 'Client' GROUP BY session_key, term),
tot AS (SELECT session_key, sum(n) AS total FROM ct GROUP BY session_key),
fr AS (SELECT session_key, term, n / total AS f FROM ct JOIN tot USING (session_key)),
pr AS (SELECT patient_id, session_key, lead(session_key) OVER (PARTITION BY patient_id ORDER BY transcript_idx) AS next_key
       FROM sidx),
pp AS (SELECT * FROM pr WHERE next_key IS NOT NULL),
cur AS (SELECT pp.patient_id, pp.session_key, pp.next_key, fr.term, fr.f AS f_prev FROM pp JOIN fr USING (session_key)),
nxt AS (SELECT pp.patient_id, pp.session_key, pp.next_key, fr.term, fr.f AS f_next FROM pp
        JOIN fr ON fr.session_key = pp.next_key),
jn AS (SELECT coalesce(cur.patient_id, nxt.patient_id) AS patient_id, coalesce(cur.session_key, nxt.session_key) AS session_key,
        coalesce(cur.next_key, nxt.next_key) AS next_key, coalesce(cur.term, nxt.term) AS term,
        coalesce(f_prev, 0.0) AS f_prev, coalesce(f_next, 0.0) AS f_next
      FROM cur FULL OUTER JOIN nxt ON cur.patient_id IS NOT DISTINCT FROM nxt.patient_id AND cur.session_key = nxt.session_key
        AND cur.next_key = nxt.next_key AND cur.term = nxt.term)
SELECT patient_id, session_key, next_key, term, round(f_prev, 6) AS f_prev, round(f_next, 6) AS f_next,
  round(ln((f_next + 1e-6) / (f_prev + 1e-6)), 6) AS log_ratio FROM jn""").replace("\n, ct AS", ",\nct AS"))
def vocabulary_shift(spark, sf_dir):
    """Client term-frequency log-ratio between consecutive sessions."""
    v = pg.vocabulary_shift(processed(spark, sf_dir), sessions_idx(spark, sf_dir), "Client", GROUP)
    return v.select("patient_id", "session_key", "next_key", "term", *[r6(F.col(c)).alias(c)
                                                                      for c in ("f_prev", "f_next", "log_ratio")])


@register("choose_k")
def choose_k(spark, sf_dir):
    """Coherence of LDA fits for k in (3, 5) on the two-grain documents."""
    return tp.choose_k(docs(spark, sf_dir), [3, 5], TopicOptions())


@register("transcript_validation", _sql("""
, uv AS (SELECT session_key, count(*) AS n_utterances,
           count(DISTINCT CASE WHEN speaker <> '' THEN speaker END) AS n_speakers FROM u
         WHERE text IS NOT NULL AND length(text) > 0 GROUP BY session_key)
SELECT s.session_key, coalesce(n_utterances, 0) AS n_utterances, coalesce(n_speakers, 0) AS n_speakers,
  s.session_date AS resolved_date,
  array_to_string(list_filter([CASE WHEN coalesce(n_utterances, 0) = 0 THEN 'no utterances' END,
    CASE WHEN coalesce(n_speakers, 0) < 2 THEN 'fewer than two speakers' END,
    CASE WHEN s.session_date IS NULL THEN 'no session date' END], lambda x: x IS NOT NULL), ', ') AS issues
FROM ses s LEFT JOIN uv USING (session_key)""").replace("\n, uv AS", ",\nuv AS"))
def transcript_validation(spark, sf_dir):
    """Sessions without utterances, with fewer than two speakers or without a date."""
    v = pg.validate_sessions(sessions(spark, sf_dir),
                             processed(spark, sf_dir, False).select("session_key", "speaker", "text"))
    return v.select("session_key", F.col("n_utterances").cast("bigint").alias("n_utterances"),
                    F.col("n_speakers").cast("bigint").alias("n_speakers"), "resolved_date",
                    F.array_join("issues", ", ").alias("issues"))


@register("alpha_tokens", f"""
SELECT conv_id AS session_key, turn AS dialogue_idx,
  array_to_string(list_filter(regexp_split_to_array(lower(text), '\\s+'),
    lambda w: regexp_full_match(w, '\\pL+') AND NOT list_contains({q.str_list(fx.STOPWORDS)}, w)), ' ') AS tokens_text
FROM conversations""")
def alpha_tokens(spark, sf_dir):
    """The minimal cleaning variant -- alphabetic lowercase tokens minus stop words."""
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("session_key"), F.col("turn").alias("dialogue_idx"),
                    F.array_join(tx.alpha_tokens("text", fx.STOPWORDS), " ").alias("tokens_text"))


from . import queries_scale  # noqa: E402,F401  (files over splits, prompt parts, report text, fits)
