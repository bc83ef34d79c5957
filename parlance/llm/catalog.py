"""The corpus operators as registered queries over the driver's tables, with DuckDB SQL where it fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, golay, htmltext, langid, lines, mixing, periods, quality, toxicity, trie, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mixing(spark, sf_dir):
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def conversation_turns(spark, sf_dir):
    """All conversations and one whose texts are made of control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return turns.unionByName(extra)


def op2_chat_formatting(spark, sf_dir):
    turns = conversation_turns(spark, sf_dir).withColumn("parts", chat.text_parts(F.col("text")))
    f = chat.read_back(chat.format_conversations(turns))
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return f.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"),
                    F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "n_tokens")


def op3_simhash(spark, sf_dir):
    return golay.simhash_components(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_line_dedup(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op6_warc(spark, sf_dir):
    records = warc.derive(warc.page_responses(table(spark, sf_dir, "pages")))
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "http_status",
                          F.col("source_headers")["content-type"].alias("source_type"), "content_type", "block_digest",
                          "content_length")


def op7_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op8_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark, sf_dir):
    return quality.judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.text_model(docs.select(F.col("text").alias("__t"), F.col("lang").alias("__lang")))
    rows = langid.document_rows(docs).unionByName(langid.page_rows(table(spark, sf_dir, "pages")))
    return langid.identify(rows, model)


def op11_prefix_trie(spark, sf_dir):
    nodes, ends = trie.prefix_trie(*trie.rebuilt_turns(trie.ordered_turns(table(spark, sf_dir, "conversations"))))
    return trie.node_digests(nodes, ends)


def op12_periodic_runs(spark, sf_dir):
    runs = periods.periodic_runs(periods.with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    d = runs.select("doc_id", "runs", "collapsed", longest.alias("top"))
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), "top.length",
        (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_html_text(spark, sf_dir):
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_chat_formatting, op3_simhash, op4_toxicity, op5_line_dedup, op6_warc, op7_url_filter,
    op8_decontamination, op9_quality_rules, op10_language_id, op11_prefix_trie, op12_periodic_runs, op13_html_text)}

#: the oracle's html_to_text: the same rules nested as calls
_PLAIN = "body"
for _pattern, _to in warc.HTML_TO_TEXT:
    _to = "chr(10)" if _to == "\n" else "'" + _to.replace("'", "''") + "'"
    _PLAIN = "regexp_replace({}, '{}', {}, 'g')".format(_PLAIN, _pattern.replace("'", "''"), _to)


def _uuid(kind: str, *of: str) -> str:
    h = f"md5('{kind}'" + "".join(f" || chr(10) || coalesce({c}::VARCHAR, '')" for c in of) + ")"
    parts = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {parts} || '>'"


_STOPS = ", ".join("'" + v + "'" for v in sorted({v for w in quality.STOP_WORDS for v in (w, w.capitalize(), w.upper())}))
_RULES = " AND ".join(
    "NOT coalesce(" + " OR ".join([f"{m} < {r.low}"] * (r.low is not None) + [f"{m} > {r.high}"] * (r.high is not None)) + ", false)"
    for r in quality.RULES for m in [quality.METRICS[r.metric].replace("/ n_", "/ nullif(n_").replace(
        "n_words", "n_words, 0)").replace("n_lines", "n_lines, 0)") if "/" in quality.METRICS[r.metric] else quality.METRICS[r.metric]])

ORACLE = {
    "op6_warc": rf"""
        WITH p AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS body FROM pages),
        r AS (
            SELECT *, {_uuid("response", "page_id", "target_uri", "body")} AS refers_to, 'sha1:' || sha1(body) AS source_digest,
                   strlen(body) AS bytes, {_PLAIN} AS plain,
                   trim(regexp_extract(body, '(?is)<title\b[^>]*>(.*?)</title', 1)) AS title,
                   lower(regexp_extract(body, '(?is)<html\b[^>]*\blang=["'']?([a-zA-Z-]+)', 1)) AS lang,
                   len(regexp_extract_all(body, '(?i)<a\b[^>]*\bhref=')) AS links FROM p),
        d AS (
            SELECT *, 'metadata' AS warc_type, 'application/json' AS content_type, '{{"status":"200","headers":{{'
                   || '"content-type":"text/html; charset=utf-8","content-length":"' || bytes || '"}},"title":' || to_json(title)
                   || ',"lang":' || to_json(lang) || ',"links":' || links || ',"payload_length":' || bytes || '}}' AS made FROM r
            UNION ALL SELECT *, 'conversion', 'text/plain', plain FROM r)
        SELECT page_id, warc_type, CASE warc_type WHEN 'metadata' THEN {_uuid("metadata", "refers_to")}
                   ELSE {_uuid("conversion", "refers_to")} END AS record_id, refers_to, target_uri, source_digest,
               '200' AS http_status, 'text/html; charset=utf-8' AS source_type, content_type, 'sha1:' || sha1(made) AS block_digest,
               strlen(made)::BIGINT AS content_length FROM d""",
    "op9_quality_rules": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS l
            FROM documents),
        i AS (SELECT rid, w, unnest(range(1, len(w) - 6)) AS pos FROM d WHERE len(w) >= 8),
        x AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, array_to_string(w[pos:pos + 7], ' ')) AS n FROM i),
        v AS (SELECT rid, count(DISTINCT pos + k) AS n FROM x, (SELECT unnest(range(0, 8)) AS k) WHERE n > 1 GROUP BY rid),
        m AS (
            SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[ 	-]', '', 'g')) AS word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words, len(l) AS n_lines,
                   len(list_filter(w, lambda x: list_contains([{_STOPS}], x))) AS n_stop_words,
                   len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]\s'))) AS n_bullet_lines,
                   len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines
            FROM d LEFT JOIN v USING (rid)),
        f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND {_RULES} AS kept FROM f""",
    "op2_chat_formatting": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS body,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(12 + 7 + 11 + length(role) + length(text)
                       + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS chars,
                   sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words
            FROM t GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(body) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               chars::BIGINT AS formatted_chars, words::BIGINT AS n_tokens FROM g""",
    # the tables' pages hold their main text in one article; named references are those that occur in them
    "op13_html_text": r"""
        WITH a AS (
            SELECT page_id, url, regexp_replace(regexp_extract(
                coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '\s+', ' ', 'g') AS x FROM pages),
        b AS (SELECT page_id, url, regexp_replace(regexp_replace(
                x, '</?(p|h1)>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS x FROM a),
        c AS (SELECT page_id, url, replace(regexp_replace(x, '&amp;?', '&', 'g'), '&quot;', '"') AS x FROM b),
        d AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(x, chr(10)),
                lambda l: trim(regexp_replace(l, '\s+', ' ', 'g'))), lambda l: l <> ''), chr(10)) AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM d""",
    # crc32 bit by bit; prefixes are the texts themselves, subtree sums join every node to all its ancestors
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r
            FROM conversations WHERE conv_id IS NOT NULL),
        v AS (
            SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(
                list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda k, z: xor(k >> 1, 3988292384::BIGINT * (k & 1)))), 4294967295::BIGINT) % 6 AS h
            FROM (SELECT DISTINCT c FROM t)),
        s AS (
            SELECT v.c, t.r, t.role, t.text FROM v JOIN t ON t.c = v.c - v.c % 100 AND t.r < v.h
            UNION ALL SELECT v.c, t.r, t.role, t.text FROM v JOIN t ON t.c = v.c AND t.r >= v.h),
        p AS (
            SELECT c, row_number() OVER w AS depth, length(text) AS chars,
                   string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS path
            FROM s WINDOW w AS (PARTITION BY c ORDER BY r)
            UNION ALL SELECT c, 0, 0, '' FROM v),
        n AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM p GROUP BY ALL),
        m AS (SELECT p.c, p.depth, n.conv_id FROM p JOIN n USING (depth, path)),
        u AS (
            SELECT n.conv_id, n.depth, n.n_convs, n.chars, b.conv_id AS parent_conv_id
            FROM n LEFT JOIN m AS b ON b.c = n.conv_id AND b.depth = n.depth - 1),
        k AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM u
              WHERE depth > 0 GROUP BY ALL),
        x AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (conv_id, depth)),
        sums AS (
            SELECT a.conv_id, a.depth, sum((x.n_children = 0)::INT) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
            FROM x JOIN m AS a ON a.c = x.conv_id AND a.depth <= x.depth GROUP BY ALL),
        e AS (
            SELECT m.conv_id, m.depth, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids
            FROM m JOIN (SELECT c, max(depth) AS depth FROM p GROUP BY c) AS l USING (c, depth) GROUP BY ALL)
        SELECT x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, n_leaves::BIGINT AS n_leaves,
               saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM x JOIN sums USING (conv_id, depth) LEFT JOIN e USING (conv_id, depth)""",
}
