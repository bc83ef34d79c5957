"""WARC derivatives: response records to linked metadata and plain-text conversion records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import barrier

CRLF = "\r\n"
#: (pattern, replacement) from HTML to plain text, in this order; they mean the same in RE2
HTML_TO_TEXT = (
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?is)<head\b.*?</head\s*>", " "),
    (r"(?i)</?(p|div|li|h[1-6]|tr|br|article|section|ul|ol|table|header|footer|nav)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"),
    ("&middot;", "·"), ("&amp;", "&"),
    (r"[ \t\f\r]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^[ \n]+", ""),
    (r"[ \n]+$", ""),
)


def html_to_text(html: Column) -> Column:
    """Plain text of a page: no scripts, styles, head or tags, blocks on lines of their own."""
    out = html
    for pattern, to in HTML_TO_TEXT:
        out = F.regexp_replace(out, pattern, to)
    return out


def record_uuid(kind: str, *of: Column) -> Column:
    """A record id that a rerun gives again: an MD5 of the kind and its origin, written as a UUID."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(c.cast("string"), F.lit("")) for c in of]))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def sha1_label(body: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(F.encode(body, "UTF-8")))


def page_responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as response records: ``page_id, record_id, target_uri, block`` (HTTP head and body).

    A null page is an empty body; a null url stays null.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF + CRLF))
    return pages.select(F.col(page_id).alias("page_id"), record_uuid("response", F.col(page_id), F.col(url), body).alias("record_id"),
                        F.col(url).alias("target_uri"), F.concat(head, body).alias("block"))


def derive(responses: DataFrame, carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Two records per response, linked to it: ``metadata`` and ``conversion``.

    Columns: ``carry``, ``warc_type, record_id, refers_to, target_uri, source_digest`` (of the
    response's payload), ``source_headers`` (map of the HTTP head, names in lower case, the last of
    equal names), ``http_status, content_type, body, block_digest, content_length``.

    A block without an empty line is all head and has an empty payload; a null block counts as
    empty; null ids and addresses stay null; repeated rows give equal records; an empty table
    gives no rows; other columns are not read.
    """
    r = responses.select(*carry, F.col("record_id").alias("refers_to"), "target_uri",
                         F.coalesce("block", F.lit("")).alias("__b"))
    at = F.instr("__b", CRLF + CRLF)
    r = barrier(r, __head=F.when(at > 0, F.substring(F.col("__b"), F.lit(1), at - 1)).otherwise(F.col("__b")),
                __payload=F.when(at > 0, F.substring(F.col("__b"), at + 4, F.length("__b"))).otherwise(F.lit("")))
    r = r.drop("__b")
    lines = F.filter(F.split("__head", CRLF), lambda x: F.instr(x, ":") > 0)
    names = lambda x: F.lower(F.trim(F.substring_index(x, ":", 1)))
    r = barrier(r, __lines=lines, __text=html_to_text(F.col("__payload")), source_digest=sha1_label(F.col("__payload")),
                http_status=F.regexp_extract("__head", r"^HTTP/[0-9.]+ ([0-9]{3})", 1))
    r = barrier(r, __names=F.transform("__lines", names))
    pairs = F.filter(F.transform("__lines", lambda x, i: F.when(
        F.array_position(F.slice("__names", i + 2, 2 ** 31 - 1), names(x)) == 0,
        F.struct(names(x).alias("key"), F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value")))), lambda x: x.isNotNull())
    r = barrier(r, source_headers=F.map_from_entries(pairs))
    links = F.regexp_count("__payload", F.lit(r"(?i)<a\b[^>]*\bhref="))
    title = F.trim(F.regexp_extract("__payload", r"(?is)<title\b[^>]*>(.*?)</title", 1))
    lang = F.lower(F.regexp_extract("__payload", r"(?is)<html\b[^>]*\blang=[\"']?([a-zA-Z-]+)", 1))
    meta = F.to_json(F.struct(F.col("http_status").alias("status"), F.col("source_headers").alias("headers"),
                              title.alias("title"), lang.alias("lang"), links.alias("links"),
                              F.octet_length("__payload").alias("payload_length")))
    r = r.select(*carry, "refers_to", "target_uri", "source_digest", "source_headers", "http_status", F.explode(F.array(
        F.struct(F.lit("metadata").alias("t"), F.lit("application/json").alias("c"), meta.alias("b")),
        F.struct(F.lit("conversion").alias("t"), F.lit("text/plain").alias("c"), F.col("__text").alias("b")))).alias("__r"))
    r = r.select(*carry, "refers_to", "target_uri", "source_digest", "source_headers", "http_status",
                 F.col("__r.t").alias("warc_type"), F.col("__r.c").alias("content_type"), F.col("__r.b").alias("body"))
    return r.select(
        *carry, "warc_type",
        F.when(F.col("warc_type") == "metadata", record_uuid("metadata", F.col("refers_to")))
        .otherwise(record_uuid("conversion", F.col("refers_to"))).alias("record_id"),
        "refers_to", "target_uri", "source_digest", "source_headers", "http_status", "content_type", "body",
        sha1_label(F.col("body")).alias("block_digest"), F.octet_length("body").cast("long").alias("content_length"))


def warc_record(date: str) -> Column:
    """A derived record as it stands in a WARC file, without the two line ends after it, from the columns of ``derive``.

    Besides the fields of the format, ``X-Source-Payload-Digest``, ``X-Source-Status`` and one ``X-Source-Header`` for each
    header of the response go with both record types.  Line breaks in values become spaces, so no value can start a
    field; null values have no field.
    """
    one_line = lambda value: F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), one_line(value), F.lit(CRLF))) \
        .otherwise(F.lit(""))
    entries = F.sort_array(F.map_entries(F.coalesce("source_headers", F.create_map().cast("map<string,string>"))))
    headers = F.array_join(F.transform(entries, lambda e: F.concat(
        F.lit("X-Source-Header: "), one_line(e["key"]), F.lit(": "), one_line(e["value"]), F.lit(CRLF))), "")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.lit(date)), line("WARC-Block-Digest", F.col("block_digest")),
        line("X-Source-Payload-Digest", F.col("source_digest")),
        line("X-Source-Status", F.nullif(F.col("http_status"), F.lit(""))), headers,
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length")),
        F.lit(CRLF), F.col("body"))


def write_warc(records: DataFrame, path: str, date: str) -> None:
    """Write derived records as gzip files of WARC records, one set of files per record type.

    The writer's line separator is the two line ends that close a record, so the files hold nothing but records.  A file
    is one gzip member, as Spark writes it.
    """
    records.select("warc_type", warc_record(date).alias("value")).write.partitionBy("warc_type") \
        .option("compression", "gzip").option("lineSep", CRLF + CRLF).text(path)
