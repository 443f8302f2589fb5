"""WARC derivatives: each response record becomes linked metadata and conversion records.

DataFrame functions only. Records are rows: one column per header the
derivatives need, ``source_headers`` for the response's own HTTP header block,
``content`` for the record block. ``warc_record`` writes a row as WARC text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import read

CAPTURE_DATE = "2024-01-01T00:00:00Z"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>"
BREAKS = (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|body|html|blockquote|pre)"
          r"\b[^>]*>")
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LANGUAGE = r"(?i)<html[^>]*\blang=\"([^\"]*)\""
LINK = r"(?i)<a\s[^>]*?href=\"([^\"]*)\""
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _uuid(text: Column) -> Column:
    """A record id that depends on ``text`` alone, so that reruns give the same ids."""
    h = F.md5(text.cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)), F.lit(">"))


def _digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def _plain(html: Column) -> Column:
    """Tag text without its entities, white space collapsed."""
    for entity, char in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(char))
    return html


def html_text(html: Column) -> Column:
    """Readable text of a page: scripts, styles, comments and the head go; block tags break lines."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    t = F.regexp_replace(t, BREAKS, "\n")
    t = _plain(F.regexp_replace(t, "<[^>]*>", ""))
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    return F.btrim(F.regexp_replace(t, " ?\n[ \n]*", "\n"), F.lit(" \n"))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
              date: str = CAPTURE_DATE) -> DataFrame:
    """Response records of a table of crawled pages (one per row)."""
    body = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(key),
        _uuid(F.concat_ws("|", F.lit("response"), F.coalesce(F.col(key).cast("string"), F.lit("")),
                          F.coalesce(F.col(url), F.lit("")))).alias("record_id"),
        F.col(url).alias("target_uri"), F.lit(date).alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).alias("source_headers"),
        _digest(body).alias("payload_digest"), body.alias("payload"))


def derivatives(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows per response record: its ``metadata`` and its ``conversion`` to plain text.

    ``records`` has ``key``, ``record_id``, ``target_uri``, ``warc_date``,
    ``source_headers``, ``payload_digest`` and ``payload``; other columns are not
    read. Both derivatives refer to the response's id, name each other in
    ``concurrent_to``, keep the response's URI, date, HTTP headers and payload
    digest, and carry the digest and length of their own block.

    A null or empty payload gives empty text and metadata without title or links;
    null URIs stay null. Repeated rows give repeated records (equal ids). An empty
    table gives no rows. One narrow pass: no shuffle, long pages are one row each.
    """
    meta_id = _uuid(F.concat(F.lit("metadata|"), F.col("record_id")))
    text_id = _uuid(F.concat(F.lit("conversion|"), F.col("record_id")))
    body = F.coalesce(F.col("payload"), F.lit(""))
    title = F.btrim(F.regexp_replace(_plain(F.regexp_extract(body, TITLE, 1)), r"[ \t\r\n\f]+", " "), F.lit(" "))
    fields = F.concat(
        F.lit("title: "), title,
        F.lit("\r\nlanguage: "), F.regexp_extract(body, LANGUAGE, 1),
        F.lit("\r\npayload-length: "), F.octet_length(body).cast("string"), F.lit("\r\n"),
        F.array_join(F.transform(F.regexp_extract_all(body, F.lit(LINK), F.lit(1)),
                                 lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""))
    pair = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), meta_id.alias("id"), text_id.alias("other"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("content")),
        F.struct(F.lit("conversion").alias("warc_type"), text_id.alias("id"), meta_id.alias("other"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), html_text(body).alias("content")))
    rows = records.select(key, F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "source_headers",
                          "payload_digest", F.explode(pair).alias("d"))
    return rows.select(
        key, "d.warc_type", F.col("d.id").alias("record_id"), "refers_to",
        F.col("d.other").alias("concurrent_to"), "target_uri", "warc_date", "d.content_type",
        F.octet_length("d.content").cast("long").alias("content_length"), _digest(F.col("d.content")).alias("block_digest"),
        F.col("payload_digest").alias("source_payload_digest"), "source_headers", "d.content")


def warc_record(rows: DataFrame) -> DataFrame:
    """The derivatives as WARC/1.1 text, one ``record`` per row (headers, block, two line ends).

    The response's status line and headers are ``WARC-Source-Header`` fields, one per
    line of its header block in their order, and ``WARC-Source-Payload-Digest`` is the
    digest of the payload that the block was made from. A null column gives no field.
    """
    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    lines = F.filter(F.split(F.coalesce(F.col("source_headers"), F.lit("")), r"\r?\n"), lambda x: x != "")
    source = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("WARC-Source-Header: "), x, F.lit("\r\n"))), "")
    text = F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", F.col("warc_type")), header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Date", F.col("warc_date")), header("WARC-Target-URI", F.col("target_uri")),
        header("WARC-Refers-To", F.col("refers_to")), header("WARC-Concurrent-To", F.col("concurrent_to")),
        header("WARC-Source-Payload-Digest", F.col("source_payload_digest")), source,
        header("WARC-Block-Digest", F.col("block_digest")), header("Content-Type", F.col("content_type")),
        header("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"), F.col("content"),
        F.lit("\r\n\r\n"))
    return rows.select("record_id", text.alias("record"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return derivatives(responses(read(spark, sf_dir, "pages")))


def _duck_plain(x: str) -> str:
    for entity, char in ENTITIES:
        x = "replace({}, '{}', '{}')".format(x, entity, char.replace("'", "''"))
    return x


def _duck_uuid(x: str) -> str:
    h = f"md5({x})"
    return (f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'")


_TEXT_SQL = _duck_plain(
    f"regexp_replace(regexp_replace(regexp_replace(body, '{HIDDEN}', ' ', 'g'), '{BREAKS}', chr(10), 'g'), "
    "'<[^>]*>', '', 'g')")
OP3_SQL = f"""
WITH r AS (
  SELECT page_id, coalesce(html, '') AS body, url AS target_uri,
         {_duck_uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '')")} AS refers_to
  FROM pages
), d AS (
  SELECT *, {_duck_uuid("'metadata|' || refers_to")} AS meta_id, {_duck_uuid("'conversion|' || refers_to")} AS text_id,
    'title: ' || trim(regexp_replace({_duck_plain(f"regexp_extract(body, '{TITLE}', 1)")}, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')
      || chr(13) || chr(10) || 'language: ' || regexp_extract(body, '{LANGUAGE}', 1)
      || chr(13) || chr(10) || 'payload-length: ' || strlen(body) || chr(13) || chr(10)
      || array_to_string(list_transform(regexp_extract_all(body, '{LINK}', 1),
                                        lambda x: 'outlink: ' || x || chr(13) || chr(10)), '') AS fields,
    trim(regexp_replace(regexp_replace({_TEXT_SQL}, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'),
         ' ' || chr(10)) AS plain
  FROM r
), both_rows AS (
  SELECT page_id, 'metadata' AS warc_type, meta_id AS record_id, refers_to, text_id AS concurrent_to, target_uri,
         'application/warc-fields' AS content_type, fields AS content, body FROM d
  UNION ALL
  SELECT page_id, 'conversion', text_id, refers_to, meta_id, target_uri, 'text/plain; charset=utf-8', plain, body FROM d
)
SELECT page_id, warc_type, record_id, refers_to, concurrent_to, target_uri, '{CAPTURE_DATE}' AS warc_date,
       content_type, strlen(content)::BIGINT AS content_length, 'sha256:' || sha256(content) AS block_digest,
       'sha256:' || sha256(body) AS source_payload_digest,
       'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(body) || chr(13) || chr(10) || chr(13) || chr(10) AS source_headers, content
FROM both_rows
"""
