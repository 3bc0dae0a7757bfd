"""A content-addressed WARC archive in two tables.

``headers`` keeps, for each record, the exact bytes before its payload (the WARC header block and
the HTTP header block) and the payload's digest; ``payloads`` keeps the bytes of each distinct
payload once, under its SHA-256 and length, whatever the number of records with it. Reading
joins the two and puts each record together again, byte by byte.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with the largest id is a
``response``; the others are ``revisit`` records that refer to it and have no payload of their
own. Smaller ones are all responses. Only digests, lengths and ids are grouped; the payload
bytes move once, to the join on read. A digest is verified: on writing, payloads that share a
strong digest but differ in length or SHA-1 raise an error; on reading, the bytes must have
the digests that the header states.

Nulls and empty pages have an empty payload. Of repeated rows with one id and payload, the first is
the response and the others revisit it under the same id; an id with different payloads makes a
record of each. A null id is smaller than any other, and is written as ``null``; a record that
revisits it refers to null. A null address is written as an empty one.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Equal payloads of fewer bytes are stored once as well, but their records are all responses.
MIN_REVISIT = 1000
CRLF = "\r\n"
END = b"\r\n\r\n"


def _record_id(page_id: Column, nth: Column) -> Column:
    """A name-based identifier of the record: the digest of its page id, place among repeats and payload."""
    h = F.sha1(F.concat_ws("|", F.lit("record"), F.coalesce(page_id.cast("string"), F.lit("null")),
                           nth.cast("string"), F.col("digest")))
    return F.concat(F.lit("<urn:sha1:"), h, F.lit(">"))


def _clean(url: Column) -> Column:
    """A header field is one line: control characters are percent-encoded, so nothing is lost."""
    out = F.replace(F.coalesce(url, F.lit("")), F.lit("%"), F.lit("%25"))
    for c in "\r\n":
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def records(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
            date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, header, digest, sha1, payload_bytes, stored): a WARC record for each row of
    ``pages`` without its payload; ``stored`` marks one row for each distinct payload."""
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), _clean(F.col(url)).alias("url"), body.alias("body"))
    base = base.select("page_id", "url", F.sha2("body", 256).alias("digest"), F.sha1("body").alias("sha1"),
                       F.octet_length("body").cast("long").alias("payload_bytes"))
    alike = base.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"),
                                       F.count_distinct("sha1", "payload_bytes").alias("kinds"))
    checked = F.when(F.col("kinds") > 1, F.raise_error(F.lit("payloads of one SHA-256 differ"))).otherwise(F.col("n"))
    # rows of one id and payload are told apart by their place; most ids occur once, so these groups are small
    place = Window.partitionBy("digest", "page_id").orderBy("url")
    rows = base.withColumn("nth", F.row_number().over(place)).join(alike.withColumn("n", checked), "digest")
    owner = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == 1)
    revisit = ~owner & (F.col("payload_bytes") >= MIN_REVISIT) & (F.col("n") > 1)
    rows = rows.withColumn("stored", owner).withColumn("revisit", revisit)
    http = F.concat_ws(CRLF, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                       F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")), F.lit(""), F.lit(""))
    rows = rows.withColumn("http", http)
    length = F.length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("payload_bytes"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    of_owner = _record_id(F.col("first_id"), F.lit(1))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("nth"))), field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")),
        field("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("null"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        field("X-Payload-SHA256", F.col("digest")),
        F.when(F.col("revisit"), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.when(F.col("revisit"), field("WARC-Refers-To", of_owner)),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", length.cast("string")), F.lit(""), F.lit(""))
    return rows.select("page_id", "nth", F.encode(F.concat(head, F.col("http")), "UTF-8").alias("header"), "digest", "sha1",
                       "payload_bytes", "stored")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes ``headers`` and ``payloads`` as Parquet under ``path`` (a shared folder)."""
    records(pages, id_col, url, html).select("header", "digest", "stored", "page_id", "nth").write.parquet(
        os.path.join(path, "headers"))
    headers = pages.sparkSession.read.parquet(os.path.join(path, "headers"))
    stored = headers.filter("stored").select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"))
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    bodies = pages.select(F.col(id_col).cast("long").alias("page_id"), body.alias("payload"))
    bodies = bodies.withColumn("digest", F.sha2("payload", 256))
    bodies = bodies.join(stored, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    if not headers.filter("nth > 1").isEmpty():  # repeated rows of one id and payload
        bodies = bodies.dropDuplicates(["digest"])
    bodies.select("digest", "payload").write.parquet(os.path.join(path, "payloads"))


def _header_field(name: str) -> Column:
    return F.regexp_extract(F.col("head"), f"(?m)^{name}: (.*?)\\r?$", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record, from the two tables: (page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload, record). The fields come from the header's text, ``record`` is the
    whole record as bytes, ``payload`` the full payload, of revisits that of the response. ``refers_to`` is the page of
    the response whose ``WARC-Record-ID`` the revisit's ``WARC-Refers-To`` names."""
    written = spark.read.parquet(os.path.join(path, "headers"))
    headers = written.select("header", F.col("digest").alias("_digest"))
    payloads = spark.read.parquet(os.path.join(path, "payloads")).select("digest", "payload")
    number = lambda text: F.when(text.isin("null", ""), None).otherwise(text.cast("long"))
    owners = written.filter("stored").select(F.col("digest").alias("_owned"), F.decode("header", "UTF-8").alias("head"))
    owners = owners.select("_owned", _header_field("WARC-Record-ID").alias("owner"), number(_header_field("X-Page-ID")).alias("owner_page"))
    rows = headers.join(payloads, headers["_digest"] == payloads["digest"], "left").join(owners, F.col("_digest") == F.col("_owned"), "left")
    rows = rows.withColumn("head", F.decode("header", "UTF-8"))
    kind = _header_field("WARC-Type")
    stated = F.regexp_extract(_header_field("WARC-Payload-Digest"), "^sha1:([0-9a-f]{40})$", 1)
    good = F.col("payload").isNotNull() & (F.sha1("payload") == stated) & (F.sha2("payload", 256) == _header_field("X-Payload-SHA256"))
    payload = F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("a payload does not have its record's digest")))
    own = F.when(kind == "response", payload).otherwise(F.lit(b""))
    referred = F.when(_header_field("WARC-Refers-To") == F.col("owner"), F.col("owner_page")).otherwise(
        F.raise_error(F.lit("a revisit names no response with its payload")))
    url = _header_field("WARC-Target-URI")
    for c in "\n\r%":
        url = F.replace(url, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return rows.select(
        number(_header_field("X-Page-ID")).alias("page_id"), url.alias("url"), kind.alias("record_type"),
        F.when(kind == "revisit", referred).alias("refers_to"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), stated.alias("payload_digest"), payload.alias("payload"),
        F.concat(F.col("header"), own, F.lit(END)).alias("record"))
