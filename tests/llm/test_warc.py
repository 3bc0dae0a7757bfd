"""The archive: round trip of whole records, one copy of each payload, and the query against SQL."""

import hashlib
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from diffloom.llm import catalog
from diffloom.llm.warc import read_archive, write_archive
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"
BIG, SMALL = "<p>é" + "x" * 1200, "tiny"
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, None, BIG), (3, "http://b", SMALL), (4, "http://b", SMALL),
        (5, "http://c", None), (6, "http://c", ""), (7, "u\r\nX-Page-ID: 99%", "line\r\nWARC-Type: revisit\r\n\r\n"), (None, "n", BIG),
        (8, "u", "\U0001F600" * 300), (10, "v", "z" * 3_000_000), (9, "again", BIG), (11, "u", "y" * 2000), (11, "u", "w" * 2000)]


def test_round_trip(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, digest string, payload int")
    write_archive(df.repartition(3), path)
    got = read_archive(spark, path).collect()
    assert len(got) == len(ROWS)
    assert sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in got), key=str) == \
        sorted(((i, u or "", h or "") for i, u, h in ROWS), key=str)
    for r in got:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        http, _, body = rest.partition(b"\r\n\r\n")
        fields = dict(re.findall(rb"(?m)^([\w-]+): (.*?)\r?$", head))
        own = b"" if r.record_type == "revisit" else bytes(r.payload)
        assert body == own + b"\r\n\r\n" and int(fields[b"Content-Length"]) == len(http) + 4 + len(own)
        assert r.payload_digest == hashlib.sha1(bytes(r.payload)).hexdigest() and r.payload_bytes == len(r.payload)
    named = [dict(re.findall(rb"(?m)^([\w-]+): (.*?)\r?$", bytes(r.record).partition(b"\r\n\r\n")[0])) for r in got]
    responses = {f[b"WARC-Record-ID"]: f[b"X-Page-ID"] for f in named if f[b"WARC-Type"] == b"response"}
    assert len({f[b"WARC-Record-ID"] for f in named}) == len(got)
    for r, f in zip(got, named):
        assert (b"WARC-Refers-To" in f) == (r.record_type == "revisit")
        assert r.record_type == "response" or responses[f[b"WARC-Refers-To"]] == str(r.refers_to).encode()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got if bytes(r.payload).decode() == BIG), key=str)
    assert kinds == sorted([(1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (9, "revisit", 9), (None, "revisit", 9)], key=str)
    assert all(r.record_type == "response" and r.refers_to is None for r in got if r.payload_bytes < 1000)
    stored = spark.read.parquet(path + "/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({h or "" for _, _, h in ROWS})


def test_damage_is_found(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    write_archive(spark.createDataFrame(ROWS[:4], "page_id long, url string, html string"), path)
    other = spark.read.parquet(path + "/payloads").withColumn("payload", F.lit(b"else"))
    other.write.parquet(path + "2/payloads")
    spark.read.parquet(path + "/headers").write.parquet(path + "2/headers")
    with pytest.raises(Exception, match="digest"):
        read_archive(spark, path + "2").select("payload").collect()


def test_empty(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archive(spark, path).count() == 0


def test_query_is_sql(spark):
    r = compare(catalog.queries()["op9_warc"](spark, SF), catalog.oracle_sql()["op9_warc"], duck(SF))
    assert r["cols_match"] and r["hash_match"], r
