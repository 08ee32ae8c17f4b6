import base64
import hashlib
import re

import pytest

from quarrysight.llm import warc_store as S

PAGES = "page_id long, url string, html string, key string, payload string, copy long"


def test_archive(spark, workdir):
    rows = [(1, "http://a/", "same"), (5, "http://b/", "same"), (3, "http://c/", "same"), (4, None, None), (6, "http://d/", ""),
            (7, "u\r\nWARC-Type: revisit", "é" * 20000), (8, "x", "lone"), (8, "x", "lone"), (8, "x", "lone"), (None, "n", "null id")]
    df = spark.createDataFrame([(*r, "k", "p", 9) for r in rows], PAGES)
    S.write_archive(df, workdir + "/w")
    got = S.read_archive(spark, workdir + "/w").collect()
    assert len(got) == len(rows)
    assert spark.read.parquet(workdir + "/w/payloads").count() == len({r[2] or "" for r in rows})
    for r in got:
        payload = bytes(r.payload)
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        record = bytes(r.record)
        head, _, rest = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest == (payload if r.record_type == "response" else b"") + b"\r\n\r\n" and n == len(rest) - 4
    kind = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert {(5, "response", None), (1, "revisit", 5), (3, "revisit", 5), (6, "response", None), (4, "revisit", 6),
            (7, "response", None), (None, "response", None)} <= kind
    lone = [r.record_type for r in got if r.page_id == 8]
    assert sorted(lone) == ["response", "revisit", "revisit"]
    ids = [re.search(rb"WARC-Record-ID: (\S+)", bytes(r.header))[1] for r in got]
    assert len(set(ids)) == len(ids)


def test_short_payloads_are_responses(spark, workdir):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")],
                               "page_id long, url string, html string")
    S.write_archive(df, workdir + "/w", least_revisit_bytes=5)
    got = {r.page_id: r.record_type for r in S.read_archive(spark, workdir + "/w").collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_a_damaged_payload_is_found(spark, workdir):
    df = spark.createDataFrame([(1, "a", "xy")], "page_id long, url string, html string")
    S.write_archive(df, workdir + "/w")
    bad = spark.read.parquet(workdir + "/w/payloads").selectExpr("key", "cast('xz' as binary) as payload")
    rows = bad.collect()
    spark.createDataFrame(rows, bad.schema).write.mode("overwrite").parquet(workdir + "/w/payloads")
    with pytest.raises(Exception, match="does not match"):
        S.read_archive(spark, workdir + "/w").select("payload_bytes").collect()


def test_empty(spark, workdir):
    S.write_archive(spark.createDataFrame([], PAGES), workdir + "/w")
    assert S.read_archive(spark, workdir + "/w").count() == 0
