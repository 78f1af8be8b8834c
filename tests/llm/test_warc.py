import base64
import hashlib

import pytest

from tables import TINY
from tidemark.llm import base, warc as q

SCHEMA = "page_id bigint, url string, html string, record_type int"


def expected(rows, least=0):
    best = {}
    for i, h in rows:
        k = h or ""
        best[k] = max([x for x in (best.get(k), i) if x is not None], default=None)
    out = []
    for i, h in rows:
        b, keeper = (h or "").encode(), best[h or ""]
        first = i == keeper or len(b) < least
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit",
                    None if first else keeper))
    return sorted(out, key=str)


def archived(spark, pages, least=0):
    path = base.scratch(spark, "warc")
    q.write_archive(pages, path, least)
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
           for r in q.read_archive(spark, path).collect()]
    return path, sorted(got, key=str)


def test_table_round_trip(spark):
    pages = base.table(spark, TINY, "pages")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    path, got = archived(spark, pages)
    assert got == expected(rows)
    html = dict(rows)
    for r in q.records(spark, path).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[:int(fields["Content-Length"])]
        assert rest[len(block):] == b"\r\n\r\n" and bytes(r["payload"]) == html[r["page_id"]].encode()
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        assert body == (b"" if fields["WARC-Type"] == "revisit" else bytes(r["payload"]))


@pytest.mark.parametrize("least", [0, 3])
def test_edges(spark, least):
    rows = [(1, None), (2, ""), (3, "ab"), (4, "ab"), (5, "same page"), (9, "same page"), (7, "same page"), (9, "same page"),
            (None, "same page"), (None, "alone"), (None, "alone"), (20, "é\r\n\r\nWARC-Type: x"), (21, "x" * 200_000), (-5, "x" * 200_000)]
    pages = spark.createDataFrame([(i, "http://a\r\nWARC-Type: revisit" if i == 20 else None, h, 1) for i, h in rows], SCHEMA)
    assert archived(spark, pages, least)[1] == expected(rows, least)


def test_payloads_are_stored_once_and_checked(spark):
    pages = spark.createDataFrame([(i, "u", "hot page", 0) for i in range(500)] + [(1000, "u", "other", 0)], SCHEMA)
    path, got = archived(spark, pages)
    assert spark.read.parquet(f"{path}/payloads").count() == 2 and sum(r[3] == "response" for r in got) == 2
    bad = base.scratch(spark, "warc")
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    stored = spark.read.parquet(f"{path}/payloads")
    stored.selectExpr("sha256", "encode(concat(decode(payload, 'UTF-8'), '!'), 'UTF-8') AS payload").write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="SHA-256"):
        q.read_archive(spark, bad).collect()
    assert archived(spark, pages.limit(0))[1] == []
