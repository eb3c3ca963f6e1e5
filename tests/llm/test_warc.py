"""Archives: round trips, revisits, rolling, repeatable bytes, damage and lost attempts."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from kontora.llm import warc
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def files(path):
    return {n: hashlib.sha256(open(f"{path}/{n}", "rb").read()).hexdigest() for n in os.listdir(path)}


def test_report_equals_sql(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    assert compare(warc.report(pages).drop("record_id"), connect(FOLDER), warc.SQL) == ""


def test_archives_repeat_and_roll(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    copies = pages.union(pages.limit(20).withColumn("page_id", F.col("page_id") + 1000)).cache()
    for k, rows in enumerate((copies, copies.repartition(7))):
        warc.write(rows, str(tmp_path / str(k)), shards=5, file_bytes=4000)
    one, two = files(tmp_path / "0"), files(tmp_path / "1")
    assert one == two and len(one) > 10 and not any(n.startswith(".") and not n.endswith(".crc") for n in one)
    assert all(os.path.getsize(tmp_path / "0" / n) <= 4000 or gzip.open(tmp_path / "0" / n).read().count(b"WARC/1.1") == 2 for n in one if n.startswith("pages"))
    got = warc.read(spark, str(tmp_path / "0")).collect()
    html = {r.page_id: r.html.encode() for r in copies.collect()}
    assert sorted(r.page_id for r in got) == sorted(html)
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == (len(html[r.page_id]), hashlib.sha1(html[r.page_id]).hexdigest())
        if r.record_type == "response":
            assert bytes(r.payload) == html[r.page_id]
        else:
            assert r.payload is None and html[r.refers_to] == html[r.page_id] and r.refers_to > r.page_id
    assert sum(r.record_type == "revisit" for r in got) >= sum(len(html[p]) >= 1000 for p in html if p >= 1000)
    with pytest.raises(Exception, match="manifest"):
        warc.write(copies, str(tmp_path / "0"))
    names = sorted(n for n in one if n.startswith("pages"))
    ids = [h for n in names for h in (int(x.split(b": ")[1]) for x in gzip.open(tmp_path / "0" / n).read().split(b"\r\n") if x.startswith(b"X-Page-ID"))]
    assert ids == sorted(html)  # sorted over all files


def test_uncommitted_and_damaged_files(spark, tmp_path):
    path = str(tmp_path / "a")
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * i) for i in range(50)], "page_id long, url string, html string")
    os.makedirs(path)
    open(f"{path}/.pages-000000-00000.warc.gz.lost", "wb").write(b"half")
    warc.write(pages, path, shards=2)
    assert warc.read(spark, path).count() == 50 and not any("lost" in n for n in os.listdir(path))
    open(f"{path}/pages-000009-00000.warc.gz", "wb").write(b"no manifest names it")
    assert warc.read(spark, path).count() == 50
    name = next(n for n in sorted(os.listdir(path)) if n.startswith("pages"))
    data = gzip.open(f"{path}/{name}").read()
    with gzip.open(f"{path}/{name}", "wb") as out:
        out.write(data.replace(b"xxxxx", b"xxyxx", 1))
    with pytest.raises(Exception, match="damaged|within a record"):
        warc.read(spark, path).count()


def test_odd_pages(spark):
    long, url = "é" * 600, "http://h/a b\r\nWARC-Type: x"
    rows = [(1, url, long, 0), (1, url, long, 1), (2, None, long, 0), (2, "u", long, 0), (None, "n", long, 0), (3, "s", "short", 0), (4, "t", "short", 0),
            (5, "e", None, 0), (6, "e", "", 0), (None, None, None, 0), (7, "w", "\r\n\r\n" * 400, 0), (8, "w", "\r\n\r\n" * 400, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.report(pages).collect()), key=str)
    assert got == sorted([
        (1, "revisit", 2, 1200), (1, "revisit", 2, 1200), (2, "response", None, 1200), (2, "response", None, 1200), (None, "revisit", 2, 1200),
        (3, "response", None, 5), (4, "response", None, 5), (5, "response", None, 0), (6, "response", None, 0), (None, "response", None, 0),
        (7, "revisit", 8, 1600), (8, "response", None, 1600),
    ], key=str)
    assert warc.report(pages.limit(0)).collect() == []


def test_a_row_that_repeats_is_split(spark, tmp_path):
    pages = spark.range(20000).select(F.lit(1).cast("long").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("y"), 1500).alias("html"))
    other = spark.range(3).select((F.col("id") + 5).alias("page_id"), F.lit("v").alias("url"), F.repeat(F.lit("y"), 1500).alias("html"))
    path = str(tmp_path / "a")
    warc.write(pages.union(other), path, shards=8)
    assert len([n for n in os.listdir(path) if n.startswith("pages")]) > 5
    got = {(r.record_type, r.refers_to): r.n for r in warc.read(spark, path, payload=False).groupBy("record_type", "refers_to").agg(F.count("*").alias("n")).collect()}
    assert got == {("revisit", 7): 20002, ("response", None): 1}
