"""Archives: written and read back, chunk by chunk."""

import gzip
import hashlib
from functools import reduce

import pytest
from pyspark.errors import PythonException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.llm import warc

BIG = "<p>" + "größe " * 60_000
PAGES = [
    (5, "http://a/5", "<html>" + "x" * 200),
    (3, "http://a/3", "<html>" + "x" * 200),
    (9, "http://a/9", "<html>" + "x" * 200),
    (1, "http://a/1", "short"),
    (2, "http://a/2", "short"),
    (4, "http://a/\n4 5", None),
    (6, None, ""),
    (7, "http://a/7", BIG),
    (8, "http://a/8", BIG),
    (10, "http://a/10", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9),
    (11, "http://a/11", "é" * 50),
    (12, "http://a/12", "é" * 50),
    (11, "http://a/11", "é" * 50),
    (13, "http://a/13", "y" * 99),
    (14, "http://a/14", "y" * 99),
]


def table(spark, rows=PAGES):
    kind = "page_id long, url string, html string, digest string, size string, first string, payload string"
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], kind)


def brute(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == data]
        first = min(same) if len(data) >= 100 else key
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "response" if first == key else "revisit", None if first == key else first))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    return folder, warc.write_archives(table(spark), folder, chunk=1000)


def test_records_match_brute_force(spark, written):
    chunks = warc.read_archives(spark, written[1], chunk=777)
    got = [tuple(r) for r in warc.records(chunks).collect()]
    assert sorted(got, key=str) == brute(PAGES)


def test_chunks_are_small_and_carry_digests(spark, written):
    rows = warc.read_archives(spark, written[1], chunk=777).where("page = 7").orderBy("number").collect()
    assert len(rows) > 400
    data, seen = hashlib.sha256(), 0
    for number, row in enumerate(rows):
        data.update(row["data"])
        seen += len(row["data"])
        assert len(row["data"]) <= 777
        assert (row["number"], row["digest_so_far"], row["bytes_so_far"]) == (number, data.hexdigest(), seen)
        assert row["last"] == (number == len(rows) - 1)
    assert seen == len(BIG.encode())


def test_files_are_archives(written):
    texts = [gzip.open(r["path"].removeprefix("file:")).read() for r in written[1].collect()]
    assert sum(t.count(b"WARC-Type: response") for t in texts) + sum(t.count(b"WARC-Type: revisit") for t in texts) == len(PAGES)
    assert all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts)
    assert sum(r["records"] for r in written[1].collect()) == len(PAGES)


def test_a_damaged_payload_fails(spark, tmp_path):
    archives = warc.write_archives(table(spark, PAGES[:1]).coalesce(1), str(tmp_path), chunk=1000)
    path = archives.first()["path"]
    data = gzip.open(path).read().replace(b"xxxx", b"xxyx", 1)
    with gzip.open(path, "wb") as file:
        file.write(data)
    with pytest.raises(PythonException, match="differs"):
        warc.read_archives(spark, archives).select(F.max("number")).collect()


def test_empty_table_and_null_ids(spark):
    assert warc.records(warc.archive_pages(spark, table(spark, []))).count() == 0
    got = warc.records(warc.archive_pages(spark, table(spark, [(None, "u", "z" * 200), (4, "u", "z" * 200), (None, "u", "s")]))).collect()
    assert sorted((r["page"] or 0, r["record_type"], r["refers_to"]) for r in got) == [(0, "response", None), (0, "revisit", 4), (4, "response", None)]


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    """Adaptive execution must not join the short list of files in one task."""
    rows = [(i, f"http://a/{i}", f"page {i} " * 40) for i in range(5)]
    written = [warc.write_archives(table(spark, [r]), str(tmp_path / f"set{r[0]}")) for r in rows]
    archives = reduce(DataFrame.unionByName, written)
    files = archives.select("path").distinct().count()
    read = warc.read_archives(spark, archives)
    assert read.where("last").count() == 5
    assert read.select(F.spark_partition_id().alias("task")).distinct().count() == files == 5
