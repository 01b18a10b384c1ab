import hashlib
import os
import shutil

import pytest
from pyspark.sql import functions as F

from courtlens.llm import warc

HTML = "<p>" + "body " * 40
ROWS = [
    (5, "http://a/5", HTML), (3, "http://a/3", HTML), (9, "http://a/9\r\nX: y", HTML), (4, None, None),
    (6, "http://a/6", "short"), (7, "http://a/7", "short"), (8, "", ""), (10, "http://a/ü", "é" * 80),
    (11, "u", "é" * 80), (None, "n", HTML), (None, "n", "only null ids " * 20), (12, "t", "twice " * 30),
    (12, "t", "twice " * 30), (13, "x", "\r\n\r\nWARC/1.1\r\n" * 20), (14, "big", "long text " * 60_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "x", "x") for r in ROWS]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string, digest string")


def files(folder):
    return {n: open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder) if n.endswith(".warc.gz")}


def test_round_trip_and_revisits(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_warc(pages, folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS)
    got = {}
    for r in warc.read_warc(spark, folder).collect():
        got.setdefault(r["page"], []).append(r)
    first = {}
    for i, _, html in sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0]):
        payload = (html or "").encode()
        r = got[str(i)].pop(0)
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        assert r["payload_bytes"] == len(payload)
        if len(payload) >= 100 and payload in first:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", str(first[payload]), None)
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, payload)
            first.setdefault(payload, i)
    nulls = {(r["record_type"], r["refers_to"]) for r in got[None]}
    assert nulls == {("revisit", "3"), ("response", None)}
    urls = {r["url"] for r in warc.read_warc(spark, folder).collect()}
    assert "http://a/9%0D%0AX:%20y" in urls and "http://a/ü" in urls


def test_equal_files_whatever_the_partitions(pages, tmp_path):
    many = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 100))
    out = []
    for n in (1, 7):
        folder = f"{tmp_path}/w{n}"
        warc.write_warc(many.repartition(n), folder, shard_bytes=200_000, roll_bytes=1_000)
        out.append(files(folder))
    assert out[0] == out[1] and len(out[0]) > 5
    # Files roll by compressed size and sort by id across files.
    ids = []
    for name in sorted(out[0]):
        for member in warc.members(out[0][name]):
            headers, _ = warc.parse_record(member)
            ids += [int(headers["X-Page-ID"])] if "X-Page-ID" in headers else []
    assert ids == sorted(ids)


def test_unfinished_folders_are_not_read(spark, pages, tmp_path):
    folder = f"{tmp_path}/w"
    warc.write_warc(pages, folder)
    os.rename(f"{folder}/_manifest", f"{tmp_path}/elsewhere")
    with pytest.raises(Exception):
        warc.read_warc(spark, folder).collect()


def test_damage_is_noticed(spark, pages, tmp_path):
    folder = f"{tmp_path}/w"
    warc.write_warc(pages, folder)
    name, data = next(iter(files(folder).items()))
    record = next(r for r in warc.members(data) if b"WARC-Type: response" in r and b"body" in r)
    warc.parse_record(record)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"body", b"bodY"))
    with pytest.raises(ValueError):
        list(warc.members(data[:-20]))


def test_empty(spark, pages, tmp_path):
    folder = f"{tmp_path}/w"
    warc.write_warc(pages.limit(0), folder)
    assert warc.read_warc(spark, folder).collect() == []


@pytest.fixture(scope="module")
def archive(pages, tmp_path_factory):
    folder = tmp_path_factory.mktemp("archive")
    warc.write_warc(pages, f"{folder}/w", shard_bytes=200_000, roll_bytes=1_000)
    return f"{folder}/w"


def changed(archive, tmp_path, change):
    copy = shutil.copytree(archive, f"{tmp_path}/w")
    change(copy, sorted(files(copy))[1])
    return copy


@pytest.mark.parametrize(
    "change",
    [
        lambda folder, name: os.rename(f"{folder}/{name}", f"{folder}/../elsewhere"),
        lambda folder, name: shutil.copy(f"{folder}/{name}", f"{folder}/part-99999-00000.warc.gz"),
        lambda folder, name: os.truncate(f"{folder}/{name}", os.path.getsize(f"{folder}/{name}") - 7),
        lambda folder, name: open(f"{folder}/{name}", "ab").write(b"more"),
    ],
    ids=["missing", "stray", "shortened", "lengthened"],
)
def test_files_that_differ_from_the_manifest(spark, archive, tmp_path, change):
    folder = changed(archive, tmp_path, change)
    with pytest.raises(ValueError, match="manifest"):
        warc.read_warc(spark, folder).collect()


def test_a_file_replaced_by_one_of_equal_size(spark, archive, tmp_path):
    def swap(folder, name):
        size = os.path.getsize(f"{folder}/{name}")
        open(f"{folder}/{name}", "wb").write(b"\0" * size)

    folder = changed(archive, tmp_path, swap)
    with pytest.raises(Exception):
        warc.read_warc(spark, folder).collect()


@pytest.mark.parametrize("hot", ["7", "NULL"])
def test_an_id_with_a_third_of_all_pages_is_cut(spark, tmp_path, hot):
    rows = spark.range(3000).selectExpr(
        f"IF(id % 3 = 0, {hot}, id + 10000) AS page_id", "'u' AS url", "repeat(sha2(CAST(id AS STRING), 256), 20) AS html"
    )
    folder = f"{tmp_path}/w"
    manifest = warc.write_warc(rows, folder, shard_bytes=320_000)
    sizes = manifest.groupBy(F.substring("name", 6, 5)).agg(F.sum("records").alias("n")).collect()
    assert len(sizes) == 12 and max(r["n"] for r in sizes) < 2 * 250
    assert warc.read_warc(spark, folder).count() == 3000
