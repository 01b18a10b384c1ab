import zlib
from collections import Counter

from pyspark.sql import functions as F

from courtlens.llm import hash_tree
from courtlens.llm.queries import TREE


def test_rows(docs):
    got = hash_tree.shard_rows(docs, TREE, TREE.grown()).collect()
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
        for r in docs.select("doc_id", "text").collect()
    )
    assert Counter((r["_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in got if r["_id"] == 7}) == 1


def placed(spark, before, after, rows=20_000):
    keys = spark.range(rows).select(F.col("id").cast("string").alias("key"))
    both = hash_tree.place(hash_tree.place(keys, "key", before, "a"), "key", after, "b")
    return [(r["a"], r["b"]) for r in both.select("a", "b").collect()]


def test_weights_and_growth(spark):
    tree = hash_tree.Tree((((1.0, 3.0), (2.0,)), ((4.0, 0.5, 1.5),)))
    moves = placed(spark, tree, tree.grown(4.0))
    weights = [1.0, 3.0, 2.0, 4.0, 0.5, 1.5]
    counts = Counter(a for a, _ in moves)
    for shard, weight in enumerate(weights):
        assert abs(counts[shard] / len(moves) - weight / 12) < 0.015
    assert all(a == b or b == 6 for a, b in moves)
    assert abs(sum(b == 6 for _, b in moves) / len(moves) - 4 / 16) < 0.015


def test_a_changed_weight_moves_rows_of_its_own_subtrees_only(spark):
    before = hash_tree.Tree((((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0))))
    after = hash_tree.Tree((((2.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0))))
    moves = placed(spark, before, after)
    # Region 0 holds shards 0 to 3, its rack 0 shards 0 and 1.
    for a, b in moves:
        if a != b:
            assert b < 4
            if a in (2, 3):
                assert b in (0, 1)
            if a in (0, 1):
                assert b == 0


def test_slots_over_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(hash_tree, "BUCKET_ROWS", 300)
    docs = spark.range(5_000).select(
        (F.col("id") % 1_500).alias("doc_id"), F.lit("same").alias("text")
    )
    got = hash_tree.shard_rows(docs, TREE, TREE.grown()).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 5_000 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(no_docs):
    assert hash_tree.shard_rows(no_docs, TREE, TREE.grown()).collect() == []


def test_a_row_that_is_a_third_of_all(spark, monkeypatch):
    docs = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text")
    )
    got = hash_tree.shard_rows(docs, TREE, TREE.grown())
    hot = got.filter("_id = -5")
    assert hot.count() == 20_000 and hot.select("slot").distinct().count() == 20_000
    slots = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m"))
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in slots.collect())
