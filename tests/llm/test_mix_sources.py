import re
from collections import Counter

import pytest
from cases import prose
from pyspark.sql import functions as F

from courtlens.llm import common
from courtlens.llm.common import unfolded
from courtlens.llm.mix_sources import block_texts, mix_sources, permuted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Targets shared again and again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level >= cap * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, prose(i, 5 + i % 90), "abc"[i % 3]) for i in range(400)]
    rows += [(i, prose(i, 40), "hot") for i in range(400, 700)] + [(9, prose(9, 33), "hot")] * 300
    rows += [(800, prose(1, 3), "tiny"), (801, "one", "z"), (802, "", "none"), (803, None, "none"), (None, prose(4, 70), None), (None, prose(5, 70), None), (9, prose(10, 33), "hot"), (805, prose(66, 9000), "é")]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id bigint, text string, source string, _id string, size int, block int")
    return rows, table


@pytest.fixture(scope="module")
def mix(mixed):
    return mix_sources(mixed[1].repartition(5), block_words=16, shard_blocks=64)


def test_documents(mixed, mix):
    rows, _ = mixed
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    got = mix.documents.collect()
    assert sorted((str(r["_id"]), r["size"], str(r["_source"])) for r in got) == sorted(
        (str(i), len(WORD.findall(t or "")), str(s)) for i, t, s in rows
    )
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["_source"]] and r["target"] == pytest.approx(want[r["_source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["_source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 16
    capped = [s for s in want if sizes[s] and want[s] == 2 * sizes[s]]
    assert capped and all(taken[s] == want[s] for s in capped)


def test_counts_slots_and_shards(mix):
    slots = {r["source_number"]: r["slots"] for r in mix.sources.collect()}
    counts = mix.counts.groupBy("source_number").agg(F.sum("n").alias("n")).collect()
    assert {r["source_number"]: r["n"] for r in counts} == {s: n for s, n in slots.items() if n}
    full = [r["n"] for r in mix.counts.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()]
    assert set(full[:-1]) == {64} and sum(full) == sum(slots.values())
    # A draw, not a division: shards differ, and keep near the sources' shares.
    hot = mix.counts.filter(F.col("source_number") == max(slots, key=slots.get)).select("n").collect()
    assert len({r["n"] for r in hot}) > 1
    used = mix.spans.select("source_number", "slot", "block").distinct()
    assert used.count() == sum(slots.values())
    blocks = {r["source_number"]: r["blocks"] for r in mix.sources.collect()}
    for r in used.groupBy("source_number", "block").count().collect():
        n, b = slots[r["source_number"]], blocks[r["source_number"]]
        assert r["count"] in (n // b, n // b + 1)


def test_texts_of_blocks(mixed, mix):
    rows, table = mixed
    texts = block_texts(mix.spans, table).collect()
    full = [r for r in texts if len(r["text"].split()) == 16]
    assert len(full) > 0.9 * len(texts)
    streams = {}
    for i, t, s in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        streams.setdefault(s, []).append(t or "")
    whole = " ".join(" ".join(WORD.findall(" ".join(t))) for t in streams.values())
    single = [r["text"] for r in texts if r["source_number"] == 0]
    assert single and all(t in whole for t in single)


def test_the_layout_changes_nothing(mixed, mix):
    again = mix_sources(mixed[1].repartition(3), block_words=16, shard_blocks=64)
    key = lambda frame: sorted(map(str, frame.collect()))
    assert key(again.documents) == key(mix.documents)
    assert key(again.spans) == key(mix.spans)
    other = mix_sources(mixed[1], block_words=16, shard_blocks=64, seed=7)
    assert key(other.documents) != key(mix.documents)


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 1_000_003])
def test_permutations(spark, n):
    rows = spark.range(n).selectExpr("id", f"{n}L AS n", "id % 3 AS k").filter("k = 0 OR n < 1000000")
    rows = rows.withColumn("k", F.lit(5).cast("long"))
    at = permuted(rows, "at", "id", "n", "k", 42, "s")
    there = at.agg(F.countDistinct("at"), F.count("at"), F.min("at"), F.max("at")).first()
    assert there[0] == there[1] and there[2] >= 0 and there[3] < n
    if n == 1000:
        places = [r["at"] for r in at.orderBy("id").collect()]
        near = sum(abs(a - b) < 50 for a, b in zip(places, places[1:]))
        assert places != sorted(places) and near < 250


def test_unfolding_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(common, "PIECE", 7)
    rows = spark.createDataFrame([("a", 1), ("b", 7), ("c", 8), ("d", 50)], "k string, n bigint")
    got = Counter((r["k"], r["at"]) for r in unfolded(rows, "n", "at", 66).collect())
    assert got == Counter((k, i) for k, n in [("a", 1), ("b", 7), ("c", 8), ("d", 50)] for i in range(n))


def test_empty_and_without_words(spark, mixed):
    table = mixed[1]
    assert mix_sources(table.limit(0)).documents.collect() == []
    blank = mix_sources(table.withColumn("text", F.lit(" "))).documents
    assert blank.agg(F.sum("taken"), F.sum("size"), F.max("target")).first() == (0, 0, 0.0) and blank.count() == table.count()
