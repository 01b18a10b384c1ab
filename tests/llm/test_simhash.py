import random

import pytest
import xxhash
from pyspark.sql import functions as F

from courtlens.llm import simhash
from courtlens.llm.components import connected_components


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_groups(prints, distance):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def test_documents_against_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_groups(set(prints), 2)
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[roots[p]] = min(low.get(roots[p], i), i)
    want = sorted((str(i), p, low.get(roots[p])) for (i, _), p in zip(rows, prints))
    found = simhash.near_duplicates(docs).collect()
    got = sorted((str(r["_id"]), r["print"] % (1 << 64), r["component_id"]) for r in found)
    assert got == want
    near = {r["component_id"] for r in found if r["_id"] in range(50, 55)}
    assert 50 in near and len(near) < 5


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_lose_no_pair(spark, distance):
    rng = random.Random(distance)
    prints = set()
    for _ in range(40):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.add(p)
            # A walk: neighbours are near, the ends of the chain are not.
            for _ in range(rng.randint(1, distance + 1)):
                p ^= 1 << rng.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "print bigint")
    links = simhash.near_links(frame, distance)
    found = {r["vertex"] % (1 << 64): r["root"] % (1 << 64) for r in connected_components(links).collect()}
    want = slow_groups(prints, distance)

    def parts(roots):
        groups = {}
        for p in prints:
            groups.setdefault(roots.get(p, p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    assert parts(found) == parts(want)


def test_one_posting_list_with_all_its_members(spark):
    """65,536 fingerprints with six bytes in common are one list and one group."""
    frame = spark.range(1 << 16).select(F.col("id").alias("print"))
    roots = connected_components(simhash.near_links(frame)).agg(
        F.count(F.lit(1)), F.max("root")
    ).first()
    assert tuple(roots) == ((1 << 16) - 1, 0)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (3, 2)], "a bigint, b bigint")
    got = {r["vertex"]: r["root"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
