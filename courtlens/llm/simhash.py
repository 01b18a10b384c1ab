"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has 64 bits in 8 positional bytes. Two fingerprints that differ in at most d bits
share at least 8 - d positional bytes; that is the guaranteed minimum of matches. A posting of the
index is a set of 8 - d positions with their bytes, so that the shared bytes of a pair are tallied
by the posting itself: whatever meets in a posting list has reached the minimum, and every pair
that reaches it meets in some list. (Lists of single bytes would each hold 1/256 of the corpus.)
The members of a list still differ in d bytes at most; their pairs are verified by looking up, for
every member, the fingerprints at most d bits away, so no list is ever expanded into pairs.

* Documents with equal fingerprints are folded before indexing, so a list has at most 256^d
  members (65,536 for d = 2) however many copies there are.
* Links leave a list as a spanning forest of it; groups are the connected components of all.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer words
than a shingle give one shingle of all words; repeated rows share a fingerprint; null ids take
part, and a group's id is its smallest non-null id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import keyed, store, store_texts
from courtlens.llm.components import connected_components

SHINGLE = 3
DISTANCE = 2
SEED = 42

# Hashes whose bits are counted in one step.
_BLOCK = 1 << 15


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; A-Z lower-cased, words between ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[min(shingle, len(ends)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a : b - 1], SEED) for a, b in zip(starts, last)), np.uint64, len(last)
    )


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half the shingle hashes."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        octets = hashes[start : start + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(_id, _h, print): print is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            prints = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_h"),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                ],
                ["_id", "_h", "print"],
            )

    source = keyed(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, _h bigint, print bigint")


def _roots(codes: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """For sorted distinct codes, the index of the least one reachable by steps of one mask."""
    parent = np.arange(len(codes)).tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for mask in masks:
        other = codes ^ mask
        at = np.minimum(np.searchsorted(codes, other), len(codes) - 1)
        linked = np.flatnonzero((codes[at] == other) & (at > np.arange(len(codes))))
        for i, j in zip(linked.tolist(), at[linked].tolist()):
            i, j = root(i), root(j)
            parent[max(i, j)] = min(i, j)
    return np.array([root(i) for i in range(len(codes))], np.int64)


def _links_of_lists(positions: list[tuple[int, ...]], distance: int):
    """Verified links inside posting lists, as (fingerprint, least fingerprint of its part)."""
    bits = 8 * distance
    masks = [
        sum(1 << b for b in chosen)
        for d in range(1, distance + 1)
        for chosen in combinations(range(bits), d)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            ends = np.asarray(lists.offsets, np.int64)
            members = np.asarray(lists.flatten(), np.int64).view(np.uint64)
            ends = ends - ends[0]
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            # The bytes that the posting leaves free, and above them the number of the list.
            free = np.array(
                [[p for p in range(8) if p not in kept] for kept in positions], np.uint64
            ).reshape(len(positions), distance)
            of = free[np.asarray(batch.column("kept"), np.int64)][row]
            codes = np.zeros(len(members), np.uint64)
            for i in range(distance):
                octet = (members >> (np.uint64(8) * of[:, i])) & np.uint64(255)
                codes |= octet << np.uint64(8 * i)
            codes |= row.astype(np.uint64) << np.uint64(bits)
            order = np.argsort(codes)
            roots = _roots(codes[order], np.array(masks, np.uint64))
            linked = np.flatnonzero(roots != np.arange(len(roots)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(members[order][linked].view(np.int64)),
                    pa.array(members[order][roots[linked]].view(np.int64)),
                ],
                ["a", "b"],
            )

    return run


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join all of the distinct ``print`` values at most ``distance`` bits apart."""
    if not 1 <= distance <= 3:
        raise ValueError("distance must be 1, 2 or 3")
    positions = list(combinations(range(8), 8 - distance))

    def signed(kept: tuple[int, ...]) -> int:
        mask = sum(0xFF << (8 * p) for p in kept)
        return mask - (1 << 64) if mask >> 63 else mask

    postings = prints.select(
        "print",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).cast("int").alias("kept"),
                        F.col("print").bitwiseAND(F.lit(signed(p))).alias("octets"),
                    )
                    for i, p in enumerate(positions)
                ]
            )
        ).alias("posting"),
    )
    lists = (
        postings.groupBy("posting.kept", "posting.octets")
        .agg(F.collect_list("print").alias("members"))
        .filter(F.size("members") > 1)
        .select("kept", "members")
    )
    return lists.mapInArrow(_links_of_lists(positions, distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """(_id, _h, print, component_id) per document; component_id is the smallest id of its group."""
    prints = store_texts(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = store(prints.groupBy("print").agg(F.min("_id").alias("low")), "distinct")
    groups = connected_components(near_links(distinct, distance))
    rooted = distinct.join(groups, distinct["print"] == groups["vertex"], "left").select(
        "print", "low", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return prints.join(named, "print").select("_id", "_h", "print", "component_id")
