"""Document fingerprints of Lempel-Ziv phrases.

A text is parsed from left to right into phrases, each the shortest run of characters not yet in
its dictionary (LZ78). What two documents share makes them share phrases, so the overlap of the
phrase sets behaves like compressing one given the other. Each phrase is hashed while it is
parsed, and SLOTS salted minima of the hashes, 16 bits kept of each, make the fingerprint; the
share of equal slots estimates the overlap.

Parsing is online, so a text edited at its end shares the parse of what it keeps: the dictionary
at the cut is copied and only the new end is parsed.

Defined cases: null texts are empty; an empty text has no phrases and the fingerprint of all ones,
and is like another empty text only; an edited text is as long as the text unless the next is
shorter than the replaced half; rows are ordered by id, null ids first, equal ids by text; the row
after the last is the first, also for a single row; equal texts have equal fingerprints; other
columns are ignored; an empty table has an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import column, mix

SLOTS = 128
# Rows of one range of ids, and the most ranges; each range is one streamed task.
RANGE_ROWS = 10_000
MAX_RANGES = 20_000
SAMPLE = 16

# Of the phrase hash: odd, and above all code points, so short phrases never collide.
MULTIPLIER = (1 << 21) + 17
_MASK = (1 << 60) - 1
_BLOCK = 1 << 14


def parse(text: str, phrases: set[int], open_phrase: int = 0) -> int:
    """Add the phrases of ``text`` to ``phrases``; returns the hash of the unfinished phrase."""
    h, add = open_phrase, phrases.add
    for code in map(ord, text):
        h = h * MULTIPLIER + code + 1 & _MASK
        if h not in phrases:
            add(h)
            h = 0
    return h


_rng = np.random.default_rng(7)
_SALT = _rng.integers(0, 1 << 32, SLOTS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, SLOTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(phrases) -> np.ndarray:
    """The least salted hash of each slot; all ones for no phrases."""
    out = np.full(SLOTS, 0xFFFFFFFF, np.uint32)
    hashes = np.fromiter(phrases, np.uint64, len(phrases))
    folded = (mix(hashes) >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(folded), _BLOCK):
        x = (folded[start : start + _BLOCK, None] ^ _SALT) * _ODD
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def signature(least: np.ndarray) -> str:
    # The low bits: the high ones of a minimum are mostly zero.
    return (least & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal slots; two empty texts are alike, an empty and another are not."""
    empty = "f" * (4 * SLOTS)
    if a == empty or b == empty:
        return float(a == b)
    x = np.frombuffer(bytes.fromhex(a), ">u2")
    return float((x == np.frombuffer(bytes.fromhex(b), ">u2")).mean())


def fingerprint(text: str) -> str:
    phrases: set[int] = set()
    parse(text, phrases)
    return signature(minima(phrases))


def with_edit(text: str, following: str) -> tuple[str, str, str]:
    """Edited text, and the fingerprints of text and edited text."""
    half = len(text) // 2
    kept, replaced, new = text[: len(text) - half], text[len(text) - half :], following[:half]
    shared: set[int] = set()
    open_phrase = parse(kept, shared)
    base = minima(shared)
    prints = []
    for end in (replaced, new):
        phrases = shared.copy()
        parse(end, phrases, open_phrase)
        prints.append(signature(np.minimum(base, minima(phrases - shared))))
    return kept + new, prints[0], prints[1]


_SCHEMA = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order; each range ends with the row that follows it, marked as a copy."""
    names = ["_id", *[f.split()[0] for f in _SCHEMA.split(", ")]]
    kinds, held, rows = None, None, []

    def finish(print_of_next: str) -> None:
        row = held["row"]
        rows.append((*row, likeness(row[3], row[4]), likeness(row[3], print_of_next)))

    def flush() -> pa.RecordBatch:
        arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    waiting = None  # (id, text) whose next text is not known yet
    for batch in batches:
        kinds = kinds or [
            batch.schema.field("_id").type,
            pa.int64(),
            *[pa.string()] * 3,
            pa.float64(),
            pa.float64(),
        ]
        for i in range(batch.num_rows):
            key, text = batch.column("_id")[i], batch.column("_text")[i].as_py()
            where, copy = batch.column("_range")[i].as_py(), batch.column("_copy")[i].as_py()
            if waiting is not None and waiting[0] == where:
                edited, mine, changed = with_edit(waiting[2], text)
                if held is not None:
                    finish(mine)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                held = {"row": (waiting[1].as_py(), len(waiting[2]), digest, mine, changed)}
                if copy:
                    finish(fingerprint(text))
                    held = None
            waiting = None if copy else (where, key, text)
        if rows:
            yield flush()


def fingerprint_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Per document: length, edited text's digest, both fingerprints, likeness to it and the next.

    Texts are shuffled once, to ranges of ids. Ranges begin at ids that exist, so the row that
    follows a range is known to be the next range's first and is sent to both.
    """
    rows = docs.select(
        column(docs, id_col).alias("_id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("_text"),
    )
    ids = rows.select("_id")
    total, least = ids.agg(F.count(F.lit(1)), F.min("_id")).first()
    wanted = min(max(1, total // range_rows), MAX_RANGES)
    sample = (
        ids.filter("_id IS NOT NULL").distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE * wanted)
    )
    known = sorted(r["_id"] for r in sample.collect())
    bounds = sorted({known[len(known) * i // wanted] for i in range(1, wanted)}) if known else []
    bounds = [b for b in bounds if b != least]
    n = len(bounds) + 1

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        found = np.zeros(len(values), np.int32)
        present = values.notna().to_numpy()
        if bounds:
            found[present] = np.searchsorted(bounds, values[present].to_numpy(), "right")
        return pd.Series(found)

    placed = rows.withColumn("_range", range_of("_id")).withColumn("_copy", F.lit(False))
    # The first row of each range also closes the range before; the very first closes the last.
    nulls = ids.filter("_id IS NULL").limit(1).count() > 0
    starts = [*bounds, *([] if nulls or least is None else [least])]
    opens = F.col("_id").isin(starts) if starts else F.lit(False)
    if nulls:
        opens = F.col("_id").isNull() | opens
    copies = (
        placed.filter(opens)
        .withColumn("_range", F.pmod(F.col("_range") - 1, F.lit(n)))
        .withColumn("_copy", F.lit(True))
    )
    dealt = placed.unionByName(copies).repartitionById(n, F.col("_range"))
    order = ["_range", "_copy", "_id", "_text"]
    kind = rows.schema["_id"].dataType.simpleString()
    return dealt.sortWithinPartitions(*order).mapInArrow(_stream, f"_id {kind}, {_SCHEMA}")
