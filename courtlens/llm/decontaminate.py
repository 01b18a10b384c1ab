"""Benchmark decontamination by winnowing.

Words are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased. Every run of ``window`` words shared by a document and an item contains a window of
k-grams, both sides keep the least hash of that window, so both keep a common fingerprint: a join
on fingerprints misses nothing. Hits are then extended to the windows around the fingerprint, and
the join compares the words themselves, so no chance hit is left.

* A first pass reads each text once and keeps the windows whose fingerprint and whose words pass
  Bloom filters of the items' (at most 16 MB each); the rest of the text stays where it is.
* The join key is the window; items are folded by window first, so an item that occurs in a third
  of all documents is one row on its side, and adaptive execution splits the other.

Defined cases: null and empty texts have no words and are never contaminated; an item of fewer
words than a window, but not none, is one window; null item ids mark words but name no item;
repeated documents get one row each, repeated items count once; an empty table of items leaves
every document clean; other columns are ignored, whatever their names. Texts count as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import (
    bloom_bits,
    bloom_filter,
    bloom_has,
    chunks,
    column,
    keyed,
    store,
    store_texts,
    text_buffer,
)
from courtlens.llm.shingles import ALNUM, LOWER, find_words, grams, winnow

WINDOW = 10
GRAM = 5

_SPANS = "array<struct<start:int,words:int,print:bigint,text:string>>"


def _windows_of_items(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), ALNUM, LOWER)
                data = words.folded.tobytes()
                found = winnow(words, k, window)
                rows = [
                    (words.texts[s], window, p, words.join(data, s, window))
                    for s, p in zip(found.start.tolist(), found.print.tolist())
                ]
                for text in np.flatnonzero((words.counts > 0) & (words.counts < window)).tolist():
                    n, first = int(words.counts[text]), int(words.first[text])
                    code = int(grams(words, n)[0][first])
                    rows.append((text, n, code, words.join(data, first, n)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64)),
                        pa.array([r[3].decode() for r in rows], pa.string()),
                    ],
                    ["_id", "words", "print", "text"],
                )

    return run


def _candidate_windows(k: int, window: int, lengths: list[int], prints, texts):
    """For each document: its words, and windows that may occur in an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fingerprints, contents = prints.value, texts.value
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), ALNUM, LOWER)
                found = winnow(words, k, window)
                spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                groups = []
                keep = np.flatnonzero(bloom_has(fingerprints, found.print))
                start, code = found.start[keep], found.print[keep]
                groups.append((window, start, code))
                for n in lengths:
                    code, valid = grams(words, n)
                    keep = np.flatnonzero(valid)[bloom_has(fingerprints, code[valid])]
                    groups.append((n, keep, code[keep]))
                data = words.folded.tobytes() if any(len(g[1]) for g in groups) else b""
                for n, start, code in groups:
                    if not len(start):
                        continue
                    # The second filter looks at all words of the window.
                    keep = bloom_has(contents, grams(words, n)[0][start])
                    for s, c in zip(start[keep].tolist(), code[keep].view(np.int64).tolist()):
                        text = int(words.texts[s])
                        spans[text].append(
                            {
                                "start": s - int(words.first[text]),
                                "words": n,
                                "print": c,
                                "text": words.join(data, s, n).decode(),
                            }
                        )
                kind = pa.list_(
                    pa.struct(
                        [
                            ("start", pa.int32()),
                            ("words", pa.int32()),
                            ("print", pa.int64()),
                            ("text", pa.string()),
                        ]
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        batch.column("_h"),
                        pa.array(words.counts, pa.int64()),
                        pa.array(spans, kind),
                    ],
                    ["_id", "_h", "n_words", "spans"],
                )

    return run


def _content_codes(k_window: DataFrame) -> DataFrame:
    """The hash of all words of each window, as ``grams`` computes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                words = find_words(*text_buffer(batch, "text"), ALNUM, LOWER)
                out = np.zeros(batch.num_rows, np.uint64)
                for n in np.unique(words.counts[words.counts > 0]).tolist():
                    rows = np.flatnonzero(words.counts == n)
                    out[rows] = grams(words, n)[0][words.first[rows]]
                yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["code"])

    return k_window.select("text").mapInArrow(run, "code bigint")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document: (_id, _h, n_words, n_hit, items, spans).

    ``n_hit`` counts words inside any occurrence of an item's window, ``items`` are the sorted ids
    of items with occurring windows, ``spans`` the maximal hit spans (start, end) in words.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    spark = docs.sparkSession
    kind = items.select(column(items, item_col)).schema[0].dataType.simpleString()
    tests = store_texts(
        keyed(items, item_col, text_col).mapInArrow(
            _windows_of_items(gram, window), f"_id {kind}, words int, print bigint, text string"
        ),
        "item_windows",
    )
    # One row per window, with the items that have it.
    tests = store(
        tests.groupBy("words", "print", "text").agg(
            F.collect_set(F.col("_id").cast("string")).alias("items")
        ),
        "distinct_item_windows",
    )
    bits = bloom_bits(tests.count())
    prints = bloom_filter(tests.select("print"), bits)
    texts = bloom_filter(_content_codes(tests), bits)
    # At most window - 1 lengths.
    lengths = [
        r["words"] for r in tests.filter(F.col("words") < window).select("words").distinct().collect()
    ]
    share = spark.sparkContext.broadcast
    source = keyed(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()
    read = store_texts(
        source.mapInArrow(
            _candidate_windows(gram, window, sorted(lengths), share(prints), share(texts)),
            f"_id {kind}, _h bigint, n_words bigint, spans {_SPANS}",
        ),
        "candidate_windows",
    )
    # Repeated documents look up their windows once.
    wanted = (
        read.filter(F.size("spans") > 0)
        .dropDuplicates(["_id", "_h"])
        .select("_id", "_h", F.explode("spans").alias("s"))
        .select("_id", "_h", "s.*")
    )
    hits = (
        wanted.join(tests, ["words", "print", "text"])
        .groupBy("_id", "_h")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", (F.col("start") + F.col("words")).alias("end")))
            ).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    )
    # Overlapping and touching windows grow into maximal spans.
    merged = F.expr(
        """aggregate(hits, CAST(array() AS array<struct<start:int,end:int>>), (done, x) ->
             CASE WHEN size(done) > 0 AND element_at(done, -1).end >= x.start
                  THEN concat(slice(done, 1, size(done) - 1),
                       array(struct(element_at(done, -1).start AS start,
                                    greatest(element_at(done, -1).end, x.end) AS end)))
                  ELSE concat(done, array(x)) END)"""
    )
    hits = hits.select("_id", "_h", "items", merged.alias("spans"))
    n_hit = F.expr("aggregate(hit.spans, 0L, (n, x) -> n + x.end - x.start)")
    left, right = read.drop("spans").alias("doc"), hits.alias("hit")
    both = F.col("doc._id").eqNullSafe(F.col("hit._id")) & (F.col("doc._h") == F.col("hit._h"))
    return left.join(right, both, "left").select(
        "doc._id",
        "doc._h",
        "doc.n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("hit.items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hit.spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )
