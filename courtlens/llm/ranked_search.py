"""Ranked lexical search: every document ranked for each of a set of items, by bag deduplication.

Documents are restricted to the words of the items. Documents whose bags agree (equal counts of
all these words, and equal length norm ``m``) are one class: classes are found by a hash and told
apart by the bags themselves. A class is scored once against all items, as one product of matrices
for a batch of classes, and then expanded to its members by ascending identifier.

No more than ``top`` members of a class can be among the ``top`` documents of an item, so a class
carries its ``top`` least identifiers: copies in any number cost no more than that. They are chosen
in two steps, first among the rows of a share of the partitions, so that no task gets all copies of
one document. A task keeps, for each item, the best classes it has seen.

What travels to tasks is the items: their words and counts. The items are cut into blocks of about
BLOCK_TERMS different (item, word) pairs, and each block is one pass over the documents.

Defined results:

* A null or empty text has no terms: it counts for nothing and is never found; such an item has no rows.
* Documents that repeat, with or without equal texts, are documents of their own.
* An item is an (identifier, text) pair; rows that repeat in full are one item, and rows of one
  identifier with other texts are ranked apart.
* A document without identifier comes after all others of its score; a null item identifier is kept.
* No documents or no items: no rows. Columns other than identifier and text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlens.llm.common import chunks, column, discard, keyed, store, text_buffer
from courtlens.llm.shingles import ALNUM, LOWER
from courtlens.llm.text_runs import find_runs, run_strings

# Different (item, word) pairs that one pass over the documents answers.
BLOCK_TERMS = 500_000
# Cells of one dense matrix: (classes x words) or (words x items).
CELLS = 1 << 21
# Whole numbers below this are exact as doubles, whose products are faster.
EXACT = 1 << 53
# Shares of the partitions in which the members of a class are first chosen.
SHARES = 64

# The terms of the score.
SCALE, TF, NORM, FLAT, LENGTH = 1_000_000_000, 1000, 12, 75, 25


def term_strings(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased terms of texts in order, and the text of each."""
    starts, ends, texts = find_runs(ALNUM[data], offsets)
    return run_strings(LOWER[data], starts, ends), texts


def _item_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            terms, texts = term_strings(*text_buffer(part))
            rows = pa.table({"row": texts, "term": terms}).group_by(["row", "term"]).aggregate([([], "count_all")])
            rows = rows.sort_by([("row", "ascending"), ("term", "ascending")])
            counts = np.bincount(rows["row"].to_numpy(), minlength=part.num_rows)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.ListArray.from_arrays(ends, rows["term"].combine_chunks()),
                    pa.ListArray.from_arrays(ends, rows["count_all"].combine_chunks().cast(pa.int32())),
                ],
                ["_id", "terms", "counts"],
            )


def _vectors(vocabulary: pa.Array):
    """Tasks that give each document its number of terms and its bag over the vocabulary.

    A bag is (word, count) pairs of 32-bit integers by ascending word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                terms, texts = term_strings(*text_buffer(part))
                known = pc.index_in(terms, value_set=vocabulary)
                have = known.is_valid().to_numpy(zero_copy_only=False)
                words = known.fill_null(0).to_numpy(zero_copy_only=False)[have].astype(np.int64)
                cells, counts = np.unique(texts[have] * len(vocabulary) + words, return_counts=True)
                rows = cells // len(vocabulary)
                pairs = np.empty((len(cells), 2), "<i4")
                pairs[:, 0], pairs[:, 1] = cells % len(vocabulary), counts
                ends = np.zeros(part.num_rows + 1, np.int64)
                np.cumsum(8 * np.bincount(rows, minlength=part.num_rows), out=ends[1:])
                bags = pa.BinaryArray.from_buffers(
                    pa.binary(),
                    part.num_rows,
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(pairs.tobytes())],
                )
                n = pa.array(np.bincount(texts, minlength=part.num_rows).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("_id"), n, bags], ["_id", "n", "bag"])

    return run


def _pairs(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and count of every pair of an array of bags."""
    bags = bags.cast(pa.large_binary())
    offsets = np.frombuffer(bags.buffers()[1], np.int64)[bags.offset :][: len(bags) + 1]
    data = bags.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    pairs = whole[offsets[0] : offsets[-1]].view("<i4").reshape(-1, 2)
    rows = np.repeat(np.arange(len(bags)), np.diff(offsets) // 8)
    return rows, pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)


def _document_counts(size: int):
    """Tasks that count documents by word; word -1 stands for documents with terms, -2 for terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            total[:size] += np.bincount(_pairs(batch.column("bag"))[1], minlength=size)
            n = batch.column("n").to_numpy()
            total[size:] += [n.sum(), (n > 0).sum()]
        words = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(words < size, words, words - size - 2)), pa.array(total[words])], ["word", "n"]
        )

    return run


def _columns(items: np.ndarray, words: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Items in groups whose matrix (words x items) has about CELLS cells at most.

    Each group: its items, its words, and the matrix of counts.
    """
    groups, first, found = [], 0, set()
    bounds = np.flatnonzero(np.diff(items, prepend=-1, append=-1))
    for k in range(len(bounds) - 1):
        mine = set(words[bounds[k] : bounds[k + 1]].tolist())
        if found and len(found | mine) * (k + 1 - first) > CELLS:
            groups.append((bounds[first], bounds[k]))
            first, found = k, set()
        found |= mine
    if len(bounds) > 1:
        groups.append((bounds[first], bounds[-1]))
    out = []
    for start, stop in groups:
        own_items, i = np.unique(items[start:stop], return_inverse=True)
        own_words, w = np.unique(words[start:stop], return_inverse=True)
        matrix = np.zeros((len(own_words), len(own_items)))
        matrix[w, i] = counts[start:stop]
        out.append((own_items, own_words, matrix))
    return out


def _best_classes(weights: np.ndarray, items: np.ndarray, words: np.ndarray, counts: np.ndarray, top: int):
    """Tasks that score classes, arriving by ascending first member, and keep each item's best."""
    groups = _columns(items, words, counts)
    largest = max((m.sum(axis=0).max() for _, _, m in groups), default=0) * weights.max(initial=0) * (SCALE // TF)
    exact = largest < EXACT

    def score(bags: pa.Array, norms: np.ndarray):
        """Scores of the classes, item group by item group."""
        rows, terms, n = _pairs(bags)
        parts = weights[terms] * ((SCALE * n) // (TF * n + NORM * norms[rows]))
        for _, own, matrix in groups:
            at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
            mine = own[at] == terms
            dense = np.zeros((len(norms), len(own)), np.float64 if exact else np.int64)
            dense[rows[mine], at[mine]] = parts[mine]
            yield (dense @ (matrix if exact else matrix.astype(np.int64))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # For each group of items: scores (top x items) and the place of their members in ``kept``.
        best = [(np.zeros((0, len(g[0])), np.int64), np.zeros((0, len(g[0])), np.int64)) for g in groups]
        kept = None
        step = max(1, CELLS // max([1, *(len(g[1]) for g in groups), *(len(g[0]) for g in groups)]))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                members = part.column("members")
                base = len(kept) if kept is not None else 0
                kept = pa.concat_arrays([kept, members]) if base else pa.concat_arrays([members])
                fresh = np.arange(base, len(kept))[:, None]
                norms = part.column("m").to_numpy()
                for g, new in enumerate(score(part.column("bag"), norms)):
                    scores = np.concatenate([best[g][0], new])
                    places = np.concatenate([best[g][1], np.broadcast_to(fresh, new.shape)])
                    # Earlier classes have lesser first members, so a stable order breaks ties.
                    order = np.argsort(-scores, axis=0, kind="stable")[:top]
                    best[g] = (np.take_along_axis(scores, order, 0), np.take_along_axis(places, order, 0))
                used = np.unique(np.concatenate([b[1].ravel() for b in best]))
                kept = kept.take(pa.array(used))
                best = [(s, np.searchsorted(used, p)) for s, p in best]
        if kept is None:
            return
        for (own, _, _), (scores, places) in zip(groups, best, strict=True):
            live = scores > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.broadcast_to(own, scores.shape)[live]),
                    pa.array(scores[live]),
                    kept.take(pa.array(places[live])),
                ],
                ["_item", "score", "members"],
            )

    return run


def _rank_block(docs: DataFrame, bags: pa.Table, top: int) -> tuple[DataFrame, list[DataFrame]]:
    """(_item, score, _id, rank) for the items of one block, and the tables to delete afterwards."""
    sizes = pc.list_value_length(bags["terms"]).to_numpy()
    terms = pc.list_flatten(bags["terms"].combine_chunks())
    vocabulary = pc.unique(terms)
    items = np.repeat(bags["_item"].to_numpy(), sizes)
    words = pc.index_in(terms, value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.list_flatten(bags["counts"].combine_chunks()).to_numpy()

    kind = docs.schema["_id"].dataType.simpleString()
    vectors = store(
        docs.select("_id", "_text").mapInArrow(_vectors(vocabulary), f"_id {kind}, n bigint, bag binary"), "bags"
    )
    found = dict(
        vectors.mapInArrow(_document_counts(len(vocabulary)), "word bigint, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .to_pandas()
        .itertuples(index=False)
    )
    n_docs, n_terms = found.pop(-1, 0), found.pop(-2, 0)
    weights = np.zeros(len(vocabulary), np.int64)
    for word, df in found.items():
        weights[word] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    norm = F.expr(f"{FLAT} + ({LENGTH} * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = vectors.filter(F.length("bag") > 0).select(
        "_id", norm.alias("m"), "bag", (F.spark_partition_id() % SHARES).alias("share")
    )
    rows = rows.withColumn("code", F.xxhash64("bag", "m"))
    for keys in (["code", "m", "bag", "share"], ["code", "m", "bag"]):
        window = Window.partitionBy(*keys).orderBy(F.col("_id").asc_nulls_last())
        rows = rows.withColumn("place", F.row_number().over(window)).filter(F.col("place") <= top).drop("place")
    member = F.struct(F.col("_id").isNull().alias("no_id"), "_id")
    classes = rows.groupBy("code", "m", "bag").agg(F.sort_array(F.collect_list(member)).alias("members"))
    scored = (
        classes.select("m", "bag", "members")
        .sortWithinPartitions(F.col("members")[0])
        .mapInArrow(
            _best_classes(weights, items, words, counts, top),
            f"_item bigint, score bigint, members array<struct<no_id: boolean, _id: {kind}>>",
        )
        .select("_item", "score", F.explode("members").alias("member"))
    )
    order = Window.partitionBy("_item").orderBy(F.desc("score"), "member")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("_item", "score", F.col("member._id").alias("_doc"), "rank"), [vectors]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(_item_id, rank, _doc_id, score): each item's ``top`` documents of highest score above 0."""
    kind = items.schema[item_id].dataType.simpleString()
    texts = items.select(
        column(items, item_id).alias("_id"), F.coalesce(column(items, item_text), F.lit("")).alias("_text")
    )
    bags = store(
        texts.distinct()
        .mapInArrow(_item_bags, f"_id {kind}, terms array<string>, counts array<int>")
        .filter(F.size("terms") > 0)
        .withColumn("_item", F.monotonically_increasing_id()),
        "items",
    )
    total = bags.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    texts = keyed(docs, doc_id, doc_text)
    results, done = [], []
    for block in range(blocks):
        mine = bags.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block)
        ranked, tables = _rank_block(texts, mine.orderBy("_item").toArrow(), top)
        results.append(store(ranked, "ranked"))
        discard(*tables)
        done.append(results[-1])
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.join(bags.select("_item", F.col("_id").alias("_item_id")), "_item").select(
        "_item_id", F.col("rank").cast("int").alias("rank"), F.col("_doc").alias("_doc_id"), "score"
    )
