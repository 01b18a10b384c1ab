"""Removal of repeated word passages by suffix automata of reference shards.

A window is ``window`` consecutive words of one document, words lying between ASCII white space. A
word goes if it is covered by a window that also starts in a document with a smaller id; windows
are judged on the input.

The corpus is cut into reference shards by content: neighbouring windows with the same winnowed
fingerprint form one passage, and all passages with one fingerprint form one shard, so every copy
of a window lies in the same shard. Copies of a passage (known by 128 bits of hashes) are folded
to one row with the smallest id before anything is grouped; later copies go as a whole. In each
shard the distinct passages are streamed in the order of their ids through a suffix automaton of
those with smaller ids, and the matching statistics of at least ``window`` words mark what the
first copy itself repeats. Only the words of these first copies are ever moved.

An automaton of a fixed share of the corpus, sent to every task, would make all documents pass all
shares: work that grows with the square of the corpus. Here passages travel to their shard, only
those whose fingerprint occurs in two documents (a Bloom filter of at most 16 MB drops most others),
and a shard with more than SHARD_PASSAGES distinct passages is cut again, by whole windows, so that
no automaton grows with the corpus.

Defined cases: null and empty texts have no words; documents of fewer words than a window keep all;
equal ids are not smaller, so repeated rows with one id do not remove each other; a null id is
neither smaller nor larger, such rows keep all; other columns are ignored, whatever their names.
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
    carried_text,
    chunks,
    column,
    discard,
    keyed,
    mix,
    store,
    store_texts,
    text_buffer,
)
from courtlens.llm.shingles import SPACED, UNCHANGED, Words, find_words, run_hashes, winnow

WINDOW = 13
GRAM = 5
SHARD_PASSAGES = 500


class SuffixAutomaton:
    """All substrings of the sequences inserted so far."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token) -> int:
        """The state of exactly ``p``'s longest string and ``token``, cut from ``q`` if need be."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def insert(self, tokens: list) -> None:
        last = 0
        for token in tokens:
            if token in self.next[last]:
                last = self._split(last, self.next[last][token], token)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p != -1 and token not in self.next[p]:
                self.next[p][token] = new
                p = self.link[p]
            if p != -1:
                self.link[new] = self._split(p, self.next[p][token], token)
            last = new

    def matching_statistics(self, tokens: list) -> list[int]:
        """For each position, the length of the longest inserted substring that ends there."""
        state, length, out = 0, 0, []
        following, link, longest = self.next, self.link, self.length
        for token in tokens:
            while state and token not in following[state]:
                state = link[state]
                length = longest[state]
            if token in following[state]:
                state = following[state][token]
                length += 1
            out.append(length)
        return out


def repeated_windows(passages: list[tuple], window: int) -> list[list[tuple[int, int]]]:
    """For each (id, words): the runs (first, last) of windows that occur under a smaller id."""
    order = sorted(range(len(passages)), key=lambda i: passages[i][0])
    automaton, waiting, runs = SuffixAutomaton(), [], [[] for _ in passages]
    for i in order:
        if waiting and passages[waiting[-1]][0] < passages[i][0]:
            for j in waiting:
                automaton.insert(passages[j][1])
            waiting = []
        for end, length in enumerate(automaton.matching_statistics(passages[i][1])):
            start = end - window + 1
            if length >= window:
                if runs[i] and runs[i][-1][1] == start - 1:
                    runs[i][-1] = (runs[i][-1][0], start)
                else:
                    runs[i].append((start, start))
        waiting.append(i)
    return runs


# ---- tasks ------------------------------------------------------------------

# Fingerprints that a task gathers before it passes them on.
_GATHER = 4_000_000
# Salts of the two hashes that identify a run of words.
_CODE, _OTHER = 0x1D8E4E27C47D124F, 0x5851F42D4C957F2D


def _fingerprints(k: int, window: int):
    """Fingerprints: once for a task's only document that has it, twice for more documents."""

    def flush(prints: list, texts: list) -> pa.RecordBatch:
        code, text = np.concatenate(prints), np.concatenate(texts)
        order = np.lexsort((text, code))
        code, text = code[order], text[order]
        head = np.ones(len(code), bool)
        head[1:] = code[1:] != code[:-1]
        group = np.cumsum(head) - 1
        other = np.zeros(len(code), bool)
        other[1:] = ~head[1:] & (text[1:] != text[:-1])
        shared = np.zeros(int(head.sum()), bool)
        shared[group[other]] = True
        own = code[head]
        out = np.concatenate([own, own[shared]]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out)], ["print"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, texts, size, base = [], [], 0, 0
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), SPACED, UNCHANGED)
                found = winnow(words, k, window)
                new = np.ones(len(found.at), bool)
                new[1:] = found.at[1:] != found.at[:-1]
                prints.append(found.print[new])
                texts.append(words.texts[found.start[new]] + base)
                base += batch.num_rows
                size += len(prints[-1])
                if size >= _GATHER:
                    yield flush(prints, texts)
                    prints, texts, size = [], [], 0
        if size:
            yield flush(prints, texts)

    return run


def _cut(words: Words, k: int, window: int, held) -> tuple[np.ndarray, ...]:
    """Passages whose fingerprint the filter may hold: (fingerprint, first word, end)."""
    found = winnow(words, k, window)
    keep = bloom_has(held, found.print)
    start, code, at = found.start[keep], found.print[keep], found.at[keep]
    opens = np.ones(len(start), bool)
    opens[1:] = (at[1:] != at[:-1]) | (words.texts[start[1:]] != words.texts[start[:-1]])
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(start))[: len(heads)] - 1
    return code[heads], start[heads], start[tails] + window


def _placed(batch: pa.RecordBatch, words: Words, code, other, first, last) -> pa.RecordBatch:
    texts = words.texts[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(code.view(np.int64)),
            pa.array(other.view(np.int64)),
            batch.column("_id").take(pa.array(texts)),
            batch.column("_h").take(pa.array(texts)),
            pa.array((first - words.first[texts]).astype(np.int32)),
            pa.array((last - first).astype(np.int32)),
        ],
        ["shard", "code", "_id", "_h", "start", "words"],
    )


def _passages(k: int, window: int, repeated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), SPACED, UNCHANGED)
                shard, first, last = _cut(words, k, window, repeated.value)
                code = run_hashes(words, _CODE)(first, last)
                yield _placed(batch, words, shard, code, first, last)

    return run


def _single_windows(k: int, window: int, large):
    """The windows of large shards, each a shard of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), SPACED, UNCHANGED)
                found = winnow(words, k, window)
                first = found.start[bloom_has(large.value, found.print)]
                last = first + window
                code = run_hashes(words, _CODE)(first, last)
                shard = run_hashes(words, _OTHER)(first, last)
                yield _placed(batch, words, shard, code, first, last)

    return run


def _texts_of(k: int, window: int, repeated, wanted):
    """Words of the passages whose hash and document the second filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                words = find_words(*text_buffer(batch), SPACED, UNCHANGED)
                shard, first, last = _cut(words, k, window, repeated.value)
                code = run_hashes(words, _CODE)(first, last)
                owner = np.asarray(batch.column("_owner"), np.int64).view(np.uint64)
                key = mix(code ^ owner[words.texts[first]])
                keep = bloom_has(wanted.value, key)
                code, shard, first, last = code[keep], shard[keep], first[keep], last[keep]
                data = words.folded.tobytes() if len(first) else b""
                rows = [words.join(data, a, b - a) for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.view(np.int64)),
                        pa.array(code.view(np.int64)),
                        batch.column("_id").take(pa.array(words.texts[first])),
                        pa.array(rows, pa.binary()).cast(pa.string()),
                    ],
                    ["shard", "code", "low", "passage"],
                )

    return run


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of ``_texts_of`` for rows of (code, owner)."""
    for batch in batches:
        code, owner = (np.asarray(c, np.int64).view(np.uint64) for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array(mix(code ^ owner).view(np.int64))], ["key"])


def _resolve(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            shards, codes, runs = [], [], []
            for number, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = repeated_windows([(p["low"], p["passage"].split(" ")) for p in shard], window)
                for passage, run_list in zip(shard, found):
                    if run_list:
                        shards.append(number)
                        codes.append(passage["code"])
                        runs.append([{"a": a, "b": b + window} for a, b in run_list])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int64()), pa.array(codes, pa.int64()), pa.array(runs, kind)],
                ["shard", "code", "runs"],
            )

    return run


def _remove(text_in_row: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if text_in_row is not None:
                whole = carried_text(whole, "_row", text_in_row)
            for batch in chunks(whole):
                counts, removed, kept = [], [], []
                texts = batch.column("_text").cast(pa.binary()).to_pylist()
                for text, spans in zip(texts, batch.column("spans").to_pylist()):
                    words = text.split()
                    counts.append(len(words))
                    if spans:
                        # From the end, so that earlier positions stay valid.
                        for span in reversed(spans):
                            del words[span["a"] : span["b"]]
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words))
                passed = [n for n in batch.schema.names if n not in ("_text", "spans")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in passed],
                        pa.array(counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    [*passed, "n_words", "n_removed", "kept"],
                )

    return run


# ---- the operator -----------------------------------------------------------


def repeated_spans(
    source: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_passages: int = SHARD_PASSAGES
) -> DataFrame:
    """(_id, _h, spans): sorted disjoint word ranges [a, b) to remove, for rows that have any."""
    spark = source.sparkSession
    share = spark.sparkContext.broadcast
    kind = source.schema["_id"].dataType.simpleString()
    source = source.filter("_id IS NOT NULL")
    shared = store_texts(
        source.select("_text")
        .mapInArrow(_fingerprints(gram, window), "print bigint")
        .repartition("print")
        .groupBy("print")
        .count()
        .filter(F.col("count") > 1)
        .select("print"),
        "repeated_fingerprints",
    )
    repeated = share(bloom_filter(shared, bloom_bits(shared.count())))
    schema = f"shard bigint, code bigint, _id {kind}, _h bigint, start int, words int"
    copies = store_texts(source.mapInArrow(_passages(gram, window, repeated), schema), "passages")

    def fold(df: DataFrame) -> DataFrame:
        low, high = F.min("_id").alias("low"), F.max("_id").alias("high")
        return df.groupBy("shard", "code").agg(low, high)

    distinct = store(fold(copies), "distinct_passages")
    done = [shared, copies, distinct]
    large = store(
        distinct.groupBy("shard").count().filter(F.col("count") > shard_passages).select("shard"),
        "large_shards",
    )
    if not large.isEmpty():
        held = share(bloom_filter(large, bloom_bits(large.count())))
        cut = source.mapInArrow(_single_windows(gram, window, held), schema)
        copies = store_texts(
            copies.join(large, "shard", "left_anti").unionByName(cut), "passages_cut_again"
        )
        distinct = store(fold(copies), "distinct_passages_cut_again")
        done += [copies, distinct]
    # A shard of one distinct passage, or of one document, has nothing to match.
    several = distinct.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.min("low").alias("least"), F.max("low").alias("most")
    )
    several = several.filter("n > 1 AND least < most").select("shard")
    members = store(distinct.join(several, "shard").select("shard", "code", "low"), "members")
    keys = members.select("code", F.xxhash64("low").alias("owner")).mapInArrow(_mixed, "key bigint")
    wanted = share(bloom_filter(keys, bloom_bits(members.count())))
    texts = (
        source.withColumn("_owner", F.xxhash64("_id"))
        .mapInArrow(
            _texts_of(gram, window, repeated, wanted),
            f"shard bigint, code bigint, low {kind}, passage string",
        )
        .dropDuplicates(["shard", "code", "low"])
    )
    # At most shard_passages are listed.
    shards = (
        members.join(texts, ["shard", "code", "low"])
        .groupBy("shard")
        .agg(F.collect_list(F.struct("code", "low", "passage")).alias("passages"))
    )
    first_copies = shards.mapInArrow(
        _resolve(window), "shard bigint, code bigint, runs array<struct<a:int,b:int>>"
    )
    # Stored, so that the join below shuffles both of its sides and a passage of very many
    # documents can be split.
    todo = store_texts(
        distinct.join(first_copies, ["shard", "code"], "left").filter(
            "low < high OR runs IS NOT NULL"
        ),
        "passages_to_remove",
    )
    found = copies.join(todo, ["shard", "code"]).select(
        "_id",
        "_h",
        F.expr(
            """CASE WHEN _id > low THEN array(struct(start AS a, start + words AS b))
                    WHEN runs IS NOT NULL
                    THEN transform(runs, r -> struct(start + r.a AS a, start + r.b AS b)) END"""
        ).alias("part"),
    )
    # Ranges overlap by up to window - 1 words; they are merged into disjoint ones.
    merged = F.expr(
        """aggregate(parts, CAST(array() AS array<struct<a:int,b:int>>), (done, x) ->
             CASE WHEN size(done) > 0 AND element_at(done, -1).b >= x.a
                  THEN concat(slice(done, 1, size(done) - 1),
                       array(struct(element_at(done, -1).a AS a,
                                    greatest(element_at(done, -1).b, x.b) AS b)))
                  ELSE concat(done, array(x)) END)"""
    )
    spans = store(
        found.filter("part IS NOT NULL")
        .groupBy("_id", "_h")
        # Rows that repeat in full have equal parts, which one set holds once.
        .agg(F.array_sort(F.flatten(F.collect_set("part"))).alias("parts"))
        .select("_id", "_h", merged.alias("spans")),
        "spans",
    )
    del keys, several, texts, shards, first_copies, found
    discard(large, members, todo, *done)
    return spans


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_passages: int = SHARD_PASSAGES,
    carry: bool = False,
) -> DataFrame:
    """(_id, _h, n_words, n_removed, kept) per document; ``kept`` joins its words by one space.

    With ``carry`` the whole row comes along as the struct ``_row``.
    """
    source = keyed(docs, id_col, text_col)
    spans = repeated_spans(source, window, gram, shard_passages)
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _h bigint, "
    passed = ["doc._id", "doc._h"]
    left = source
    if not carry:
        passed.append("doc._text")
    else:
        row = F.struct(*[column(docs, c) for c in docs.columns]).alias("_row")
        given = F.coalesce(column(docs, text_col), F.lit(""))
        left = docs.select(column(docs, id_col).alias("_id"), F.xxhash64(given).alias("_h"), row)
        schema += f"_row {left.schema['_row'].dataType.simpleString()}, "
        passed.append("doc._row")
    left, right = left.alias("doc"), spans.alias("found")
    both = (F.col("doc._id") == F.col("found._id")) & (F.col("doc._h") == F.col("found._h"))
    return (
        left.join(right, both, "left")
        .select(*passed, "found.spans")
        .mapInArrow(_remove(text_col if carry else None), f"{schema}n_words bigint, n_removed bigint, kept string")
    )
