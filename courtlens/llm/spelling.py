"""Spelling variants: words grouped with the frequent words one edit away, by variable-length grams.

Words are runs of letters, counted over all texts. Two words are near if one inserted, deleted or
replaced code point makes one of the other. Near words are found in five steps:

1. Gram dictionary. Grams of MIN_GRAM to MAX_GRAM code points are counted over all words, each
   between an opening and a closing mark. A gram of more than ``frequent`` occurrences is extended
   by the next code point; the others stay as they are. Only the frequent grams are kept, and the
   threshold grows with the words so that there are at most MAX_GRAM * DICTIONARY of them.
2. Decomposition. From every place of a word runs one gram: as short as the dictionary lets it be.
   A gram depends on its own code points alone. (Dropping grams inside longer ones, as is often
   done, would let an edit affect grams that do not hold it; five letters would leave no bound.)
3. Bound. An edit affects the grams that hold its place, so a word's bound is the largest number of
   its grams over one place. Near words share all other grams: their count is at least the word's
   grams less its bound, for either word. As no gram is longer than the shortest word, that is 1 or more.
4. Merging. The rarest bound + 1 grams of a word enter the lists, with the word's length and the
   gram's place: an edit moves a gram by no more than one, and only if the lengths differ. Two near
   words meet in a list. For the words that meet, all grams are counted, and those that reach both
   bounds stay.
5. Verification by the code points.

A list is shuffled by its key and merged in arrays, block by block; only near words leave the task.
Lists above a size are cut into parts, and every pair of parts is a list of its own.

A word's form is its near word of largest count, if that has at least ``ratio`` times the word's.
Forms lead to ever more frequent words, so they end; roots are found by doubling the way.

Defined results: null and empty texts have no words; the identifier only enters the checksum that
deletes a code point (null: as an empty string); rows that repeat count again; ties go to the
smallest word in code-point order; empty tables have no rows. Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import chunks, column, discard, mix, store, text_buffer
from courtlens.llm.shingles import LOWER
from courtlens.llm.text_runs import find_runs, run_strings

MIN_GRAM, MAX_GRAM = 2, 5
# A gram is extended if it occurs more than ``frequent`` times: FREQUENT, or one in DICTIONARY.
FREQUENT, DICTIONARY = 100, 100_000
# Words that a task counts before it hands its counts on, and pairs that one pass compares.
TASK_WORDS, PAIRS = 1 << 18, 1 << 17
# A list is cut into parts of at most this many bytes of words, and words.
PART_BYTES, PART_WORDS = 1 << 21, 4096

# The polynomial of CRC-32, and the marks around a word.
_POLYNOMIAL = 0xEDB88320
_OPEN, _CLOSE = 1, 2


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of every run, continued from the checksum of what comes before it."""
    table = _crc_table()
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    live, k = np.flatnonzero(ends > starts), 0
    while len(live):
        state[live] = table[(state[live] ^ data[starts[live] + k]) & 0xFF] ^ (state[live] >> np.uint32(8))
        k += 1
        live = live[ends[live] - starts[live] > k]
    return state ^ np.uint32(0xFFFFFFFF)


def text_words(ids: list[str], data: np.ndarray, offsets: np.ndarray, delete_every: int, least: int) -> pa.Array:
    """Words of at least ``least`` code points, after deletions.

    Letters are A-Z, a-z and U+00C0 to U+00FF, which in UTF-8 are C3 and the byte after it.
    """
    data = LOWER[data]
    lead = data == 0xC3
    mask = ((data >= 97) & (data <= 122)) | lead
    mask[1:] |= lead[:-1]
    starts, ends, texts = find_runs(mask, offsets)
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    sums = run_checksums(data, starts, ends, before[texts])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = points[ends] - points[starts]
    cut = (sums % np.uint32(delete_every) == 0) if delete_every else np.zeros(len(starts), bool)
    whole = (lengths >= least) & ~cut
    words = [run_strings(data, starts[whole], ends[whole])]
    changed = []
    for i in np.flatnonzero(cut & (lengths > least)).tolist():
        word = data[starts[i] : ends[i]].tobytes().decode()
        at = int(sums[i]) % len(word)
        changed.append(word[:at] + word[at + 1 :])
    return pa.concat_arrays([*words, pa.array(changed, pa.string())])


def _counted(delete_every: int, least: int):
    """Tasks that count words; what they hold is bounded, so one word may leave a task more than once."""

    def merged(tables: list[pa.Table]) -> pa.Table:
        total = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        return total.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            done = 0
            for part in chunks(batch):
                mine = ids[done : done + part.num_rows]
                done += part.num_rows
                counts = pc.value_counts(text_words(mine, *text_buffer(part), delete_every, least))
                held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                rows += len(counts)
                if rows > TASK_WORDS:
                    total = merged(held)
                    if total.num_rows > TASK_WORDS // 2:
                        yield from total.to_batches()
                        held, rows = [], 0
                    else:
                        held, rows = [total], total.num_rows
        if held:
            yield from merged(held).to_batches()

    return run


def count_words(
    docs: DataFrame, delete_every: int = 97, least: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n): words of at least ``least`` code points and their occurrences.

    ``delete_every``: a run loses a code point if this divides its checksum; 0 deletes none.
    """
    rows = docs.select(
        F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("_id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("_text"),
    )
    counted = rows.mapInArrow(_counted(delete_every, least), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# ---- grams ------------------------------------------------------------------


def _marked(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a code point: all words between marks, and where each word begins."""
    coded = [bytes([_OPEN]) + w.encode("latin-1") + bytes([_CLOSE]) for w in words.to_pylist()]
    starts = np.zeros(len(coded) + 1, np.int64)
    np.cumsum([len(c) for c in coded], out=starts[1:])
    return np.frombuffer(b"".join(coded), np.uint8), starts


def _gram_codes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where grams begin, what is left of the word there, and codes of grams by length.

    A gram's code is its bytes as one number, so codes of different grams differ.
    """
    lengths = np.diff(starts)
    left = np.repeat(starts[1:], lengths) - np.arange(len(data))
    at = np.flatnonzero(left >= MIN_GRAM)
    padded = np.concatenate([data, np.zeros(MAX_GRAM, np.uint8)]).astype(np.int64)
    codes = np.zeros((MAX_GRAM + 1, len(at)), np.int64)
    for k in range(MAX_GRAM):
        codes[k + 1] = (codes[k] << 8) | padded[at + k]
    return at, left[at], codes


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, left, codes = _gram_codes(*_marked(batch.column("word")))
        every = np.concatenate([codes[k][left >= k] for k in range(MIN_GRAM, MAX_GRAM + 1)])
        grams, counts = np.unique(every, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], ["gram", "n"])


def gram_dictionary(words: DataFrame, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the grams that occur more than ``frequent`` times, ascending, and their counts."""
    grams = words.select("word").mapInArrow(_gram_counts, "gram bigint, n bigint")
    kept = grams.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > frequent).toArrow()
    codes, counts = kept["gram"].to_numpy(), kept["n"].to_numpy()
    order = np.argsort(codes)
    return codes[order], counts[order]


def decompose(data: np.ndarray, starts: np.ndarray, grams: np.ndarray, counts: np.ndarray):
    """Word, place in it, code, length and count (0: not frequent) of the gram from every place."""
    at, left, codes = _gram_codes(data, starts)
    length = np.full(len(at), MIN_GRAM)
    count = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for k in range(MIN_GRAM, MAX_GRAM + 1):
        mine = codes[k][open_]
        if len(grams):
            found = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
            often = grams[found] == mine
            count[open_] = np.where(often, counts[found], 0)
        else:
            often = np.zeros(len(mine), bool)
        open_ = open_[often & (left[open_] > k)]
        if k < MAX_GRAM:
            length[open_] = k + 1
    word = np.searchsorted(starts, at, "right") - 1
    return word, at - starts[word], codes[length, np.arange(len(at))], length, count


def affected(word: np.ndarray, place: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per word, the most grams that one edit can affect: those over one place."""
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    edges = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(edges, starts[word] + place, 1)
    np.add.at(edges, starts[word] + place + length, -1)
    over = np.cumsum(edges)
    return np.maximum.reduceat(over, starts[:-1]) if len(sizes) else np.zeros(0, np.int64)


def _postings(grams: np.ndarray, counts: np.ndarray):
    """Tasks that give the lists of each word: key, length of the shorter word, whether it is the longer.

    Words of equal length share a gram's place; from the shorter to the longer word it may move by
    one, so a word is entered for partners of its length or longer once, and twice for shorter ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = _marked(batch.column("word"))
            sizes = np.diff(starts)
            word, place, code, length, count = decompose(data, starts, grams, counts)
            bound = affected(word, place, length, sizes)
            order = np.lexsort((mix(code.astype(np.uint64)), count, word))
            first = np.searchsorted(word, np.arange(len(sizes)))
            rank = np.arange(len(order)) - first[word[order]]
            order = order[rank <= bound[word[order]]]
            word, place, code = word[order], place[order], code[order].astype(np.uint64)
            size = sizes[word] - 2
            rows = []
            for longer, shift in ((0, 0), (1, 0), (1, -1)):
                least, at = size - longer, place + shift
                key = mix(mix(code) + (least.astype(np.uint64) << np.uint64(32)) + at.astype(np.uint64))
                rows.append((key, least, np.full(len(word), bool(longer)), word))
            key, least, longer, word = (np.concatenate(x) for x in zip(*rows, strict=True))
            # No word is shorter than a gram may be.
            key, least, longer, word = (x[least >= MAX_GRAM] for x in (key, least, longer, word))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(least.astype(np.int32)),
                    pa.array(longer),
                    batch.column("word").take(pa.array(word)),
                    batch.column("n").take(pa.array(word)),
                ],
                ["key", "least", "longer", "word", "n"],
            )

    return run


# ---- merging ----------------------------------------------------------------


def _near(grams: np.ndarray, counts: np.ndarray):
    """Tasks that merge lists, which arrive by length and key, and give the near words."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        """Near words among whole lists."""
        lists = np.flatnonzero(
            np.diff(rows["least"].to_numpy(), prepend=-1).astype(bool)
            | np.diff(rows["key"].to_numpy(), prepend=0).astype(bool)
            | (np.arange(len(rows)) == 0)
        )
        ends = np.append(lists[1:], len(rows))
        own = np.repeat(np.arange(len(lists)), ends - lists)
        longer = rows["longer"].to_numpy()
        side = rows["side"].to_numpy()
        # A list is sorted by ``longer``; every shorter word meets the words after it.
        shorter = np.flatnonzero(~longer)
        unique = rows["word"].combine_chunks().dictionary_encode()
        index = unique.indices.to_numpy()
        words = unique.dictionary
        data, starts = _marked(words)
        sizes = np.diff(starts) - 2
        width = int(sizes.max()) + 2
        text = np.zeros((len(words), width), np.uint8)
        cell = np.arange(len(data)) - np.repeat(starts[:-1], sizes + 2)
        text[np.repeat(np.arange(len(words)), sizes + 2), cell] = data
        word, place, code, length, _ = decompose(data, starts, grams, counts)
        need = sizes + 1 - affected(word, place, length, sizes + 2)
        rank = np.argsort(pc.sort_indices(words).to_numpy())
        # Short hashes of grams: counts can only come out too high.
        signs = np.zeros((len(words), width), np.uint16)
        signs[word, place] = (mix(code.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)

        out = []
        partners = ends[own[shorter]] - shorter - 1
        first = 0
        bounds = np.concatenate([[0], np.cumsum(partners)])
        step = max(1, PAIRS * 16 // max(16, width))
        while first < len(shorter):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + step, "right")) - 1)
            n = partners[first:last]
            left = np.repeat(shorter[first:last], n)
            right = left + 1 + np.arange(len(left)) - np.repeat(bounds[first:last] - bounds[first], n)
            first = last
            apart = (side[left] == 0) | (side[left] != side[right])
            left, right = left[apart], right[apart]
            a, b = index[left], index[right]
            for extra in (0, 1):
                mine = longer[right] == bool(extra)
                x, y = a[mine], b[mine]
                shared = ((signs[x] == signs[y]) & (signs[x] > 0)).sum(axis=1)
                if extra:
                    moved = (signs[x][:, :-1] == signs[y][:, 1:]) & (signs[x][:, :-1] > 0)
                    shared += moved.sum(axis=1)
                enough = shared >= np.maximum(need[x], need[y])
                x, y = x[enough], y[enough]
                if not extra:
                    near = (text[x] != text[y]).sum(axis=1) == 1
                    x, y = np.where(rank[x] < rank[y], (x, y), (y, x))
                else:
                    # Equal from the front up to some place and, moved by one, from there to the end.
                    front = np.cumprod(text[x] == text[y], axis=1, dtype=np.int8).sum(axis=1)
                    back = np.cumprod((text[x][:, :-1] == text[y][:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1)
                    near = front + back >= width - 1
                out.append(np.stack([x[near], y[near]]))
        pairs = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), np.int64)
        totals = np.zeros(len(words), np.int64)
        totals[index] = rows["n"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                words.take(pa.array(pairs[0])), pa.array(totals[pairs[0]]),
                words.take(pa.array(pairs[1])), pa.array(totals[pairs[1]]),
            ],
            ["a", "n_a", "b", "n_b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows * (batch.column("least").to_numpy().max() + 3)
            # Whole lists are compared; the last may go on in the next batch.
            if size >= PART_BYTES:
                rows = pa.Table.from_batches(held)
                keys = rows["key"].to_numpy()
                last = np.flatnonzero(keys != keys[-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield compare(rows.slice(0, cut))
                    rest = rows.slice(cut)
                    held = rest.to_batches()
                    size = rest.num_rows * (int(rest["least"].to_numpy()[-1]) + 3)
        if held:
            yield compare(pa.Table.from_batches(held))

    return run


def _parted(postings: DataFrame) -> DataFrame:
    """Postings with ``side``; the parts of a long list meet in pairs, as lists of their own.

    side: 0 where all of a list meet, else 1 or 2, and only words of different sides meet.
    """
    limit = F.greatest(F.lit(16), F.least(F.lit(PART_WORDS), F.expr(f"{PART_BYTES} div (least + 3)")))
    long = (
        postings.groupBy("key", "least")
        .agg(F.count("*").alias("size"))
        .withColumn("parts", F.ceil(F.col("size") / limit).cast("int"))
        .filter("parts > 1")
        .select("key", "least", "parts")
    )
    rows = postings.join(long, ["key", "least"], "left")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.expr("sequence(0, parts - 1)")))
    rows = rows.withColumn("part", part).withColumn("other", other)
    cell = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    return rows.select(
        F.when(F.col("parts").isNull(), F.col("key")).otherwise(cell).alias("key"),
        "least",
        "longer",
        F.when(F.col("parts").isNull() | (F.col("part") == F.col("other")), 0)
        .when(F.col("part") < F.col("other"), 1)
        .otherwise(2)
        .cast("tinyint")
        .alias("side"),
        "word",
        "n",
    )


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every two near words once, the shorter (or smaller) first.

    ``words`` has distinct words of MAX_GRAM or more code points up to U+00FF, and their counts. It
    is read more than once.
    """
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    grams, counts = gram_dictionary(words, max(FREQUENT, -(-total // DICTIONARY)))
    schema = "key bigint, least int, longer boolean, word string, n bigint"
    postings = words.select("word", "n").mapInArrow(_postings(grams, counts), schema)
    lists = _parted(postings).repartition("key").sortWithinPartitions("least", "key", "longer", "side", "word")
    return lists.mapInArrow(_near(grams, counts), "a string, n_a bigint, b string, n_b bigint").distinct()


# ---- forms ------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round doubles the way that a root has gone."""
    current = store(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not current.filter("moved").isEmpty():
        roots = current.select("word", "root")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = F.col("next").isNotNull()
        after = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), moved.alias("moved")
        )
        after = store(after, "roots")
        discard(current)
        current = after
    return current.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    delete_every: int = 97,
    least: int = 5,
    occurrences: int = 3,
    ratio: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words of enough code points and occurrences.

    ``least`` is MAX_GRAM at least, as the bounds need it.
    """
    if least < MAX_GRAM:
        raise ValueError(f"least must be {MAX_GRAM} or more")
    counted = count_words(docs, delete_every, least, id_col, text_col)
    words = store(counted.filter(F.col("n") >= occurrences), "words")
    pairs = store(near_words(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_near")).unionAll(
        pairs.select("b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("less"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    lead = -F.col("best.less") >= ratio * F.col("n")
    grouped = store(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(lead, F.col("best.near")).alias("form"),
            F.when(lead, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    discard(words, pairs)
    roots = _roots(grouped.filter("form IS NOT NULL").select("word", "form"))
    return grouped.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
