"""Toxicity scores of texts restored from obfuscation by a noisy channel.

Restoring: suspicious words (marks or digits among letters, letters repeated three times, letters
set apart by spaces or marks) become lattices. Each character seen may stand for itself, for a
letter it looks like, or for nothing (a repeated letter, a separator), at a channel cost; Viterbi
search finds the likeliest characters under a character trigram model of the whole corpus. Other
words for which the channel has more than one reading (one doubled letter, one mark inside, any
look-alike beside letters) and runs of words of one or two letters are mostly what they seem. They
stay in the text, and their likeliest reading counts beside them. A word of digits is a number.

Scoring: words and word beginnings of the restored text, and of the readings beside it, are looked
up among the features that
labelled toxic rows have more often. A feature weighs the Wilson lower bound of its share of toxic
rows. A logistic function of the largest weight among words and beginnings of LONG bytes or more,
of that among shorter beginnings (weak evidence alone, as innocent words share them), and of the
number of heavy words gives the score; it is fitted on labelled rows whose features were not
counted.

* The trigram counts are taken over all texts, in arrays of 64^3 per task, and added up.
* At most MAX_LABELLED labelled rows are used, those of least id hash. Their ids (and only ids) are
  broadcast. Features are counted in Spark; those of at least MIN_ROWS toxic rows, and of one in
  MAX_SHARES of them, are kept.
* Scoring is one pass over the texts without a shuffle.

Defined cases: null texts are empty and score like a text without any feature; a null id counts
as the empty string for the fold and has no label; repeated labels of an id count as toxic if one
is; null labels are dropped; without rows of both kinds every score is the share of toxic rows (0
without labels); repeated rows score alike; an empty table has an empty result; the table of
documents may have columns of any other names, label columns among them: none is read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import (
    bounded_batches,
    carried_text,
    chunks,
    column,
    mix,
    store,
    text_buffer,
)
from courtlens.llm.shingles import (
    LOWER,
    SPACED,
    UNCHANGED,
    Words,
    byte_table,
    find_words,
    prefix_hashes,
)

MAX_LABELLED = 200_000
# A feature is kept if MIN_ROWS labelled toxic rows have it, and one in MAX_SHARES of them: at most
# MAX_SHARES times as many features as such a row has on the average.
MIN_ROWS, MAX_SHARES = 4, 5000
# Counts of features that a task holds.
TASK_FEATURES = 1 << 20
HELD_OUT = 5
# Of the training rows, one in FIT fits the logistic function and is not counted.
FIT = 5
# Wide enough that a chance feature of a few rows weighs little: 4 of 4 rows give 0.31.
Z = 3.0
HEAVY = 0.5
PREFIXES = (3, 4, 5, 6, 7, 8)
LONG = 5

# ---- the character model ----------------------------------------------------

# 64 classes of bytes: boundary, letters, digits, marks, lead bytes, continuation bytes.
CLASSES = 64
_DIGIT, _MARK, _LEAD = 27, 28, 29


def _byte_classes() -> np.ndarray:
    table = np.full(256, _MARK, np.int64)
    table[[0x20, *range(0x9, 0xE)]] = 0
    for i in range(26):
        table[97 + i] = table[65 + i] = 1 + i
    table[48:58] = _DIGIT
    table[0x80:0xC0] = 32 + np.arange(64) % 32
    table[0xC0:] = _LEAD + np.minimum(np.arange(64) // 4, 2)
    return table


BYTE_CLASS = _byte_classes()


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**3, np.int64)
    for whole in batches:
        for batch in chunks(whole):
            data, offsets = text_buffer(batch)
            # A boundary between texts.
            classes = np.insert(BYTE_CLASS[data], offsets[1:-1], 0)
            classes = np.concatenate([[0, 0], classes, [0]])
            codes = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
            total += np.bincount(codes, minlength=CLASSES**3)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])


def character_model(texts: DataFrame) -> np.ndarray:
    """Log-probability of each class after two others, Witten-Bell smoothed; over all texts."""
    found = (
        texts.select("_text")
        .mapInArrow(_count_trigrams, "code bigint, n bigint")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
    )
    with bounded_batches(texts.sparkSession):
        counted = found.toArrow()
    counts = np.zeros(CLASSES**3)
    counts[counted["code"].to_numpy()] = counted["n"].to_numpy()
    p = np.full((1, CLASSES), 1 / CLASSES)
    for order in range(3):
        c = counts.reshape(-1, CLASSES**order, CLASSES).sum(axis=0)
        kinds = (c > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(p, (c.shape[0] // p.shape[0], 1))
        weight = c.sum(axis=1, keepdims=True) + kinds
        p = np.where(weight > 0, (c + kinds * shorter) / np.maximum(weight, 1), shorter)
    return np.log(p).reshape(CLASSES, CLASSES, CLASSES)


# ---- the channel ------------------------------------------------------------

# Letters that a mark or digit may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h",
}
_SUBSTITUTE, _REPEATED, _SEPARATOR, _HIDDEN = 1.0, 1.5, 0.5, 3.0
_JOINERS = b" \t\n\r\x0b\x0c.-_*"


def _options(b: int, last: int, inside: bool) -> list[tuple[int, float]]:
    """(byte meant or -1 for none, cost) for a byte seen after another."""
    options = [(b, 0.0)]
    wild = b == 0x2A
    for letter in LOOKALIKES.get(chr(b), ""):
        options.append((ord(letter), _HIDDEN if wild else _SUBSTITUTE))
    if b == last and b < 0x80:
        options.append((-1, _REPEATED))
    if inside and b in _JOINERS:
        options.append((-1, _SEPARATOR))
    return options


def _lattice(seen: bytes) -> list[list[tuple[int, float]]]:
    """The options of every byte."""
    last = b"\xff" + seen
    return [_options(b, last[i], 0 < i < len(seen) - 1) for i, b in enumerate(seen)]


_CLASS = BYTE_CLASS.tolist()
# Bytes that may have another reading: look-alikes, separators, and those that repeat the one before.
_ODD_PLACE = re.compile(
    b"[" + re.escape("".join(LOOKALIKES).encode() + _JOINERS) + rb"]|(?<=([\x00-\x7f]))\1"
).search
# By whether a byte repeats the one before, whether it stands inside, and the byte: its options with
# their classes. One option is the byte itself.
_CHOICES = [
    [
        [
            [(meant, _CLASS[meant], cost) for meant, cost in _options(b, b if repeats else -1, inside)]
            for b in range(256)
        ]
        for inside in (False, True)
    ]
    for repeats in (False, True)
]


class _Flat(list):
    """The model as a list, whose items cost less to reach one by one, as it was, and passages read."""

    table: np.ndarray
    read: dict[tuple[bytes, bytes, bool], bytes]


def _flat(model: np.ndarray) -> _Flat:
    flat = _Flat(model.ravel().tolist())
    flat.table = model
    flat.read = {}
    return flat


def restore_word(seen: bytes, model: np.ndarray | _Flat) -> bytes:
    """The likeliest characters behind the bytes seen, lower-cased where ASCII.

    Viterbi search over the last two classes meant. Where one state is left, all paths have what came
    before in common, and its cost is left out; two plain bytes after the last reading see to that.
    So a word is read passage by passage, and a passage depends on the two bytes meant before it.
    """
    seen = seen.lower()
    flat = model if isinstance(model, _Flat) else _flat(model)
    size, done = len(seen), 0
    out = bytearray()
    while (place := _ODD_PLACE(seen, done)) is not None:
        start = place.start()
        out += seen[done:start]
        # Up to two plain bytes in a row, or to the end.
        while place is not None:
            done = place.end()
            place = _ODD_PLACE(seen, done, done + 2)
        done = min(done + 2, size)
        # The first byte of a word is meant, so that nothing before says that it begins here.
        passage = (bytes(out[-2:]), seen[max(0, start - 1) : done], done == size)
        meant = flat.read.get(passage)
        if meant is None:
            if len(flat.read) >= 200_000:
                flat.read.clear()
            meant = _read_passage(*passage, flat)
            if done - start <= 64:
                flat.read[passage] = meant
        out += meant
    return bytes(out + seen[done:])


def _read_passage(before: bytes, seen: bytes, ends: bool, flat: _Flat) -> bytes:
    """What is meant by ``seen``, whose first byte is the one before the passage if there is one.

    ``before`` are the last bytes meant, at most two; ``ends`` if the word ends here.
    """
    state = 0
    for b in before:
        state = state % CLASSES * CLASSES + _CLASS[b]
    # States are 64 * class before last + class of the last, without cost where one is left; with the
    # cost and the bytes meant since they parted.
    states: dict[int, tuple[float, tuple | None]] = {state: (0.0, None)}
    out, final = bytearray(), len(seen) - 1 if ends else len(seen)
    first = 1 if before else 0
    last = seen[0] if before else -1
    for i in range(first, len(seen)):
        b = seen[i]
        options = _CHOICES[b == last][0 < i < final][b]
        last = b
        after: dict[int, tuple[float, tuple | None]] = {}
        for key, (cost, path) in states.items():
            shorter, at = key % CLASSES * CLASSES, key * CLASSES
            for meant, c, channel in options:
                if meant < 0:
                    to, total, way = key, cost + channel, path
                else:
                    to, total, way = shorter + c, cost + channel - flat[at + c], (meant, path)
                if to not in after or total < after[to][0]:
                    after[to] = (total, way)
        if len(after) == 1:
            ((state, (_, path)),) = after.items()
            out += _meant(path)
            after = {state: (0.0, None)}
        states = after
    if len(states) == 1:
        return bytes(out)
    _, path = min(
        ((cost - flat[key * CLASSES], path) for key, (cost, path) in states.items()), key=lambda x: x[0]
    )
    return bytes(out + _meant(path))


def _meant(path: tuple | None) -> bytes:
    out = []
    while path is not None:
        meant, path = path
        out.append(meant)
    return bytes(out[::-1])


_LETTER = byte_table([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_PLAIN = byte_table([(0x41, 0x5A), (0x61, 0x7A)])
_ODD = byte_table([(ord(c), ord(c)) for c in LOOKALIKES if c != "2"])
_DOT = byte_table([(ord(c), ord(c)) for c in ".-_*"])
_ANY_ODD = byte_table([(ord(c), ord(c)) for c in LOOKALIKES])
_JOIN = byte_table([(b, b) for b in _JOINERS])
_DIGITS = byte_table([(0x30, 0x39)])
_MONEY = byte_table([(0x24, 0x24), (0x40, 0x40)])


def _counts(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flagged bytes of each range; flags are few, and ranges ascend and do not overlap."""
    at = np.flatnonzero(flags)
    of = np.searchsorted(starts, at, "right") - 1
    inside = (of >= 0) & (at < ends[np.maximum(of, 0)])
    return np.bincount(of[inside], minlength=len(starts))


def _any(at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which ranges, in any order, hold one of the places ``at``, which ascend."""
    return np.searchsorted(at, ends) > np.searchsorted(at, starts)


def _sums(flags: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:])
    return sums


def suspicious(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges (starts, ends) that may be obfuscated, in order and apart."""
    if not len(words.starts):
        return words.starts, words.ends

    def total(flags: np.ndarray) -> np.ndarray:
        return _counts(flags, words.starts, words.ends)

    lower = data | 0x20
    letter, odd = _LETTER[data], _ODD[data]
    triple = np.zeros(len(data), bool)
    if len(data) > 2:
        triple[2:] = _PLAIN[data[2:]] & (lower[2:] == lower[1:-1]) & (lower[1:-1] == lower[:-2])
    # Neighbours in the same word: the byte beyond its end may be another text's.
    after, before = np.zeros(len(data), bool), np.zeros(len(data), bool)
    after[:-1], before[1:] = letter[1:], letter[:-1]
    after[words.ends - 1], before[words.starts] = False, False
    digits = odd & ~byte_table([(0x21, 0x2F), (0x3A, 0x40), (0x7B, 0x7E)])[data]
    beside = odd & after | digits & before
    sums, dots = _sums(letter), total(_DOT[data])
    letters = sums[words.ends] - sums[words.starts]
    size = words.ends - words.starts
    # A run of three letters that began in an earlier word is no triple of this one.
    flagged = (total(triple) > 0) & (size > 2)
    flagged |= (total(beside) > 0) & (letters > 0)
    flagged |= (dots > 1) & (letters >= 2) & (letters <= dots + 2) & (size <= 2 * dots + 3)
    # Words of one letter, the last perhaps with a mark, three or more in a row.
    single = (size == 1) & (letter | odd)[words.starts]
    single |= (size == 2) & (letter | odd)[words.starts] & ~letter[words.ends - 1]
    same = np.zeros(len(single), bool)
    same[1:] = single[1:] & single[:-1] & (words.texts[1:] == words.texts[:-1])
    group = np.cumsum(~same)
    members = np.bincount(group, single, minlength=group[-1] + 1)
    run = single & (members[group] >= 3)
    keep = run | flagged
    first = keep & ~(run & same & np.concatenate([[False], run[:-1]]))
    last = keep & ~np.concatenate([run[1:] & same[1:] & run[:-1], [False]])
    return words.starts[first], words.ends[last]


def readable(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges (starts, ends) of which the channel has another reading; runs may hold words."""
    if not len(words.starts):
        return words.starts, words.ends
    starts, ends = words.starts, words.ends
    size = ends - starts

    def total(flags: np.ndarray, first: np.ndarray = starts, last: np.ndarray = ends) -> np.ndarray:
        return _counts(flags, first, last)

    lower = LOWER[data]
    double = np.zeros(len(data), bool)
    double[1:] = (lower[1:] == lower[:-1]) & (data[1:] < 0x80)
    letter, odd = _LETTER[data], _ANY_ODD[data]
    other = total(odd) > 0
    other |= total(double, np.minimum(starts + 1, ends), ends) > 0
    other |= total(_DOT[data], starts + 1, np.maximum(ends - 1, starts + 1)) > 0
    sums = _sums(letter)
    letters = sums[ends] - sums[starts]
    marks_only = (letters + total(_DIGITS[data]) == 0) & (total(_MONEY[data]) > 0) & (size > 1)
    flagged = other & (letters > 0) | marks_only
    # Words of one or two letters, the last perhaps with a mark, three or more in a row.
    char = letter | odd
    short = (size <= 3) & char[starts] & ((size < 2) | char[np.minimum(starts + 1, ends - 1)] | ~letter[ends - 1])
    short &= (size < 3) | ~letter[ends - 1]
    same = np.zeros(len(short), bool)
    same[1:] = short[1:] & short[:-1] & (words.texts[1:] == words.texts[:-1])
    heads = np.flatnonzero(~same)
    tails = np.append(heads[1:], len(short)) - 1
    # Runs of single letters are restored in the text.
    run = short[heads] & (tails - heads >= 2) & (np.add.reduceat(letters > 1, heads) > 0)
    return (
        np.concatenate([starts[flagged], starts[heads[run]]]),
        np.concatenate([ends[flagged], ends[tails[run]]]),
    )


def _unsure(
    data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray
) -> np.ndarray:
    """Which ranges may read otherwise: all but those whose only readings drop letters that stay.

    Where the byte after a doubled letter is plain, the paths with and without the letter meet again
    there, so that the three costs up to it decide. Words end at class 0, as texts do.
    """
    lower = LOWER[data]
    double = np.zeros(len(data), bool)
    double[1:] = (lower[1:] == lower[:-1]) & (data[1:] < 0x80)
    at = np.flatnonzero(double)
    first, last = (np.zeros(len(data) + 1, bool) for _ in range(2))
    first[offsets[:-1]], last[offsets[1:]] = True, True
    x = BYTE_CLASS[data[at]]
    before = np.where(first[at - 1], 0, BYTE_CLASS[data[np.maximum(at - 2, 0)]])
    after = np.where(last[at + 1], 0, BYTE_CLASS[data[np.minimum(at + 1, len(data) - 1)]])
    stays = -table[before, x, x] - table[x, x, after] <= _REPEATED - table[before, x, after]
    beside = np.zeros(len(at), bool)
    beside[:-1] = at[1:] == at[:-1] + 1
    drops = at[~stays | beside]
    inner = np.minimum(starts + 1, ends)
    unsure = _any(np.flatnonzero(_ANY_ODD[data]), starts, ends)
    unsure |= _any(np.flatnonzero(_JOIN[data]), inner, np.maximum(ends - 1, inner))
    return unsure | _any(drops, inner, ends)


def _restored(seen: bytes, model: np.ndarray | list[float], cache: dict[bytes, bytes]) -> bytes:
    meant = cache.get(seen)
    if meant is None:
        if len(cache) >= 200_000:
            cache.clear()
        meant = restore_word(seen, model)
        # Longer ones hardly come again, and would make the cache large.
        if len(seen) <= 64:
            cache[seen] = meant
    return meant


def restore_chunk(
    data: np.ndarray, offsets: np.ndarray, model: np.ndarray, cache: dict[bytes, bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """The texts with suspicious ranges restored, and their offsets."""
    words = find_words(data, offsets, SPACED, UNCHANGED, hashed=False)
    starts, ends = suspicious(data, words)
    if not len(starts):
        return data, offsets
    raw, parts, at = data.tobytes(), [], 0
    grown = np.zeros(len(offsets), np.int64)
    owner = np.searchsorted(offsets, starts, "right")
    for a, b, text in zip(starts.tolist(), ends.tolist(), owner.tolist()):
        seen = raw[a:b]
        meant = _restored(seen, model, cache)
        parts += [raw[at:a], meant]
        grown[text] += len(meant) - (b - a)
        at = b
    parts.append(raw[at:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets + np.cumsum(grown)


def restore_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, restored) per row, under a character model of these texts."""
    texts = _texts(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(character_model(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, bytes] = {}
        flat = _flat(model.value)
        for whole in batches:
            for batch in chunks(whole):
                data, offsets = restore_chunk(*text_buffer(batch), flat, cache)
                raw = data.tobytes()
                restored = [raw[a:b].decode() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(restored, pa.string())], ["_id", "restored"]
                )

    kind = texts.schema["_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"_id {kind}, restored string")


# ---- features ---------------------------------------------------------------


def _fold(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[latin] += 32
    return out


_SALTS = mix(np.arange(1, max(PREFIXES) + 2, dtype=np.uint64))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, word, text, long) of every word and of its beginnings of PREFIXES bytes."""
    return _features(data, offsets)[1]


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, tuple[np.ndarray, ...]]:
    folded = _fold(data)
    words = find_words(folded, offsets, _LETTER, UNCHANGED, hashed=False)
    range_hash = prefix_hashes(folded)
    hashes, owners = [mix(range_hash(words.starts, words.ends))], [np.arange(len(words.starts))]
    long = [np.ones(len(words.starts), bool)]
    for n in PREFIXES:
        longer = np.flatnonzero(words.ends - words.starts > n)
        start = words.starts[longer]
        # A salt keeps a beginning apart from the whole word of the same letters, and of others.
        hashes.append(mix(range_hash(start, start + n) ^ _SALTS[n]))
        owners.append(longer)
        long.append(np.full(len(longer), n >= LONG))
    owner = np.concatenate(owners)
    return words, (np.concatenate(hashes), owner, words.texts[owner], np.concatenate(long))


def restored_features(
    data: np.ndarray, offsets: np.ndarray, model: np.ndarray, cache: dict[bytes, bytes]
) -> tuple[np.ndarray, ...]:
    """``features`` of the restored texts and of other readings, whose word is the one they read."""
    data, offsets = restore_chunk(data, offsets, model, cache)
    words, found = _features(data, offsets)
    starts, ends = readable(data, find_words(data, offsets, SPACED, UNCHANGED, hashed=False))
    if len(starts):
        unsure = _unsure(data, offsets, starts, ends, getattr(model, "table", model))
        starts, ends = starts[unsure], ends[unsure]
    if not len(starts):
        return found
    # Equal ranges are read once. Bytes tell them apart, not hashes.
    raw, forms = data.tobytes(), {}
    form = np.fromiter(
        (forms.setdefault(raw[a:b], len(forms)) for a, b in zip(starts.tolist(), ends.tolist())),
        np.int64,
        len(starts),
    )
    readings = [_restored(seen, model, cache) for seen in forms]
    changed = np.array([meant != seen.lower() for seen, meant in zip(forms, readings)])
    mine = changed[form]
    starts, ends, form = starts[mine], ends[mine], (np.cumsum(changed) - 1)[form[mine]]
    if not len(form):
        return found
    readings = [meant for meant, new in zip(readings, changed.tolist()) if new]
    joined = np.frombuffer(b"".join(readings), np.uint8)
    _, (hashes, _, of, long) = _features(joined, np.cumsum([0, *map(len, readings)]))
    order = np.argsort(of, kind="stable")
    first, stop = np.searchsorted(of[order], form, "left"), np.searchsorted(of[order], form, "right")
    count = stop - first
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    # A range without a letter holds no word; it is one of its own.
    word = np.searchsorted(words.starts, starts)
    none = word == len(words.starts)
    none[~none] = words.starts[word[~none]] >= ends[~none]
    word = np.where(none, len(words.starts) + np.arange(len(word)), word)
    text = np.searchsorted(offsets, starts, "right") - 1
    more = (hashes[order][at], np.repeat(word, count), np.repeat(text, count), long[order][at])
    return tuple(np.concatenate(x) for x in zip(found, more))


def _feature_rows(model):
    """Distinct features of each text, counted as (feature, toxic rows, other rows).

    A task hands its counts on whenever it holds TASK_FEATURES of them.
    """

    def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        hashes, bad, good = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
        if not len(heads):
            return hashes, bad, good
        return hashes[heads], np.add.reduceat(bad[order], heads), np.add.reduceat(good[order], heads)

    def rows(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        hashes, bad, good = part
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(bad), pa.array(good)], ["feature", "bad", "good"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, bytes] = {}
        flat = _flat(model.value)
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for whole in batches:
            for batch in chunks(whole):
                hashes, _, texts, _ = restored_features(*text_buffer(batch), flat, cache)
                toxic = np.asarray(batch.column("toxic"), np.int64)
                order = np.lexsort((texts, hashes))
                hashes, texts = hashes[order], texts[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
                hashes, label = hashes[new], toxic[texts[new]]
                held.append(summed([(hashes, label, 1 - label)]))
                size += len(held[-1][0])
                if size > TASK_FEATURES:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > TASK_FEATURES // 2:
                        yield rows(held[0])
                        held, size = [], 0
        if held:
            yield rows(summed(held))

    return run


def wilson(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Lower bound of the share of toxic rows among those with a feature."""
    n = np.maximum(bad + good, 1).astype(float)
    p = bad / n
    middle = p + Z * Z / (2 * n)
    return (middle - Z * np.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def _measures(model, table, text_in_row: str | None = None):
    """Per text: the largest weights of its long and short features, and its heavy words.

    ``text_in_row`` names the field of ``_row`` that holds the text, if there is no ``_text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights = table.value
        gate = np.zeros(1 << 20, bool)
        gate[keys >> np.uint64(44)] = True
        cache: dict[bytes, bytes] = {}
        flat = _flat(model.value)
        for whole in batches:
            if text_in_row is not None:
                whole = carried_text(whole, "_row", text_in_row)
            for batch in chunks(whole):
                hashes, words, texts, long = restored_features(*text_buffer(batch), flat, cache)
                found = np.flatnonzero(gate[hashes >> np.uint64(44)])
                at = np.minimum(np.searchsorted(keys, hashes[found]), max(0, len(keys) - 1))
                found, at = (x[keys[at] == hashes[found]] for x in (found, at)) if len(keys) else (
                    found[:0],
                    at[:0],
                )
                best, short = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                for out, kind in ((best, long[found]), (short, ~long[found])):
                    np.maximum.at(out, texts[found][kind], weights[at][kind])
                heavy = (weights[at] >= HEAVY) & long[found]
                _, one = np.unique(words[found][heavy], return_index=True)
                many = np.bincount(texts[found][heavy][one], minlength=batch.num_rows)
                kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "_text"]
                names = [n for n in batch.schema.names if n != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(best), pa.array(short), pa.array(many, pa.int64())],
                    [*names, "best", "short", "heavy"],
                )

    return run


def _inputs(best: np.ndarray, short: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    p, q = (np.clip(x, 0.01, 0.99) for x in (best, short))
    logits = [np.log(x / (1 - x)) for x in (p, q)]
    return np.stack([np.ones(len(p)), *logits, np.log1p(heavy)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method with a little ridge, so separable rows have a finite fit."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


# ---- the operator -----------------------------------------------------------


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        column(docs, id_col).alias("_id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("_text"),
    )


def held_out(identifier: Column) -> Column:
    text = F.coalesce(identifier.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % HELD_OUT == 0


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    learn_from: DataFrame | None = None,
    carry: bool = False,
) -> DataFrame:
    """(_id, held_out, score, predicted) per document, one row for each row of ``docs``.

    ``learn_from`` has the texts of the labelled rows if they are not (all) in ``docs``. With
    ``carry`` the whole row comes along as the struct ``_row``, so that filtering needs no join.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = _texts(docs, id_col, text_col)
    sources = texts if learn_from is None else _texts(learn_from, id_col, text_col)
    kind = texts.schema["_id"].dataType.simpleString()
    model = share(character_model(texts))
    train = store(
        labels.select(column(labels, id_col).alias("_id"), column(labels, label_col).alias("toxic"))
        .filter("_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(MAX_LABELLED),
        "training_labels",
    ).withColumn("fits", F.pmod(F.xxhash64("_id", F.lit("fit")), F.lit(FIT)) == 0)
    # Bounded by MAX_LABELLED ids.
    labelled = sources.join(F.broadcast(train), "_id")
    counting = labelled.filter("NOT fits").select("_text", "toxic")
    schema = "feature bigint, bad bigint, good bigint"

    toxic_rows = train.filter("NOT fits AND toxic = 1").count()
    found = (
        counting.mapInArrow(_feature_rows(model), schema)
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter(F.col("bad") >= max(MIN_ROWS, toxic_rows // MAX_SHARES))
    )
    with bounded_batches(spark):
        counted = found.toArrow()
    hashes = counted["feature"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    keys = hashes[order]
    weights = wilson(counted["bad"].to_numpy(), counted["good"].to_numpy())[order]
    fitted = share((keys, weights))
    measure = _measures(model, fitted)
    # At most MAX_LABELLED rows of four numbers.
    fitting = (
        labelled.filter("fits")
        .select("_text", "toxic")
        .mapInArrow(measure, "toxic int, best double, short double, heavy bigint")
    )
    with bounded_batches(spark):
        rows = fitting.toArrow()
    y = rows["toxic"].to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        fit = fit_logistic(_inputs(*(rows[c].to_numpy() for c in ("best", "short", "heavy"))), y)
    else:
        share_toxic = float(y.mean()) if len(y) else 0.0
        p = min(max(share_toxic, 1e-9), 1 - 1e-9)
        fit = np.array([math.log(p / (1 - p)), 0.0, 0.0, 0.0])
    logit = F.lit(float(fit[0])) + float(fit[3]) * F.log1p("heavy")
    for name, factor in zip(("best", "short"), fit[1:3].tolist()):
        p = F.least(F.greatest(name, F.lit(0.01)), F.lit(0.99))
        logit = logit + factor * F.log(p / (1 - p))
    extra, fields = [], ""
    if carry:
        row = F.struct(*[column(docs, c) for c in docs.columns]).alias("_row")
        texts = docs.select(column(docs, id_col).alias("_id"), row)
        measure = _measures(model, fitted, text_col)
        extra, fields = ["_row"], f"_row {texts.schema['_row'].dataType.simpleString()}, "
    scored = texts.mapInArrow(measure, f"_id {kind}, {fields}best double, short double, heavy bigint")
    scored = scored.select("_id", *extra, (1 / (1 + F.exp(-logit))).alias("score"))
    return scored.select(
        "_id",
        *extra,
        held_out(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
