"""Byte-level BPE encoding and decoding.

Texts are cut without regular expressions. Every code point becomes a class symbol (letter,
number, other mark, and white space or apostrophe by what follows it); a symbol is a transition
function on the states of a small automaton. Composition is associative, and the functions that
compositions can yield are few, so a scan needs one table lookup a code point, over many lanes at
once. The state before a symbol tells whether a piece begins there.

Each piece is merged by rank once and then found in a cache. The token ids of a text are stored as
little-endian unsigned 32-bit integers; the byte offsets of the vocabulary in one buffer are kept
for decoding, which gathers all bytes of a text in one step.

Defined cases: null texts are empty; an empty text has no ids; very long texts are one numpy pass
and very long pieces are merged with a heap; other columns are passed through by ``encode`` and
``decode``, which refuse a result name that is taken; an empty table has an empty result.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.llm.common import chunks, column, text_buffer

# Pieces kept in a task's cache before it starts afresh.
CACHE_PIECES = 200_000
# Pieces of more bytes are merged with a heap.
HEAP_FROM = 128
_LANE = 256

# ---- symbols and states -----------------------------------------------------

# Code point classes.
_MARK, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# Symbols: the last space before something, other white space there, white space before white
# space or at the end, and apostrophes that begin a contraction of two or three characters.
LETTER, NUMBER, MARK, LAST_SPACE, LAST_WHITE, WHITE, SHORT, LONG = range(8)
_SYMBOLS = 8
# States: nothing open, in letters, in numbers, in marks, after a space that joins what follows,
# in white space, one and two more characters of a contraction.
FREE, IN_LETTERS, IN_NUMBERS, IN_MARKS, JOINING, IN_WHITE, ONE_MORE, TWO_MORE = range(8)
_STATES = 8

# The white space characters of Unicode, and the ends of contractions.
_WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029]
_WHITE += [0x202F, 0x205F, 0x3000]
_SHORT_ENDS = ["s", "t", "m", "d"]
_LONG_ENDS = ["re", "ve", "ll"]


def code_point_classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.array(
        [kinds.get(unicodedata.category(chr(c))[0], _MARK) for c in range(0x110000)], np.uint8
    )
    table[_WHITE] = _SPACE
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins with this symbol."""
    if symbol == LETTER:
        if state == TWO_MORE:
            return ONE_MORE, False
        if state == ONE_MORE:
            return FREE, False
        return IN_LETTERS, state not in (IN_LETTERS, JOINING)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if symbol == LAST_SPACE:
        return JOINING, True
    if symbol == LAST_WHITE:
        return FREE, True
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    if symbol == MARK or state in (IN_MARKS, JOINING):
        return IN_MARKS, state not in (IN_MARKS, JOINING)
    return (ONE_MORE if symbol == SHORT else TWO_MORE), True


class Transitions:
    """The monoid that the symbols' transition functions generate.

    ``of[symbol]`` is a function's number, ``of_first`` that of the symbol after a reset, ``compose``
    the number of one function after another, ``from_free`` the state a function leads to from FREE.
    """

    def __init__(self) -> None:
        basic = [tuple(_step(s, x)[0] for s in range(_STATES)) for x in range(_SYMBOLS)]
        first = [(_step(FREE, x)[0],) * _STATES for x in range(_SYMBOLS)]
        found = dict.fromkeys([tuple(range(_STATES)), *basic, *first])
        while True:
            more = {tuple(g[s] for s in f) for f, g in product(found, repeat=2)} - found.keys()
            if not more:
                break
            found |= dict.fromkeys(sorted(more))
        number = {f: i for i, f in enumerate(found)}
        self.of = np.array([number[f] for f in basic], np.uint8)
        self.of_first = np.array([number[f] for f in first], np.uint8)
        self.size = len(found)
        self.compose = np.array(
            [[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8
        ).reshape(-1)
        self.from_free = np.array([f[FREE] for f in found], np.uint8)
        self.begins = np.array(
            [[_step(s, x)[1] for x in range(_SYMBOLS)] for s in range(_STATES)], bool
        ).reshape(-1)

    def scan(self, functions: np.ndarray) -> np.ndarray:
        """The function of everything up to and with each position."""
        n, size = len(functions), np.intp(self.size)
        lanes = -(-n // _LANE)
        padded = np.zeros(lanes * _LANE, np.uint8)
        padded[:n] = functions
        grid = np.ascontiguousarray(padded.reshape(lanes, _LANE).T)
        for i in range(1, _LANE):
            grid[i] = self.compose[grid[i - 1] * size + grid[i]]
        before = np.zeros(lanes, np.uint8)
        before[1:] = grid[-1, :-1]
        reach = 1
        while reach < lanes:
            later = self.compose[before[:-reach] * size + before[reach:]]
            before = np.concatenate([before[:reach], later])
            reach *= 2
        return self.compose[before * size + grid].T.reshape(-1)[:n]


def piece_starts(
    data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, transitions: Transitions
) -> np.ndarray:
    """Byte offsets at which a piece begins, over consecutive texts."""
    if not len(data):
        return np.empty(0, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    heads = np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[1:]])
    last = np.zeros(len(points), bool)
    last[heads[1:] - 1] = True
    last[-1] = True
    kinds = classes[points]
    white = kinds == _SPACE
    symbols = np.array([MARK, LETTER, NUMBER, LAST_WHITE], np.uint8)[kinds]
    symbols[white & (points == 0x20)] = LAST_SPACE
    inner = white.copy()
    inner[:-1] &= white[1:] | last[:-1]
    symbols[inner] = WHITE
    quotes = np.flatnonzero((points == 0x27) & ~last)
    follow = points[quotes + 1]
    symbols[quotes[np.isin(follow, [ord(e) for e in _SHORT_ENDS])]] = SHORT
    quotes, follow = (x[~last[quotes + 1]] for x in (quotes, follow))
    second = points[quotes + 2]
    for end in _LONG_ENDS:
        symbols[quotes[(follow == ord(end[0])) & (second == ord(end[1]))]] = LONG
    functions = transitions.of[symbols]
    functions[heads] = transitions.of_first[symbols[heads]]
    done = transitions.scan(functions)
    before = np.full(len(points), FREE, np.intp)
    before[1:] = transitions.from_free[done[:-1]]
    before[heads] = FREE
    begins = transitions.begins[before * _SYMBOLS + symbols]
    return at[begins]


# ---- merging ----------------------------------------------------------------


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a piece: the adjacent pair of least rank is merged first, the left one on ties."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) >= HEAP_FROM:
        return _merge_long(piece, ranks)
    none = 1 << 60
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1") * n
    while heap:
        _, i, size = heapq.heappop(heap)
        # The pair may have changed since it was pushed.
        if not alive[i] or end[i] == n or end[end[i]] - i != size:
            continue
        gone = end[i]
        alive[gone], end[i] = 0, end[gone]
        if end[i] < n:
            left[end[i]] = i
            joined = piece[i : end[end[i]]]
            if (r := ranks.get(joined)) is not None:
                heapq.heappush(heap, (r, i, len(joined)))
        if left[i] >= 0:
            joined = piece[left[i] : end[i]]
            if (r := ranks.get(joined)) is not None:
                heapq.heappush(heap, (r, left[i], len(joined)))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


# ---- the operators ----------------------------------------------------------


class Vocabulary:
    """Ranks of a vocabulary file (one base64 token and its rank a line), read on the driver."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes, the first is {missing[0]}")
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)


def _appended(df: DataFrame, name: str) -> str:
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    fields = [*df.schema.fields]
    return ", ".join(
        [*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields), f"`{name}` binary"]
    )


def encode(
    df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out: str = "ids"
) -> DataFrame:
    """``df`` with the token ids of every text, as little-endian unsigned 32-bit integers."""
    return df.mapInArrow(_encoder(df, vocabulary, text_col, out), _appended(df, out))


def _encoder(df: DataFrame, vocabulary: Vocabulary, text_col: str, out: str):
    shared = df.sparkSession.sparkContext.broadcast((vocabulary.ranks, code_point_classes()))
    transitions = Transitions()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, classes = shared.value
        cache: dict[bytes, bytes] = {}
        for whole in batches:
            texts = whole.column(text_col)
            if texts.null_count:
                texts = texts.fill_null("")
            both = whole.append_column("_bpe_text", texts)
            for batch in chunks(both, "_bpe_text"):
                data, offsets = text_buffer(batch, "_bpe_text")
                starts = piece_starts(data, offsets, classes, transitions)
                raw = data.tobytes()
                bounds = [*starts.tolist(), len(raw)]
                codes = []
                for a, b in zip(bounds, bounds[1:]):
                    piece = raw[a:b]
                    code = cache.get(piece)
                    if code is None:
                        if len(cache) >= CACHE_PIECES:
                            cache.clear()
                        code = np.array(merge(piece, ranks), "<u4").tobytes()
                        cache[piece] = code
                    codes.append(code)
                first = np.searchsorted(starts, offsets).tolist()
                ids = [b"".join(codes[a:b]) for a, b in zip(first, first[1:])]
                kept = [batch.column(i) for i in range(whole.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(ids, pa.binary())], [*whole.schema.names, out]
                )

    return run


def decode(
    df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``df`` with the bytes that the token ids stand for; null ids have none."""
    return df.mapInArrow(_decoder(df, vocabulary, ids_col, out), _appended(df, out))


def _decoder(df: DataFrame, vocabulary: Vocabulary, ids_col: str, out: str):
    shared = df.sparkSession.sparkContext.broadcast((vocabulary.offsets, vocabulary.bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, data = shared.value
        for batch in batches:
            decoded = []
            for code in batch.column(ids_col):
                ids = np.frombuffer(code.as_py() or b"", "<u4")
                starts, lengths = offsets[ids], offsets[ids + 1] - offsets[ids]
                begins = np.cumsum(lengths) - lengths
                places = np.repeat(starts - begins, lengths) + np.arange(lengths.sum())
                decoded.append(data[places].tobytes())
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(decoded, pa.binary())], [*batch.schema.names, out]
            )

    return run


def token_offsets(ids: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Byte offset of each token in the text, and the text's length at the end."""
    codes = np.frombuffer(ids, "<u4")
    lengths = vocabulary.offsets[codes + 1] - vocabulary.offsets[codes]
    return np.concatenate([[0], np.cumsum(lengths)])


def round_trip(
    spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(_id, ids, decoded) per row; both operators run in one pass of one worker."""
    vocabulary = Vocabulary(path)
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(column(docs, id_col).alias("_id"), text.alias("_text"))
    encoder = _encoder(rows, vocabulary, "_text", "ids")
    decoder = _decoder(rows, vocabulary, "ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoder(batch.select(["_id", "ids"]) for batch in encoder(batches))

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, ids binary, decoded binary")
