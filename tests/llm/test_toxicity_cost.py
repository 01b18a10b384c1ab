"""What restoring and hashing words costs, counted."""

import numpy as np
import pyarrow as pa
import pytest
from cases import prose
from test_toxicity import corpus, model  # noqa: F401

from courtlens.llm import shingles, toxicity
from courtlens.llm.common import text_buffer


def test_bytes_are_hashed_once_for_texts_and_once_for_readings(model, monkeypatch):  # noqa: F811
    calls, real = [], shingles.prefix_hashes

    def counted(data):
        calls.append(len(data))
        return real(data)

    monkeypatch.setattr(shingles, "prefix_hashes", counted)
    monkeypatch.setattr(toxicity, "prefix_hashes", counted)
    batch = pa.RecordBatch.from_arrays([pa.array([f"{prose(1, 50)} id-iot mor0n idiiot {prose(2, 50)}"])], ["_text"])
    assert len(toxicity.restored_features(*text_buffer(batch), model, {})[0]) > 100
    assert len(calls) <= 2


def test_words_share_the_passages_that_may_read_otherwise(model, monkeypatch):  # noqa: F811
    read, real = [], toxicity._read_passage
    monkeypatch.setattr(toxicity, "_read_passage", lambda *a: read.append(a) or real(*a))
    flat = toxicity._flat(model)
    for first in "abcdefgh":
        word = f"{first}utrash$$$".encode()
        assert toxicity.restore_word(word, flat) == toxicity.restore_word(word, model)
    assert len(read) == 8 + 1


def search(seen, table):
    """All sequences of two classes at once, without merging before the end."""
    states = {(0, 0): (0.0, b"")}
    for options in toxicity._lattice(seen.lower()):
        after = {}
        for (x, y), (cost, path) in states.items():
            for meant, channel in options:
                c = y if meant < 0 else int(toxicity.BYTE_CLASS[meant])
                to = (x, y) if meant < 0 else (y, c)
                total = cost + channel - (0.0 if meant < 0 else table[x, y, c])
                if to not in after or total < after[to][0]:
                    after[to] = (total, path if meant < 0 else path + bytes([meant]))
        states = after
    return min(cost - table[x, y, 0] for (x, y), (cost, _) in states.items())


def cost_of(seen, meant, table):
    """Least cost of one reading."""
    reached = {0: 0.0}
    classes = [0, 0, *(int(toxicity.BYTE_CLASS[b]) for b in meant)]
    for options in toxicity._lattice(seen.lower()):
        after = {}
        for at, cost in reached.items():
            for what, channel in options:
                if what < 0:
                    after[at] = min(after.get(at, np.inf), cost + channel)
                elif at < len(meant) and meant[at] == what:
                    total = cost + channel - table[classes[at], classes[at + 1], classes[at + 2]]
                    after[at + 1] = min(after.get(at + 1, np.inf), total)
        reached = after
    return reached[len(meant)] - table[classes[-2], classes[-1], 0]


@pytest.mark.parametrize("seed", range(3))
def test_passages_read_together_are_the_likeliest_word(seed, model):  # noqa: F811
    rng, flat = np.random.default_rng(seed), toxicity._flat(model)
    letters = list("aabboiittrn0$2!.-* é")
    for _ in range(300):
        seen = "".join(rng.choice(letters, rng.integers(1, 14))).encode()
        meant = toxicity.restore_word(seen, flat)
        assert cost_of(seen, meant, model) == pytest.approx(search(seen, model), abs=1e-9), seen
