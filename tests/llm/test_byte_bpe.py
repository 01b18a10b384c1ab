import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from courtlens.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def known(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def pieces(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts = byte_bpe.piece_starts(data, offsets, byte_bpe.code_point_classes(), byte_bpe.Transitions())
    bounds = [*starts.tolist(), len(data)]
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(bounds, bounds[1:])]


def test_pieces_against_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(1)
    alphabet = [*"abcdestrvlm  \n\t0129.,!'", "'s", "'re", "'ll", " 's", "''", "é", "中", "²", "\xa0", "\u2003", "\x85", "\U0001f600", "ʼ", "٣", "\x00", "\u200b"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(4000)]
    texts += ["", "'", "'r", "'l", "x'", " ", "\n", " \n ", "a" * 3000, " " * 3000, "'ll" * 500]
    assert pieces(texts) == [m for t in texts for m in pattern.findall(t)]


def test_every_assigned_code_point_is_classed_as_by_the_pattern():
    import unicodedata

    import regex

    classes = byte_bpe.code_point_classes()
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    text = "".join(map(chr, every))
    for kind, name in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
        found = {ord(c) for c in regex.findall(name, text)}
        assert found == {c for c in every if classes[c] == kind}


def test_long_merges_equal_short_ones(vocabulary, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcde st") for _ in range(rng.randint(2, 300))).encode() for _ in range(60)]
    long = [byte_bpe._merge_long(t, vocabulary.ranks) for t in texts]
    monkeypatch.setattr(byte_bpe, "HEAP_FROM", 1 << 30)
    assert long == [byte_bpe.merge(t, vocabulary.ranks) for t in texts if t not in vocabulary.ranks]


def test_round_trip_against_the_library(spark, docs, known, vocabulary):
    rows = byte_bpe.round_trip(spark, docs, PATH).collect()
    want = sorted((str(r["doc_id"]), r["text"] or "") for r in docs.select("doc_id", "text").collect())
    got = sorted((str(r["_id"]), bytes(r["decoded"]).decode(), bytes(r["ids"])) for r in rows)
    assert [g[:2] for g in got] == want
    for _, text, ids in got:
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text)
        offsets = byte_bpe.token_offsets(ids, vocabulary)
        assert offsets[-1] == len(text.encode()) and (np.diff(offsets) > 0).all()


def test_columns_pass_and_clashes_are_refused(docs, vocabulary):
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, vocabulary)
    coded = byte_bpe.encode(docs, vocabulary, out="codes")
    assert coded.columns == [*docs.columns, "codes"]
    assert {r["lang"] for r in coded.select("lang").collect()} == {"en"}


def test_empty(spark, no_docs):
    assert byte_bpe.round_trip(spark, no_docs, PATH).collect() == []
