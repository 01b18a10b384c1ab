"""Invented texts for the tests of this folder."""

import random

# Columns of the documents table, and others whose names the operators use inside.
EXTRA = "lang string, source string, n_chars bigint, _id string, _h string, _text string, shard string, code string, spans string, score string, ids string"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Words of a small invented vocabulary, some beyond ASCII."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnoprstuvéñö"
    pool = random.Random(1)
    known = ["".join(pool.choice(letters) for _ in range(pool.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(rng.choice(known) for _ in range(words))


def edge_rows() -> list[tuple]:
    """(doc_id, text): ordinary texts, copies, near copies, shared passages and every odd case."""
    passage, line = prose(900, 60), prose(901, 14)
    rows = [(i, prose(i, 30 + 7 * i)) for i in range(1, 13)]
    rows += [(20 + i, f"{prose(50 + i, 25)} {passage} {prose(70 + i, 25)}") for i in range(6)]
    rows += [(30 + i, f"{prose(80 + i, 5)}\n{line}\t{prose(95 + i, 3)}") for i in range(8)]
    rows += [(40 + i, prose(3, 51)) for i in range(5)]
    rows += [(50 + i, prose(200, 300) + f" tail{i}") for i in range(5)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (63, "one"), (64, "Two words"), (65, "...!?")]
    rows += [(66, prose(300, 30_000)), (67, "x" * 70_000), (68, "a b " * 9_000)]
    rows += [(69, "  Leading, and\xa0odd spaces\x0b here\x1c \r\n"), (70, "\U0001f600 é́ 中文字 \x00 end")]
    rows += [(7, prose(7, 79)), (7, prose(7, 79)), (8, "another text of the same id")]
    rows += [(None, prose(5, 65)), (None, prose(900, 60)), (None, None)]
    return rows
