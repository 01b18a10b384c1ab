import hashlib

import pytest
from cases import prose
from pyspark.sql import functions as F

from courtlens.llm import lempel_ziv


def slow_print(text):
    """The fingerprint by phrases kept as strings."""
    phrases, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in phrases:
            phrases.add(text[start:end])
            start = end
    hashes = set()
    for phrase in phrases:
        h = 0
        for c in phrase:
            h = (h * lempel_ziv.MULTIPLIER + ord(c) + 1) % (1 << 60)
        hashes.add(h)
    return lempel_ziv.signature(lempel_ziv.minima(hashes))


def want(rows):
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [slow_print(t) for t in (text, edited, following)]
        out.append(
            (
                str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1],
                lempel_ziv.likeness(prints[0], prints[1]), lempel_ziv.likeness(prints[0], prints[2]),
            )
        )
    return sorted(out)


@pytest.mark.parametrize("range_rows", [5, 10_000])
def test_against_brute_force(docs, range_rows):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    found = lempel_ziv.fingerprint_documents(docs, range_rows=range_rows).collect()
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in found)
    assert got == want(rows)


def test_one_row_follows_itself(spark):
    one = spark.createDataFrame([(3, "abcabcabd")], "doc_id int, text string")
    row = lempel_ziv.fingerprint_documents(one).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 9


def test_likeness_follows_what_is_shared():
    base = prose(1, 800, vocabulary=3000)
    like = [
        lempel_ziv.likeness(lempel_ziv.fingerprint(base), lempel_ziv.fingerprint(base[:cut] + prose(2, 800, 3000)))
        for cut in (len(base), len(base) * 3 // 4, len(base) // 2, 0)
    ]
    assert like == sorted(like, reverse=True) and like[0] > like[-1] + 0.2
    assert lempel_ziv.likeness(lempel_ziv.fingerprint(base), lempel_ziv.fingerprint(base)) == 1.0


def test_long_texts_do_not_meet_by_chance():
    """Minima of many phrases are small numbers; their kept bits must still differ."""
    a = "".join(chr(0x4E00 + i * i % 20_000) for i in range(40_000))
    b = "".join(chr(0xAC00 + i * i % 11_000) for i in range(40_000))
    assert lempel_ziv.likeness(lempel_ziv.fingerprint(a), lempel_ziv.fingerprint(b)) < 0.05


def test_empty(no_docs):
    assert lempel_ziv.fingerprint_documents(no_docs).collect() == []


def test_null_and_empty_texts_are_alike(docs):
    rows = lempel_ziv.fingerprint_documents(docs.filter(F.col("doc_id").isin(60, 61))).collect()
    assert [(r["near_edited"], r["near_next"], r["n_chars"]) for r in rows] == [(1.0, 1.0, 0)] * 2
