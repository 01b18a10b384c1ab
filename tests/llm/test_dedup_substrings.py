import random

import pytest
from cases import prose

from courtlens.llm.common import keyed
from courtlens.llm.dedup_substrings import SuffixAutomaton, dedup_substrings, repeated_spans


def brute(rows, window=13):
    first = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    for doc, w in split:
        if doc is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1) if doc is not None else []:
            if first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((str(doc), len(w), len(gone), kept))
    return sorted(out)


def result(found):
    return sorted((str(r["_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in found.collect())


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_against_brute_force(docs):
    got = result(dedup_substrings(docs))
    assert got == brute(pairs(docs))
    assert sum(r[2] > 0 for r in got) > 12


@pytest.mark.parametrize("limit", [2, 10_000])
def test_shards_cut_again(spark, limit):
    """A fingerprint in many different passages: its shard is cut by whole windows."""
    core = prose(5, 9)
    rng = random.Random(3)
    rows = [(i, f"{prose(100 + rng.randrange(40), 12)} {core} {prose(200 + rng.randrange(40), 12)}") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(dedup_substrings(frame, shard_passages=limit)) == brute(rows)


def test_overlapping_passages_of_different_documents(spark):
    """No earlier document has the whole passage; two of them have its parts."""
    w = prose(8, 60, vocabulary=5000).split()
    rows = [(1, " ".join(w[:30])), (2, " ".join(["p", *w[18:45], "q"])), (3, " ".join(["r", *w[5:60]]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = result(dedup_substrings(frame))
    assert got == brute(rows) and got[2][2] == 40


def test_carried_rows(docs):
    rows = dedup_substrings(docs, carry=True).filter("n_removed = 0").collect()
    assert rows and all(r["_row"]["lang"] == "en" and r["_row"]["doc_id"] == r["_id"] for r in rows)


def test_automaton_against_substrings():
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(4)]
        automaton = SuffixAutomaton()
        for t in texts:
            automaton.insert(list(t))
        probe = "".join(rng.choice("abc") for _ in range(20))
        want = [
            max(n for n in range(e + 2) if any(probe[e + 1 - n : e + 1] in t for t in texts))
            for e in range(len(probe))
        ]
        assert automaton.matching_statistics(list(probe)) == want


def test_empty(no_docs):
    assert dedup_substrings(no_docs).collect() == []


def test_rows_that_repeat_share_their_spans(spark):
    passage = prose(900, 60)
    rows = [(1, f"{prose(1, 20)} {passage}")] + [(2, f"{passage} {prose(2, 20)}")] * 500 + [(3, prose(3, 40))] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    spans = repeated_spans(keyed(docs, "doc_id", "text"))
    assert [len(r["spans"]) for r in spans.collect()] == [1]
    got = dedup_substrings(docs).groupBy("_id", "n_removed").count().collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 60, 500), (3, 0, 500)]
