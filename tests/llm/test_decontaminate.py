import re

import pytest
from cases import prose

from courtlens.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(rows, items, window=10):
    out = []
    for doc, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, content in items:
            v = words(content)
            n = min(window, len(v))
            wanted = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else []:
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        ids.add(str(item))
        out.append((str(doc), len(w), len(hit), tuple(sorted(ids))))
    return sorted(out)


def result(found):
    rows = found.collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
    return sorted((str(r["_id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)


ITEMS = [
    (1, prose(900, 60)[:150]),
    (2, prose(4, 58)),
    (2, prose(4, 58)),
    (3, "Another TEXT"),
    (4, "same"),
    (5, None),
    (6, " .. "),
    (None, prose(200, 300)),
    (7, " - ".join(prose(901, 14).upper().split())),
    (8, "a b " * 20),
    (9, prose(300, 30_000)[5_000:9_000]),
]


def test_against_brute_force(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = result(decontaminate(docs, items))
    assert got == brute(rows, ITEMS)
    assert sum(r[2] > 0 for r in got) > 10


@pytest.mark.parametrize("start", range(0, 12))
def test_every_shared_run_of_a_window_is_found(spark, start):
    """The guarantee of winnowing, at every offset, for runs of just one window and one less."""
    run = prose(42, 60).split()[start : start + 10]
    items = spark.createDataFrame([(1, " ".join([prose(7, 11), *run, prose(8, 6)]))], "item_id int, text string")
    rows = [(1, " ".join([prose(20, 30), *run, prose(21, 9)])), (2, " ".join([prose(22, 30), *run[1:], "other"]))]
    found = result(decontaminate(spark.createDataFrame(rows, "doc_id int, text string"), items))
    assert [r[2] for r in found] == [10, 0]


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate(no_docs, items).collect() == []
    assert decontaminate(docs, items.limit(0)).filter("n_hit > 0").collect() == []
