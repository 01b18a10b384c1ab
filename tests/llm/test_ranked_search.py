import math
import random
import re
from collections import Counter

import pytest
from cases import prose
from pyspark.sql import functions as F

from courtlens.llm import ranked_search
from courtlens.llm.ranked_search import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scored = []
        for i, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // max(n_terms, 1)
            total = 0
            for t, q in Counter(terms(text)).items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    total += q * w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if total > 0:
                scored.append((-total, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def got(docs, items, **options):
    rows = rank_documents(docs, items, **options).collect()
    return sorted([(r["_item_id"], r["rank"], r["_doc_id"], r["score"]) for r in rows], key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, prose(3, 12)), (2, prose(900, 9) + " One, ONE"), (3, "one two words"), (4, None), (5, ""), (6, "nowhere"), (6, prose(7, 4)), (1, prose(3, 12)), (None, prose(8, 5)), (7, prose(66, 3000))]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id bigint, text string, _id string, score int")


def plain(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_odd_cases_by_brute_force(docs, items):
    want = brute(plain(docs, "doc_id", "text"), plain(items, "item_id", "text"))
    assert got(docs, items) == want and len(want) > 60


def test_few_places_many_copies_and_small_blocks(spark, items, monkeypatch):
    monkeypatch.setattr(ranked_search, "CELLS", 40)
    rng = random.Random(5)
    rows = [(rng.randint(0, 500), prose(rng.randint(0, 30), 20)) for _ in range(300)]
    rows += [(i % 7, prose(3, 12)) for i in range(200)] + [(None, prose(3, 12))] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    want = brute(rows, plain(items, "item_id", "text"), top=3)
    assert got(docs, items, top=3) == want
    assert got(docs, items, top=3, block_terms=10) == want


@pytest.mark.parametrize("limit", [ranked_search.EXACT, 0])
def test_a_word_many_times_and_scores_beyond_doubles(spark, monkeypatch, limit):
    monkeypatch.setattr(ranked_search, "EXACT", limit)
    text = "rare " * 400_000
    docs = spark.createDataFrame([(i, "common words only") for i in range(50)] + [(77, "rare find"), (78, "rare")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    rows = got(docs, items)
    assert [r[2] for r in rows] == [78, 77] and rows == brute(plain(docs, "doc_id", "text"), [(1, text)])


def test_a_class_sends_no_more_members_than_places(spark, items):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(prose(3, 12)).alias("text"))
    rows = [r for r in got(docs.repartition(9), items, top=4) if r[0] == 7]
    assert rows == [] or [r[2] for r in rows] == [0, 1, 2, 3]


def test_empty(docs, no_docs, items):
    assert got(no_docs, items) == [] and got(docs, items.limit(0)) == []
