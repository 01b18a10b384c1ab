"""Features, weights and scores of plain texts, from their definitions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtlens.llm import toxicity

PREFIXES, LONG = (3, 4, 5, 6, 7, 8), 5


def vocabulary(n):
    """Words of letters without any other reading: no letter twice in a row."""
    rng, out = random.Random(2), set()
    while len(out) < n:
        word = ""
        for _ in range(rng.randint(3, 11)):
            word += rng.choice([c for c in "abdefgikmnoprtuv" if c != word[-1:]])
        out.add(word)
    return sorted(out)


def features(text):
    """Per word: its features as (kind, text) with whether they are long."""
    for word in text.lower().split():
        yield [(("word", word), True)] + [(("start", word[:n]), n >= LONG) for n in PREFIXES if len(word) > n]


@pytest.fixture(scope="module")
def labelled(spark):
    rng, words = random.Random(7), vocabulary(400)
    toxic = words[:6]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words[6:]) for _ in range(rng.randint(1, 30))]
        if i % 3 == 0:
            text[rng.randrange(len(text))] = rng.choice(toxic)
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in text)))
        if i % 10:
            labels.append((i, int(i % 3 == 0) if rng.random() < 0.97 else 1))
    rows += [(2000, ""), (2001, None), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return rows, labels, docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_scores_by_brute_force(spark, labelled):
    rows, labels, docs, label_frame = labelled
    ids = spark.createDataFrame([(i,) for i, _ in labels], "i bigint")
    fits = {r["i"]: r["f"] for r in ids.select("i", (F.pmod(F.xxhash64("i", F.lit("fit")), F.lit(toxicity.FIT)) == 0).alias("f")).collect()}
    train = {i: t for i, t in labels if zlib.crc32(str(i).encode()) % 5}
    bad, good = Counter(), Counter()
    for i, text in rows:
        if i in train and not fits[i]:
            seen = {f for word in features(text or "") for f, _ in word}
            (bad if train[i] else good).update(seen)
    kept = {f: n for f, n in bad.items() if n >= toxicity.MIN_ROWS}
    weight = {f: float(toxicity.wilson(np.array([n]), np.array([good[f]]))[0]) for f, n in kept.items()}

    def measures(text):
        best = short = heavy = 0
        for word in features(text or ""):
            known = [(weight[f], long) for f, long in word if f in weight]
            best = max([best, *[w for w, long in known if long]])
            short = max([short, *[w for w, long in known if not long]])
            heavy += any(long and w >= toxicity.HEAVY for w, long in known)
        return best, short, heavy

    found = {i: measures(text) for i, text in rows}
    fitting = [(found[i], train[i]) for i, _ in rows if i in train and fits[i]]
    x = toxicity._inputs(*(np.array(c, float) for c in zip(*[m for m, _ in fitting])))
    w = toxicity.fit_logistic(x, np.array([t for _, t in fitting], float))
    got = toxicity.score_toxicity(docs, label_frame).collect()
    assert len(got) == len(rows) and len(weight) > 10 and any(m[2] for m in found.values())
    for r in got:
        best, short, heavy = found[r["_id"]]
        want = 1 / (1 + np.exp(-(toxicity._inputs(*(np.array([float(v)]) for v in (best, short, heavy))) @ w)))[0]
        assert r["score"] == pytest.approx(want, abs=1e-9), r["_id"]
        assert r["predicted"] == int(want >= 0.5) and r["held_out"] == (zlib.crc32(str(r["_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["_id"] < 900]
    assert sum((r["predicted"] == 1) == (r["_id"] % 3 == 0) for r in held) > 0.95 * len(held)


def test_counts_do_not_depend_on_how_tasks_hand_them_on(spark, labelled, monkeypatch):
    _, _, docs, label_frame = labelled
    want = {r["_id"]: r["score"] for r in toxicity.score_toxicity(docs, label_frame).collect()}
    monkeypatch.setattr(toxicity, "TASK_FEATURES", 50)
    again = toxicity.score_toxicity(docs.repartition(2), label_frame)
    assert {r["_id"]: r["score"] for r in again.collect()} == pytest.approx(want, abs=1e-12)


def test_very_long_texts(spark, labelled):
    rows, _, docs, label_frame = labelled
    hot = rows[0][1].split()
    plain = " ".join(vocabulary(400)[6:]) + " "
    long = spark.createDataFrame([(5000, plain * 150), (5001, plain * 150 + " ".join(hot)), (5002, "a.b" * 200_000)], "doc_id bigint, text string")
    got = {r["_id"]: r["predicted"] for r in toxicity.score_toxicity(docs.unionByName(long), label_frame).collect() if r["_id"] >= 5000}
    assert set(got) == {5000, 5001, 5002} and got[5001] == 1
