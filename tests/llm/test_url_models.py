import math
import random

import pytest
import xxhash
from test_url_filter import ODD, rule, split

from courtlens.llm import url_filter, url_models
from courtlens.llm.queries import RULES


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "x", "x") for i, u in enumerate(ODD)] + [(0, None, "x", "x")]
    pages = spark.createDataFrame(rows, "page_id int, url string, host string, score string")
    got = url_models.judge_whole_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = split(ODD[r["_id"]])
        fit = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit and fit[0])
        assert r["verdict"] == fit[1] if fit else r["verdict"] in ("allow", "block")


def slow_model(urls):
    """Witten-Bell estimates from dictionaries of contexts of bytes."""
    order, seen = url_models.ORDER, {}

    def symbols(u):
        return [0] * order + [b + 1 for b in u.encode()] + [0]

    for s in map(symbols, urls):
        for i in range(order, len(s)):
            for n in range(order + 1):
                context = seen.setdefault(tuple(s[i - n : i]), {})
                context[s[i]] = context.get(s[i], 0) + 1

    def p(symbol, context):
        shorter = p(symbol, context[1:]) if context else 1 / 257
        known = seen.get(tuple(context), {})
        if not known:
            return shorter
        return (known.get(symbol, 0) + len(known) * shorter) / (sum(known.values()) + len(known))

    def score(u):
        s = symbols(u)
        return sum(math.log(p(s[i], s[i - order : i])) for i in range(order, len(s)))

    return score


def fold(url):
    h = xxhash.xxh64_intdigest(split(url)[0].encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % url_filter.FOLDS


def made_urls():
    rng = random.Random(4)

    def word():
        return "".join(rng.choice("aeiourstnéж") for _ in range(rng.randint(2, 7)))

    urls = [f"http://{word()}.com/{word()}/{rng.randint(1, 999)}" for _ in range(90)]
    urls += [f"http://{word()}.net/es/{word()}?q=casino-{word()}#{word()}" for _ in range(60)]
    urls += [f"http://{word()}.org/{word()}{rng.choice(['?q=casino-', '?q=', ''])}{word()}" for _ in range(40)]
    return urls + ["http://B.org/1?Q=7", "", "no scheme"]


# HOT 50: most codes go through the join.
@pytest.mark.parametrize("hot", [50, url_models.HOT])
def test_scores_against_dictionaries(spark, monkeypatch, hot):
    monkeypatch.setattr(url_models, "HOT", hot)
    urls = made_urls()
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").repartition(3)
    got = url_models.judge_whole_urls(pages, RULES).collect()
    assert len(got) == len(urls)
    known = {v: [u for u in urls if (r := rule(*split(u))) and r[1] == v] for v in ("allow", "block")}

    def ratio(f):
        good, bad = (slow_model([u for u in known[v] if fold(u) != f]) for v in ("allow", "block"))
        return lambda u: (good(u) - bad(u)) / (len(u.encode()) + 1)

    score = ratio(None)
    for r in got:
        if r["rule"] is None:
            assert r["score"] == pytest.approx(score(urls[r["_id"]]), abs=1e-6)
    by_fold = [ratio(f) for f in range(url_filter.FOLDS)]
    bins = [
        (math.floor(by_fold[fold(u)](u) / url_filter.BIN) + url_filter.BINS // 2, v == "allow", 1)
        for v in known
        for u in known[v]
    ]
    threshold = url_filter.threshold_of(bins)
    for r in got:
        if r["rule"] is None:
            assert r["verdict"] == ("allow" if r["score"] >= threshold else "block")


def test_query_digits_and_other_letters_are_told_apart(spark):
    """The query, single digits and non-Latin letters, none of which the folded classes could see."""
    urls = [f"http://a{i}.com/x?q={w}" for i in range(12) for w in ("good", "7777", "добро")]
    urls += [f"http://a{i}.net/es/x?q={w}" for i in range(12) for w in ("evil", "3333", "вредн")]
    asked = {f"http://b.org/x?q={w}": v for v, ws in (("allow", ("good", "7777", "добро")), ("block", ("evil", "3333", "вредн"))) for w in ws}
    pages = spark.createDataFrame(list(enumerate([*urls, *asked])), "page_id int, url string")
    got = {r["_id"]: r for r in url_models.judge_whole_urls(pages, RULES).collect()}
    scores = {v: [got[len(urls) + i]["score"] for i, u in enumerate(asked) if asked[u] == v] for v in ("allow", "block")}
    assert min(scores["allow"]) > max(scores["block"])


def test_the_only_blocked_host_is_learned_in_every_fold(spark):
    """With one fold left out for good, one of these hosts would never have been seen."""
    for f in range(url_filter.FOLDS):
        host = next(h for i in range(500) if fold(f"http://{(h := f'b{i}.net')}/") == f)
        urls = [f"http://a{i}.com/page/{i}" for i in range(20)]
        urls += [f"http://{host}/es/casino/{i}" for i in range(10)]
        urls += ["http://c.org/es/casino/3", "http://c.org/page/3"]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
        score = {r["_id"]: r["score"] for r in url_models.judge_whole_urls(pages, RULES).collect()}
        assert score[30] < 0 < score[31]


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    assert url_models.judge_whole_urls(pages, RULES).collect() == []
