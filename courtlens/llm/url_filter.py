"""URL filter by rules and by the ratio of two character language models.

The longest rule whose host is the url's host or a parent domain, and whose path begins the url's
path, decides. Urls without a rule are judged by two smoothed variable-order Markov models over
host and path, one of the urls that rules allow and one of those they block: the log-likelihood
difference per character must reach a threshold, calibrated on hosts that the models did not see.

* Training counts 4-grams of a fixed alphabet of SYMBOLS classes over the urls with a rule whose
  hosts do not calibrate (one fold of FOLDS is left out for good; ``url_models``, which the query
  uses, judges by all urls with a rule), in arrays per task, added up by one aggregate. Shorter contexts are sums of these. Both models have
  at most SYMBOLS^4 entries however many urls there are, which bounds what reaches the driver and
  every task.
* Smoothing is Witten-Bell: a context's own counts, and the next shorter context weighed by the
  number of different characters seen after it.

Defined cases: a null url and one without "://" have empty host and path, match no rule and are
judged as an empty string; repeated rows are judged alike, and each counts for training; without
urls of both kinds the threshold is 0 and a missing model is uniform, so an empty table works;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import column, text_buffer

ORDER = 3
# One url in FOLDS hosts calibrates and does not train.
FOLDS = 5
# Scores are binned for calibration.
BIN, BINS = 0.005, 4001

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Alphabet: boundary 0, letters, digits as one class, marks, everything else.
_MARKS = "./-_?=&%#+:~"
SYMBOLS = 1 + 26 + 1 + len(_MARKS) + 1


def _classes() -> np.ndarray:
    table = np.full(256, SYMBOLS - 1, np.int64)
    for i in range(26):
        table[97 + i] = table[65 + i] = 1 + i
    table[48:58] = 27
    for i, mark in enumerate(_MARKS):
        table[ord(mark)] = 28 + i
    return table


# ---- rules ------------------------------------------------------------------


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), null if none fits.

    Rules are (verdict, text), the text a host followed by a path that begins with a slash.
    """
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, found).otherwise(fitting)
    return fitting


# ---- models -----------------------------------------------------------------


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """4-gram codes of all texts, and the text of each; ORDER boundaries before, one after."""
    data, offsets = text_buffer(batch)
    lengths = np.diff(offsets)
    texts = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.zeros(len(data) + (ORDER + 1) * len(lengths) + ORDER, np.int64)
    padded[np.arange(len(data)) + (ORDER + 1) * texts + ORDER] = _classes()[data]
    n = len(padded) - ORDER
    codes = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        codes = codes * SYMBOLS + padded[i : i + n]
    owner = np.repeat(np.arange(len(lengths)), lengths + ORDER + 1)
    # Of each text, the grams that end inside it or on its closing boundary.
    place = np.arange(n) - np.repeat(offsets[:-1] + (ORDER + 1) * np.arange(len(lengths)), lengths + ORDER + 1)
    inside = place <= np.repeat(lengths, lengths + ORDER + 1)
    return codes[inside], owner[inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    for batch in batches:
        codes, owner = _codes(batch)
        allowed = np.asarray(batch.column("allowed").cast(pa.int8()), np.int64)[owner]
        for kind in (0, 1):
            found, counts = np.unique(codes[allowed == kind], return_counts=True)
            totals[kind, found] += counts
    for kind in (0, 1):
        found = np.flatnonzero(totals[kind])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), kind, np.int32)), pa.array(found), pa.array(totals[kind, found])],
            ["kind", "code", "n"],
        )


def witten_bell(counts: np.ndarray) -> np.ndarray:
    """Log-probability of every 4-gram's last symbol after the symbols before it."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        c = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0).astype(float)
        kinds = (c > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(p.reshape(-1, SYMBOLS), (c.shape[0] // max(1, p.size // SYMBOLS), 1))
        weight = c.sum(axis=1, keepdims=True) + kinds
        p = np.where(weight > 0, (c + kinds * shorter) / np.maximum(weight, 1), shorter)
    return np.log(p).reshape(-1)


def _score(ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratio.value
        for batch in batches:
            codes, owner = _codes(batch)
            total = np.bincount(owner, table[codes], minlength=batch.num_rows)
            length = np.bincount(owner, minlength=batch.num_rows)
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(total / length)], [*names, "score"])

    return run


def threshold_of(bins: list[tuple[int, bool, int]]) -> float:
    """The threshold with the best mean of both kinds' accuracy, nearest to 0 on ties.

    ``bins`` holds (bin, allowed, urls); 0 if one kind is missing.
    """
    hist = np.zeros((2, BINS))
    for at, allowed, n in bins:
        hist[int(allowed), at] += n
    if not hist.sum(axis=1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(hist, axis=1)], axis=1)
    share = below / hist.sum(axis=1, keepdims=True)
    good = share[0] + 1 - share[1]
    best = np.flatnonzero(good == good.max())
    edges = (best - BINS // 2) * BIN
    return float(edges[np.argmin(np.abs(edges))])


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(_id, host, path, rule, score, verdict) per row; score is null where a rule decides."""
    spark = pages.sparkSession
    url = column(pages, url_col)
    rows = pages.select(
        column(pages, id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    rows = rows.withColumn("_fit", rule_of(F.col("host"), F.col("path"), rules)).select(
        "_id",
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.col("_fit.verdict").alias("ruled"),
        F.concat("host", "path").alias("_text"),
    )
    known = rows.filter("rule IS NOT NULL").select(
        "_text",
        (F.col("ruled") == "allow").alias("allowed"),
        (F.pmod(F.xxhash64("host"), F.lit(FOLDS)) == 0).alias("calibrates"),
    )
    counted = (
        known.filter("NOT calibrates")
        .mapInArrow(_count, "kind int, code bigint, n bigint")
        .groupBy("kind", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    counts[counted["kind"].to_numpy(), counted["code"].to_numpy()] = counted["n"].to_numpy()
    ratio = (witten_bell(counts[1]) - witten_bell(counts[0])).astype(np.float32)
    scorer = _score(spark.sparkContext.broadcast(ratio))
    binned = (
        known.filter("calibrates")
        .mapInArrow(scorer, "_text string, allowed boolean, calibrates boolean, score double")
        .select(
            F.least(
                F.greatest(F.floor(F.col("score") / BIN) + BINS // 2, F.lit(0)), F.lit(BINS - 1)
            ).alias("bin"),
            "allowed",
        )
        .groupBy("bin", "allowed")
        .count()
        .collect()
    )
    threshold = threshold_of([(r["bin"], r["allowed"], r["count"]) for r in binned])
    kind = rows.schema["_id"].dataType.simpleString()
    scored = rows.mapInArrow(
        scorer,
        f"_id {kind}, host string, path string, rule string, ruled string, _text string, score double",
    )
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(
        "_id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
        F.coalesce("ruled", method).alias("verdict"),
    )
