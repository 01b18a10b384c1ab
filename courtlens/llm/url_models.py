"""URL filter by rules and by the ratio of two variable-order models over the bytes of whole urls.

Rules decide as in ``url_filter``. Urls without a rule are judged by two character models, one of
the urls that rules allow and one of those they block. A symbol is a byte of the url as it stands
(scheme, host, path, query and fragment, case and digits kept) or the boundary; a context is up to
ORDER symbols, which with the symbol after it is one exact 63-bit code. Smoothing is Witten-Bell at
every length down to none. The log-likelihood difference per symbol must reach a threshold.

* Counts are rows (code, slot, n) that grow with the corpus. Slots are the kinds of rule by host
  fold, and one for urls without a rule, which only ask for a code. The driver sees counts of pairs
  of bytes only, at most 257^2 for each slot; longer contexts are smoothed in tasks, by groups that
  hold all codes with the same two symbols before the last.
* Scores are a join of the urls' codes with the ratios and a sum by url. The HOT codes that most
  places of the urls have are looked up in a broadcast instead, so that none of them is a hot key;
  all others are joined. Ratios are whole numbers of UNIT, so sums do not depend on their order.
* The threshold is calibrated by cross-fitting: urls of a host fold are scored by models from which
  that fold's counts are subtracted. Verdicts come from the models of all urls with a rule.

Defined cases: a null url is an empty string; one without "://" has empty host and path, matches no
rule and is judged by its text; repeated rows are judged alike, and each counts for training;
without urls of both kinds the threshold is 0 and a missing model is uniform, so an empty table
works; other columns are ignored; nothing is cut to a length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import chunks, column, discard, store, text_buffer
from courtlens.llm.url_filter import BIN, BINS, FOLDS, host_of, path_of, rule_of, threshold_of

# With the symbol after it, a context fills 63 bits.
ORDER, BITS = 6, 9
SYMBOLS = 257
FREE = 2 * FOLDS
HOT = 100_000
BUCKETS = 1024
UNIT = 1e-9


def _last(symbols: int) -> int:
    return (1 << (BITS * symbols)) - 1


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all places of all texts, and the row of each; the boundary after a text is a place."""
    data, offsets = text_buffer(batch)
    lengths = np.diff(offsets)
    rows = np.arange(len(lengths))
    padded = np.zeros(len(data) + (ORDER + 1) * len(lengths) + ORDER, np.int64)
    at = np.arange(len(data)) + (ORDER + 1) * np.repeat(rows, lengths) + ORDER
    padded[at] = data.astype(np.int64) + 1
    n = len(padded) - ORDER
    codes = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        codes = (codes << BITS) | padded[i : i + n]
    owner = np.repeat(rows, lengths + ORDER + 1)
    place = np.arange(n) - (offsets[:-1] + (ORDER + 1) * rows)[owner]
    inside = place <= lengths[owner]
    return codes[inside], owner[inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole):
            codes, owner = _codes(batch)
            slots = np.asarray(batch.column("slot"), np.int64)[owner]
            order = np.lexsort((slots, codes))
            codes, slots = codes[order], slots[order]
            new = np.ones(len(codes), bool)
            new[1:] = (codes[1:] != codes[:-1]) | (slots[1:] != slots[:-1])
            heads = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(codes[heads]),
                    pa.array(slots[heads], pa.int32()),
                    pa.array(np.diff(np.append(heads, len(codes)))),
                ],
                ["code", "slot", "n"],
            )


def _models(counts: np.ndarray) -> np.ndarray:
    """Counts by slot as counts of both kinds without each fold, and without none: a row each."""
    by_fold = counts[:FREE].reshape(2, FOLDS, -1)
    total = by_fold.sum(axis=1, keepdims=True)
    return np.concatenate([total - by_fold, total], axis=1).reshape(2 * (FOLDS + 1), -1)


def _sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(groups, v, minlength=n) for v in values])


def _longer(p: np.ndarray, c: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Witten-Bell: a context's own counts, and the shorter context weighed by its kinds."""
    weight = total + kinds
    return np.where(weight > 0, (c + kinds * p) / np.maximum(weight, 1), p)


def short_contexts(codes: np.ndarray, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Probabilities after no and then one symbol: (models, symbol before * SYMBOLS + symbol)."""
    counts = np.zeros((FREE + 1, SYMBOLS * SYMBOLS))
    counts[slots, (codes >> BITS) * SYMBOLS + (codes & _last(1))] = n
    c = _models(counts).reshape(-1, SYMBOLS, SYMBOLS)
    p = np.full((len(c), 1, SYMBOLS), 1 / SYMBOLS)
    for level in (c.sum(axis=1, keepdims=True), c):
        total, kinds = level.sum(axis=2, keepdims=True), (level > 0).sum(axis=2, keepdims=True)
        p = _longer(p, level, total, kinds)
    return p.reshape(len(c), -1)


def _ratios(short):
    """Per code and model that is asked for it: the difference of log-probabilities, and the uses."""

    def run(table: pa.Table) -> pa.Table:
        code, row = np.unique(table["code"].to_numpy(), return_inverse=True)
        counts = np.zeros((FREE + 1, len(code)))
        counts[table["slot"].to_numpy(), row] = table["n"].to_numpy()
        own = _models(counts)
        pair = code & _last(2)
        p = short.value[:, (pair >> BITS) * SYMBOLS + (pair & _last(1))]
        for order in range(2, ORDER + 1):
            grams, gram = np.unique(code & _last(order + 1), return_inverse=True)
            contexts, context = np.unique(grams >> BITS, return_inverse=True)
            c = _sums(own, gram, len(grams))
            total, kinds = (_sums(x, context, len(contexts)) for x in (c, c > 0))
            at = context[gram]
            p = _longer(p, c[:, gram], total[:, at], kinds[:, at])
        blocked, allowed = np.log(p).reshape(2, FOLDS + 1, -1)
        uses = np.concatenate([counts[:FREE].reshape(2, FOLDS, -1).sum(axis=0), counts[FREE:]])
        model, at = np.nonzero(uses)
        units = np.rint((allowed - blocked)[model, at] / UNIT).astype(np.int64)
        return pa.table(
            {
                "code": code[at],
                "model": pa.array(model, pa.int32()),
                "units": units,
                "uses": uses[model, at].astype(np.int64),
            }
        )

    return run


def _split(hot, sums: bool):
    """Per url the sum of its hot codes' ratios, or the codes that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = hot.value
        for whole in batches:
            for batch in chunks(whole):
                codes, owner = _codes(batch)
                uid = np.asarray(batch.column("uid"), np.int64)
                models = np.asarray(batch.column("model"), np.int64)[owner]
                units, known = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
                for model, (keys, values) in enumerate(tables):
                    mine = np.flatnonzero(models == model)
                    if not len(keys) or not len(mine):
                        continue
                    at = np.minimum(np.searchsorted(keys, codes[mine]), len(keys) - 1)
                    hit = keys[at] == codes[mine]
                    units[mine[hit]], known[mine[hit]] = values[at[hit]], True
                if sums:
                    total = np.zeros(len(uid), np.int64)
                    np.add.at(total, owner, units)
                    yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(total)], ["uid", "units"])
                else:
                    rest = np.flatnonzero(~known)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(uid[owner[rest]]),
                            pa.array(codes[rest]),
                            pa.array(models[rest], pa.int32()),
                        ],
                        ["uid", "code", "model"],
                    )

    return run


def judge_whole_urls(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(_id, host, path, rule, score, verdict) per row; score is null where a rule decides."""
    spark = pages.sparkSession
    share = spark.sparkContext.broadcast
    url = column(pages, url_col)
    rows = pages.select(
        column(pages, id_col).alias("_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.coalesce(url, F.lit("")).alias("_text"),
    )
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")
    free = F.col("rule").isNull()
    rows = store(
        rows.withColumn("_fit", rule_of(F.col("host"), F.col("path"), rules)).select(
            F.monotonically_increasing_id().alias("uid"),
            "_id",
            "host",
            "path",
            F.col("_fit.rule").alias("rule"),
            F.col("_fit.verdict").alias("ruled"),
            "_text",
        ),
        "urls",
    )
    # A url with a rule is scored by the models without its fold.
    table = rows
    rows = rows.withColumn("model", F.when(free, FOLDS).otherwise(fold))
    allowed = (F.col("ruled") == "allow").cast("int")
    slot = F.when(free, FREE).otherwise(allowed * FOLDS + fold).alias("slot")
    counts = store(
        rows.select("_text", slot)
        .mapInArrow(_count, "code bigint, slot int, n bigint")
        .groupBy("code", "slot")
        .agg(F.sum("n").alias("n")),
        "counts",
    )
    pairs = (
        counts.groupBy(F.col("code").bitwiseAND(F.lit(_last(2))).alias("code"), "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    short = share(short_contexts(*(pairs[c].to_numpy() for c in ("code", "slot", "n"))))
    before = F.shiftright("code", BITS).bitwiseAND(F.lit(_last(2)))
    ratios = store(
        counts.withColumn("bucket", F.pmod(F.xxhash64(before), F.lit(BUCKETS)))
        .groupBy("bucket")
        .applyInArrow(_ratios(short), "code bigint, model int, units bigint, uses bigint"),
        "ratios",
    )
    discard(counts)
    top = ratios.orderBy(F.col("uses").desc(), "code", "model").limit(HOT).toArrow().sort_by("code")
    code, model, units = (top[c].to_numpy() for c in ("code", "model", "units"))
    hot = share([(code[model == m], units[model == m]) for m in range(FOLDS + 1)])
    texts = rows.select("uid", "_text", "model")
    sums = texts.mapInArrow(_split(hot, True), "uid bigint, units bigint")
    rest = texts.mapInArrow(_split(hot, False), "uid bigint, code bigint, model int")
    joined = rest.join(ratios, ["code", "model"]).select("uid", "units")
    scores = sums.union(joined).groupBy("uid").agg(F.sum("units").alias("units"))
    scored = store(
        rows.join(scores, "uid").withColumn(
            "score", F.col("units") * F.lit(UNIT) / (F.octet_length("_text") + 1)
        ),
        "scored",
    )
    binned = (
        scored.filter(~free)
        .select(
            F.least(
                F.greatest(F.floor(F.col("score") / BIN) + BINS // 2, F.lit(0)), F.lit(BINS - 1)
            ).alias("bin"),
            (F.col("ruled") == "allow").alias("allowed"),
        )
        .groupBy("bin", "allowed")
        .count()
        .collect()
    )
    discard(table, ratios)
    threshold = threshold_of([(r["bin"], r["allowed"], r["count"]) for r in binned])
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(
        "_id",
        "host",
        "path",
        "rule",
        F.when(free, F.col("score")).alias("score"),
        F.coalesce("ruled", method).alias("verdict"),
    )
