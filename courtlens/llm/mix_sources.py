"""Mixing sources to target weights, in DataFrame operations only.

The documents of a source, by identifier, are one stream of words, packed into blocks of
``block_words`` (the last block of a source may be shorter). The mix is a row of shards of
``shard_blocks`` slots; a slot takes one block:

1. Targets. Sources in code-point order (null last) take the given weights in turn and share
   ``share`` times the words of all sources. No target exceeds ``cap`` times its source; what goes
   beyond is shared again by weight until no target is above. A target becomes a whole number of
   slots, so that the words taken are within half a block of it.
2. Counts. Each shard draws how many of its slots every source gets: a multinomial draw from the
   slots of all sources, none put back, so that the sources' totals come out as planned. The draw
   deals the numbered slots of all sources to places by a pseudorandom permutation.
3. Slots. A source's slots are numbered through all shards. Slot j takes the block that a permutation
   of the source's own gives to j modulo the number of blocks: all blocks once, then again. The short
   last block of a source is the last of every round, so that any other part of one has whole blocks.
4. Blocks are joined with slots by (source, block).

As slots are whole rounds and part of one, and ``cap`` is at most a whole number of rounds, no block
is taken more than ``cap`` times, and so no document.

The permutations are swap-or-not networks over exactly as many values as needed: whole-number
arithmetic inside one projection, no shuffle and no sort. Running totals (of words before a
document, of slots before a shard) are added up in two steps, inside ranges of rows and over the
ranges, so that a source holding most rows is many ranges. Rows that repeat in full travel as one
row with a count until they are unfolded, in pieces of bounded size.

Everything is fixed by the rows and ``seed``; neither the layout of the files nor the number of
partitions changes the result.

Defined results: a null or empty text has size 0 and takes nothing; rows that repeat are documents of
their own; a null source is a source; rows of one identifier are ordered by size and text; an empty
table has no rows. Other columns are never read.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlens.llm.common import column, discard, store, unfolded
from courtlens.operators.small_tables import join_small

# Shards of one range of running totals.
RANGE = 4096
ROUNDS = 8

# The modulus of the arithmetic, multipliers, and the characters between words.
P = (1 << 31) - 1
PRIMES = (1_000_003, 1_000_033, 1_000_037)
WORD = r"[^\x20\x09-\x0D]+"


def permutation(x: str, n: str, key: str, seed: int, salt: str) -> list[list[str]]:
    """Steps of select expressions of a permutation of 0 .. n-1; the last gives ``{salt}_x{ROUNDS}``.

    First a multiple of x modulo n, by a prime that does not divide n, then a swap-or-not network:
    round r pairs x with (k - x) modulo n, and a bit that both of a pair share decides whether they
    change places. ``x``, ``n`` and ``key`` are column names; key < 2^31 and n < 2^43. (More rounds
    make the generated method too long for the JVM to compile.)
    """
    draw = random.Random(f"{seed}/{salt}")
    start = f"({key} * 40014 + {draw.randrange(P)}) % {P} AS {salt}_u"
    first, second, third = PRIMES
    prime = f"CASE WHEN {n} % {first} <> 0 THEN {first} WHEN {n} % {second} <> 0 THEN {second} ELSE {third} END"
    steps = [[start], [f"({x} * {prime} + {salt}_u) % {n} AS {salt}_x0"]]
    for r in range(ROUNDS):
        a, b, c, d, e, f = (draw.randrange(1, P) for _ in range(6))
        old, h, k, y, m, t = (f"{salt}_{v}{r}" for v in "xhkymt")
        steps.append(
            [
                f"({salt}_u * {a} + {b}) % {P} AS {h}",
                f"({h} * {h} + {c}) % {n} AS {k}",
                f"({k} + {n} - {old}) % {n} AS {y}",
                f"greatest({old}, {y}) AS {m}",
                f"(({m} % {P}) * {d} + (({m} div {P}) % 65536) * {e} + {h}) % {P} AS {t}",
                f"IF((({t} * {t} + {f}) % {P}) div 1024 % 2 = 1, {y}, {old}) AS {salt}_x{r + 1}",
            ]
        )
    return steps


def permuted(rows: DataFrame, name: str, x: str, n: str, key: str, seed: int, salt: str) -> DataFrame:
    """``rows`` with column ``name``: where the permutation takes ``x``."""
    columns = rows.columns
    for r, step in enumerate(permutation(x, n, key, seed, salt)):
        carried = [f"{salt}_u"][:r] + [f"{salt}_x{r - 2}"][: r - 1]
        rows = rows.selectExpr(*columns, *carried, *step)
    return rows.selectExpr(*columns, f"{salt}_x{ROUNDS} AS {name}")


def running_total(rows: DataFrame, value: Column, order: list, keys: tuple[str, ...] = ()) -> Column:
    """``rows`` with _before: ``value`` summed over the rows before, within equal ``keys``.

    _part numbers ranges of rows whose numbers ascend with ``order``; only one total of each range
    meets the other ranges' totals.
    """
    before = (Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*keys, F.lit(0)).orderBy("_part").rowsBetween(*before)
    ahead = totals.select(*keys, "_part", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_ahead"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(*before))
    return (
        rows.join(ahead, [*keys, "_part"])
        .withColumn("_before", F.col("_ahead") + F.coalesce(inside, F.lit(0)))
        .drop("_ahead")
    )


def target_level(sources: DataFrame, share: tuple[int, int], cap: int) -> float:
    """Words for each unit of weight, once what exceeds the caps has been shared again."""
    total = share[0] / share[1] * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= cap * F.col("source_size")
        fixed, free, n = sources.agg(
            F.coalesce(F.sum(F.when(above, cap * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if n == capped or not free:
            return level
        level, capped = (total - fixed) / free, n


@dataclass
class Mix:
    """The result: documents with what is taken of them, sources, shard counts and slots with spans.

    documents: _id, _source, size, source_size, target, taken.
    sources: _source, source_number, source_size, weight, target, blocks, slots.
    counts: shard, source_number, n.
    spans: shard, source_number, slot, block, start (in the block), _id, _h (hash of the text), first
    (word of the text), words. A slot takes one block, so it has one span for each document in it.
    """

    documents: DataFrame
    sources: DataFrame
    counts: DataFrame
    spans: DataFrame
    tables: list[DataFrame]


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    block_words: int = 64,
    shard_blocks: int = 65_536,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    text = F.coalesce(column(docs, text_col), F.lit(""))
    source = column(docs, source_col)
    folded = docs.select(
        column(docs, id_col).alias("_id"),
        source.isNull().alias("_none"),
        F.coalesce(source, F.lit("")).alias("_name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("_h"),
    )
    folded = folded.groupBy("_none", "_name", "_id", "size", "_h").agg(F.count("*").alias("copies"))
    order = [F.col("_id").asc_nulls_last(), "size", "_h"]
    folded = store(
        folded.repartitionByRange("_none", "_name", *order).withColumn("_part", F.spark_partition_id()), "folded"
    )

    # Sources, numbered, with their targets.
    totals = folded.groupBy("_none", "_name").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranged = totals.repartitionByRange("_none", "_name").withColumn("_part", F.spark_partition_id())
    ranged = store(ranged, "sources")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_number") % len(weights) + 1).cast("int"))
    numbered = running_total(ranged, F.lit(1).cast("long"), ["_none", "_name"]).withColumnRenamed("_before", "source_number")
    numbered = store(numbered.withColumn("weight", turn), "numbered")
    level = target_level(numbered, share, cap)
    sources = _with_slots(numbered, level, cap, block_words)
    sources = running_total(sources, F.col("slots"), ["source_number"]).withColumnRenamed("_before", "ahead")
    sources = store(sources.drop("_part"), "targets")
    discard(ranged, numbered)

    # Documents at their places in the streams.
    near = sources.select("_none", "_name", "source_number", "source_size", "target", "blocks")
    placed = join_small(folded, near, ["_none", "_name"])
    placed = running_total(placed, F.col("size") * F.col("copies"), order, ("source_number",))
    n_docs = folded.agg(F.sum("copies")).first()[0] or 0
    each = unfolded(placed.drop("_part", "_name"), "copies", "copy", n_docs).withColumn(
        "start", F.col("_before") + F.col("copy") * F.col("size")
    )
    each = store(each.drop("_before", "copies", "copy"), "placed")

    counts, slots = _slots(sources, shard_blocks, seed)
    spans = _spans(each, slots, block_words)
    taken = spans.groupBy("source_number", "_document").agg(F.sum("words").alias("taken"))
    documents = each.withColumn("_document", F.when(F.col("size") > 0, F.col("start"))).join(
        taken, ["source_number", "_document"], "left"
    )
    names = sources.select("source_number", F.when(~F.col("_none"), F.col("_name")).alias("_source"))
    documents = join_small(documents, names, ["source_number"]).select(
        "_id", "_source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
    shown = sources.select(
        F.when(~F.col("_none"), F.col("_name")).alias("_source"),
        "source_number", "source_size", "weight", "target", "blocks", "slots",
    )
    return Mix(documents, shown, counts, spans.drop("_document"), [folded, sources, each, counts, slots])


def _with_slots(sources: DataFrame, level: float, cap: int, block_words: int) -> DataFrame:
    """Targets in words and in slots: whole rounds take every block, and the rest is rounded to blocks."""
    size = F.col("source_size")
    above = F.col("weight") * F.lit(level) >= cap * size
    sources = sources.withColumns(
        {
            "target": F.when(above, cap * size.cast("double")).otherwise(F.col("weight") * F.lit(level)),
            "blocks": F.expr(f"(source_size + {block_words - 1}) div {block_words}"),
            "full": F.expr(f"source_size div {block_words}"),
        }
    ).withColumn("_rounds", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long"))
    rest = F.col("target") - F.col("_rounds") * size
    # The short last block comes after the full ones: it takes part if more than half of it is due.
    last = (rest - F.col("full") * block_words) * 2 >= size - F.col("full") * block_words
    more = F.when(last, F.col("blocks")).otherwise(
        F.least(F.col("full"), F.floor(rest / block_words + 0.5).cast("long"))
    )
    slots = F.when(size > 0, F.col("_rounds") * F.col("blocks") + more).otherwise(F.lit(0).cast("long"))
    return sources.withColumn("slots", slots).drop("_rounds")


def _slots(sources: DataFrame, shard_blocks: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Drawn counts (shard, source_number, n), and slots (shard, source_number, slot, block)."""
    near = sources.filter("slots > 0").select("source_number", "slots", "ahead", "blocks", "full")
    total = near.agg(F.sum("slots")).first()[0] or 1
    # Numbered slots of all sources, dealt to places; a shard is a run of places.
    dealt = unfolded(near, "slots", "number", total).selectExpr(
        "source_number", f"{total}L AS n_all", "0L AS no_key", "ahead + number AS ticket"
    )
    dealt = permuted(dealt, "at", "ticket", "n_all", "no_key", seed, "deal")
    counts = dealt.groupBy(F.expr(f"at div {shard_blocks}").alias("shard"), "source_number").agg(
        F.count("*").alias("n")
    )
    counts = store(counts, "counts")
    first = running_total(
        counts.withColumn("_part", F.expr(f"shard div {RANGE}")), F.col("n"), ["shard"], ("source_number",)
    )
    rows = unfolded(join_small(first, near.drop("slots", "ahead"), ["source_number"]).drop("_part"), "n", "number", total)
    rows = rows.selectExpr(
        "shard", "source_number", "_before + number AS slot", "full", "greatest(full, 1L) AS n_full",
        "(_before + number) % blocks AS place", f"source_number % {P} AS _key",
    )
    rows = permuted(rows, "there", "place", "n_full", "_key", seed, "at")
    rows = rows.withColumn("block", F.expr("IF(place < full, there, place)"))
    # Written, as the planner would carry what it infers through every round into the join.
    return counts, store(rows.select("shard", "source_number", "slot", "block"), "slots")


def _spans(placed: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    """Slots joined with the pieces of documents in their blocks; _document is where a document starts."""
    rows = placed.filter("size > 0").selectExpr("source_number", "_id", "_h", "size", "start AS _document")
    last = f"(_document + size - 1) div {block_words}"
    pieces = rows.withColumn("block", F.explode(F.expr(f"sequence(_document div {block_words}, {last})"))).selectExpr(
        "source_number", "block", "_document", "_id", "_h",
        f"greatest(block * {block_words}, _document) - _document AS first",
        f"greatest(block * {block_words}, _document) - block * {block_words} AS start",
        f"least((block + 1) * {block_words}, _document + size) - greatest(block * {block_words}, _document) AS words",
    )
    return slots.join(pieces, ["source_number", "block"])


def block_texts(spans: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, source_number, slot, block, text): words of every slot of the mix, joined by one space."""
    text = F.coalesce(column(docs, text_col), F.lit(""))
    texts = docs.select(
        column(docs, id_col).alias("_id"),
        F.xxhash64(text).alias("_h"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("all"),
    ).dropDuplicates(["_id", "_h"])
    left, right = spans.alias("s"), texts.alias("t")
    joined = left.join(right, F.expr("s._id <=> t._id AND s._h = t._h"))
    part = F.struct("start", F.array_join(F.expr("slice(all, CAST(first AS INT) + 1, CAST(words AS INT))"), " ").alias("x"))
    keys = [F.col(c) for c in ("shard", "source_number", "slot", "block")]
    return joined.select(*keys, part.alias("part")).groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["x"]), " ").alias("text")
    )
