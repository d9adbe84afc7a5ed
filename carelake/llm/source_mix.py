"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of a block of words each.  A source has as many
slots as its target fills, the last one cut at the target, so it gives its target
to the nearest word, and at least one word where the target is above zero,
however large a block is.  Slot i is a golden-ratio point of [0, 1); its rank
among the points of all slots falls in one source's stretch of the cumulative
slots.  The k-th slot of a source takes the k-th block of the source's documents,
which are shuffled by a hash and laid end to end, up to three times over.  So
each source has its share of every stretch of the mix, and reruns agree.

Slots are about ``SLOTS`` for each source, so blocks grow with the data and the
schedule does not.  Running sums within a source, ranks of points and ranks within
a source's slots are taken piece by piece (``shared.ranked``); joins are by source
and block, never by source alone on both sides.

Defined results: a null text has no words.  Null is a source of its own, after
all others.  Documents without words, and all documents of an empty corpus, are
taken zero times.  Repeated rows are documents of their own.  Columns other
than ``doc_id``, ``text`` and ``source`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import shared

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SLOTS = 4096
#: Neighbours in the Fibonacci sequence: i * STEP mod TURN visits every multiple of
#: 1 / TURN once, in golden-ratio order.
STEP, TURN = 1134903170, 1836311903
#: Documents of a source, or slots, that one window holds.
PIECE = 1_000
#: Over how many keys the documents of a source are dealt to meet its figures.
SALTS = 64


def sizes(docs: DataFrame) -> DataFrame:
    words = F.coalesce(F.regexp_count("text", F.lit(shared.WORD)), F.lit(0))
    return docs.select(
        "doc_id", "source", words.cast("bigint").alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, n_docs, weight, target`` for each source.

    A source stops at ``most`` times its size.  In order of that limit per
    weight, a source stops if what is left for it and all after it, shared by
    weight, exceeds its limit.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    rows = per_source.withColumn("place", place).withColumn("weight", weight)
    rows = rows.withColumn("limit", (F.col("source_size") * most).cast("double"))
    every = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(*shared.BEFORE)
    words = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(by_limit), F.lit(0.0))
    shares = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))
    rows = rows.withColumn("level", words / shares)
    rows = rows.withColumn("stops", F.col("limit") <= F.col("weight") * F.col("level"))
    level = F.min_by(F.when(~F.col("stops"), F.col("level")),
                     F.when(~F.col("stops"), F.col("limit") / F.col("weight"))).over(every)
    target = F.when(F.col("stops"), F.col("limit")).otherwise(F.col("weight") * level)
    return rows.select("source", "source_size", "n_docs", "weight", target.alias("target"), "place")


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """``slot, source, block``: slot after slot, the source and the number of its block."""
    counts = goals.where("limit > 0").select("source", "place", F.expr(f"(limit - 1) div {block} + 1").alias("n"))
    n_slots = counts.agg(F.sum("n")).first()[0] or 0
    by_place = Window.orderBy("place").rowsBetween(*shared.BEFORE)
    low = F.coalesce(F.sum("n").over(by_place), F.lit(0))
    bounds = (
        counts.select("source", low.alias("low"), (low + F.col("n")).alias("high"))
        .withColumn("cell", F.explode(F.sequence(F.expr(f"low div {PIECE}"), F.expr(f"(high - 1) div {PIECE}"))))
    )
    point = (F.col("id") % TURN) * STEP % TURN / float(TURN)
    slots = goals.sparkSession.range(n_slots).select(F.col("id").alias("slot"), point.alias("point"))
    pieces = max(1, -(-n_slots // PIECE))
    seats = shared.ranked(
        slots, [], [F.col("point"), F.col("slot")], F.floor(F.col("point") * pieces), name="seat"
    )
    slots = (
        seats.withColumn("cell", F.expr(f"seat div {PIECE}"))
        .join(bounds, "cell")
        .where("seat >= low AND seat < high")
        .select("slot", "source")
    )
    return shared.ranked(slots, ["source"], [F.col("slot")], F.floor(F.col("slot") / PIECE), name="block")


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> tuple[DataFrame, DataFrame]:
    """The mix piece by piece, and the documents with their places.

    Pieces: ``slot, source, block, doc_id, text_key, start, copy, words``: the
    slot takes so many words of the document's copy.  Documents: ``doc_id,
    text_key, source, size, start, source_size, target``.
    """
    sized = shared.written(sizes(docs), "mix-sizes")
    limit = F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round("target"))).otherwise(0).cast("bigint")
    goals = shared.written(targets(sized, weights, most).withColumn("limit", limit), "mix-targets")
    whole = goals.agg(F.count(F.lit(1)), F.sum("source_size"), F.max("n_docs")).first()
    n_sources, words, largest = (x or 0 for x in whole)
    block = max(1, -(-words // max(1, n_sources * SLOTS)))
    slots = shared.written(schedule(goals, block), "mix-slots")

    pieces = max(1, -(-largest // PIECE))
    mixed = sized.withColumn("order", shared.hashed(F.lit("mix"), "doc_id", "text_key"))
    placed = shared.ranked(
        mixed, ["source"], [F.col("order"), F.col("doc_id"), F.col("size")],
        F.floor(F.col("order") * pieces), weight=F.col("size"), name="start",
    ).drop("order")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    limits = goals.select(F.col("source").alias("_source"), "source_size", "target", "limit", salts)
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") % SALTS == F.col("_salt"))
    placed = shared.written(placed.join(limits, same).drop("_source", "_salt"), "mix-places")

    spans = placed.where("size > 0").select(
        "doc_id", "text_key", "source", "size", "start", "limit", "source_size",
        F.explode(F.array(*map(F.lit, range(most)))).alias("copy"),
    )
    first = F.col("copy") * F.col("source_size") + F.col("start")
    spans = spans.withColumn("first", first).where("first < limit").withColumn(
        "end", F.least(F.col("first") + F.col("size"), F.col("limit"))
    )
    of_block = spans.withColumn(
        "block", F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"(end - 1) div {block}")))
    )
    begin = F.greatest(F.col("first"), F.col("block") * block)
    stop = F.least(F.col("end"), (F.col("block") + 1) * block)
    slots = slots.withColumnsRenamed({"source": "_source", "block": "_block"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    return of_block.join(slots, same).select(
        "slot", "source", "block", "doc_id", "text_key", "start", "copy", (stop - begin).alias("words")
    ), placed


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Each document with its source's size and target, and the words the mix takes of it."""
    parts, placed = mixture(docs, weights, most)
    counted = (
        parts.groupBy("source", "start", "doc_id").agg(F.sum("words").alias("words"))
        .withColumnsRenamed({"source": "_source", "start": "_start", "doc_id": "_id"})
    )
    same = (
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") == F.col("_start"))
        & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("size") > 0)
    )
    return placed.join(counted, same, "left").select(
        "doc_id", "text_key", "source", "size", "source_size", "target",
        F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, to the nearest whole copy."""
    counts = (
        taken(docs).groupBy("doc_id", "text_key", "source")
        .agg(F.avg("taken").alias("taken"), F.max("size").alias("size"))
        .withColumn("copies", F.round(F.try_divide("taken", "size")).cast("int"))
        .where("copies > 0")
        .select(F.col("doc_id").alias("_id"), "text_key", F.col("source").alias("_source"), "copies")
    )
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), key.alias("key"),
        F.col("source").alias("of"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("text_key"))
        & F.col("of").eqNullSafe(F.col("_source"))
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return rows.join(counts, same).select("row", copies.alias("copy")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(shared.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
