"""Toxicity of whole texts from a gated recurrent network over overlapping windows.

The network (``gated``) reads words and their byte n-grams.  A text is as toxic
as its most toxic window, and every window of every text is scored.  Labels are
of texts, not of windows, so the network is fitted twice: on the windows of toxic
texts as they are, then on those that the first fit finds toxic and each text's
foremost one.  Last, the cut between toxic and other texts is taken from the
scores of a fourth of the labelled texts, which the fit has not seen, and mapped
to 0.5.  (Of all of them, if that fourth lacks a kind.)

Nothing is learned from a sample.  The fit reads every window of the other three
fourths, dealt by hash into shares of about ``SHARE`` bytes.  A fit goes through
all shares at once, each task moving the network by its own windows, and ends with
the mean of what the shares found, weighted by their windows.  Which n-grams are
learned at all follows from counts over all these texts, and the cut is the best
of all cuts between two scores.  The driver holds one network and those counts,
whose size is fixed.

Defined results: a null or empty text is one empty window.  A null id is never
held out and has no label.  Null labels are none; several labels of one id are
rows of their own.  Without labels of both kinds every score is 0.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import gated, shared, tokens

ACCEPT = 0.5
SHARE = 12 << 20
#: A fit moves the network at least so many times in each share, by so many windows each time.
STEPS, BATCH = 200, 256
#: Numbers of a network that are averaged at once.
PIECE = 8192
_PART = 8 << 20


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _kept_back() -> Column:
    return F.pmod(F.xxhash64(F.lit("cut"), "doc_id"), F.lit(4)) == 0


def _cut(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct plain words, each window's words by number, and each window's text."""
    words = tokens.Words(texts, cut=False)
    distinct = [gated.plain(w) for w in words.raw]
    first = words.first_word
    text, start = gated.windows(np.diff(first))
    at = (first[:-1][text] + start)[:, None] + np.arange(gated.WINDOW)
    inside = at < first[1:][text][:, None]
    numbers = words.of if len(words.of) else np.zeros(1, dtype=np.int64)
    return distinct, np.where(inside, numbers[np.where(inside, at, 0)], -1), text


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, text, toxic``: all labelled texts of the fit, in so many shares."""

    def fitting(rows: DataFrame) -> DataFrame:
        return rows.where(~held_out() & ~_kept_back())

    known = fitting(labels.where("toxic IN (0, 1)")).select(F.col("doc_id").alias("_id"), "toxic").distinct()
    same = F.col("doc_id") == F.col("_id")
    sizes = fitting(docs.select("doc_id", F.octet_length("text").alias("size"))).join(known, same)
    shares = max(1, -(-(sizes.agg(F.sum("size")).first()[0] or 0) // SHARE))
    # Always the same join.  Its partitions are as many as Spark likes, and coalescing them to
    # shares goes by where they lie, not evenly; so the texts found are dealt once more.
    texts = fitting(docs.select("doc_id", "text")).hint("merge").join(known, same)
    texts = texts.select("doc_id", "text", "toxic").repartition(shares, "doc_id")
    return texts.sortWithinPartitions(F.xxhash64("doc_id", "text"), "toxic", "text"), shares


class _Share:
    """The windows with a word of some labelled texts: their words by number, and each window's text."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        kinds, texts = [np.zeros(0, dtype=bool)], [pa.array([], pa.large_string())]
        for batch in batches:
            kinds.append(batch.column("toxic").to_numpy() == 1)
            texts.append(batch.column("text").cast(pa.large_string()))
        self.kind = np.concatenate(kinds)
        self.words, index, text = _cut(pa.concat_arrays(texts))
        some = (index >= 0).any(axis=1)
        self.index, self.text = index[some], text[some]
        self.toxic = self.kind[self.text]

    def clear(self, network: gated.Network) -> np.ndarray:
        """All windows of other texts; of a toxic one those found toxic, and its foremost."""
        clear = ~self.toxic
        bad = np.flatnonzero(self.toxic)
        if len(bad):
            used, local = np.unique(self.index[bad], return_inverse=True)
            words = [self.words[i] for i in used if i >= 0]
            logits = network.logits(words, local.reshape(-1, gated.WINDOW) - int(used[0] < 0))
            best = np.full(len(self.kind), -np.inf)
            np.maximum.at(best, self.text[bad], logits)
            clear[bad] = (logits > 0) | (logits >= best[self.text[bad]])
        return clear


def _counted(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of both kinds: texts with each bucket, texts, and windows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = _Share(batches)
        counts = gated.texts_with(share.words, share.index, share.text, share.toxic)
        more = [[np.count_nonzero(x == k) for x in (share.kind, share.toxic)] for k in (False, True)]
        counts = np.concatenate((counts, more), axis=1)
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, counts[0, at], counts[1, at])], ["at", "n0", "n1"])

    rows = texts.mapInArrow(of, "at bigint, n0 bigint, n1 bigint").groupBy("at").agg(F.sum("n0"), F.sum("n1"))
    found = rows.toArrow()
    counts = np.zeros((2, gated.BUCKETS + 2), dtype=np.int64)
    counts[:, found.column(0).to_numpy()] = [found.column(1).to_numpy(), found.column(2).to_numpy()]
    return counts[:, :-2], counts[:, -2], counts[:, -1]


def _clear_windows(texts: DataFrame, network: gated.Network) -> int:
    """How many windows of toxic texts the second fit reads."""
    packed = network.packed()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = _Share(batches)
        yield pa.RecordBatch.from_arrays([pa.array([int(share.clear(gated.Network.unpacked(packed)).sum())])], ["n"])

    return texts.where("toxic = 1").mapInArrow(of, "n bigint").agg(F.sum("n")).first()[0] or 0


def _moved(
    texts: DataFrame, network: gated.Network, telling: np.ndarray, epochs: int, balance: float, clear: bool
) -> gated.Network:
    """The mean of the networks that the shares make of this one; ``balance`` is the weight of a toxic window."""
    packed = network.packed()
    buckets = np.flatnonzero(telling)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, own = _Share(batches), gated.Network.unpacked(packed)
        some = np.flatnonzero(share.clear(own)) if clear else np.arange(len(share.index))
        if not len(some):
            return
        toxic = share.toxic[some]
        wanted = np.zeros(gated.BUCKETS, dtype=bool)
        wanted[buckets] = True
        own.fit(
            share.words, share.index[some], toxic, np.where(toxic, balance, 1.0), wanted, epochs=epochs, batch=BATCH
        )
        values = own.flat(buckets)
        pieces = [values[at : at + PIECE].astype("<f8") * len(some) for at in range(0, len(values), PIECE)]
        number = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(pieces))), pa.array([number] * len(pieces), pa.int64()),
                pa.array([len(some)] * len(pieces), pa.int64()), pa.array([x.tobytes() for x in pieces], pa.binary()),
            ],
            ["piece", "share", "n", "total"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held = totals.setdefault(row["piece"], [0, 0.0])
                held[0] += row["n"]
                held[1] = held[1] + np.frombuffer(row["total"], dtype="<f8")
        rows = [{"piece": k, "n": n, "total": x.tobytes()} for k, (n, x) in totals.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    rows = texts.mapInArrow(of, "piece bigint, share bigint, n bigint, total binary")
    # In the order of the shares, so that reruns add the same numbers in the same order.
    rows = rows.repartition("piece").sortWithinPartitions("piece", "share")
    found = sorted(rows.select("piece", "n", "total").mapInArrow(added, "piece bigint, n bigint, total binary").collect())
    mean = np.concatenate([np.frombuffer(r["total"], dtype="<f8") / r["n"] for r in found])
    return network.moved(buckets, mean)


def fitted(docs: DataFrame, labels: DataFrame) -> gated.Network | None:
    """A network from the labelled texts that are not held out, or none without both kinds."""
    texts, shares = labelled(docs, labels)
    texts = texts.persist(StorageLevel.DISK_ONLY)
    try:
        counts, n_texts, windows = _counted(texts)
        if not windows.all():
            return None
        telling = gated.telling(counts, n_texts)
        network = gated.Network()
        network.p["emb"] *= telling[:, None]
        network = _moved(
            texts, network, telling, _epochs(int(windows.sum()), shares), windows[0] / windows[1], clear=False
        )
        clear = _clear_windows(texts, network)
        return _moved(
            texts, network, telling, _epochs(int(windows[0] + clear), shares), windows[0] / clear, clear=True
        )
    finally:
        texts.unpersist()


def _epochs(rows: int, shares: int) -> int:
    """Enough passes that a share of few rows moves the network ``STEPS`` times; one, if it does so in one."""
    return -(-STEPS // max(1, rows // (shares * BATCH)))


def logits(docs: DataFrame, network: gated.Network) -> DataFrame:
    """``doc_id, text_key, logit``: the largest logit of the windows of each text."""
    packed = network.packed()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gated.Network.unpacked(packed)
        for batch in batches:
            for part in tokens.parts(batch, most=_PART):
                distinct, index, text = _cut(part.column("text"))
                most = np.full(part.num_rows, -np.inf, dtype=np.float64)
                np.maximum.at(most, text, own.logits(distinct, index))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(most)], ["doc_id", "text_key", "logit"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", _text_key().alias("text_key"))
    return rows.mapInArrow(of, f"doc_id {kind}, text_key bigint, logit double")


def cut(rows: DataFrame, labels: DataFrame) -> float:
    """The logit that parts the labelled texts; a share of clean ones lost weighs three times one of toxic ones missed."""
    known = labels.where("toxic IN (0, 1)").select(F.col("doc_id").alias("_id"), "toxic")
    train = rows.where(~held_out()).join(known, F.col("doc_id") == F.col("_id"))
    counts = shared.written(
        train.groupBy("logit", _kept_back().alias("unseen"))
        .agg(F.sum("toxic").cast("bigint").alias("toxic"), F.sum(1 - F.col("toxic")).cast("bigint").alias("clean")),
        "toxic-labelled",
    )
    kinds = "coalesce(sum(toxic), 0) AS toxic", "coalesce(sum(clean), 0) AS clean"
    toxic, clean = counts.where("unseen").selectExpr(*kinds).first()
    if toxic and clean:
        counts = counts.where("unseen")
    else:
        toxic, clean = counts.selectExpr(*kinds).first()
    if not toxic + clean:
        return 0.0
    # One row per score, in ranges of scores that each have a number.
    counts = counts.groupBy("logit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ranges = shared.written(
        counts.repartitionByRange("logit").withColumn("piece", F.spark_partition_id()), "toxic-scores"
    )
    for kind in ("toxic", "clean"):
        order = [F.col("logit")]
        ranges = shared.ranked(ranges, [], order, F.col("piece"), weight=F.col(kind), name=f"{kind}_below")
    # Whole numbers, so that equal losses are equal: of a cut below each score, and of one above all.
    loss = F.col("toxic_below") * max(1, clean) + 3 * (clean - F.col("clean_below")) * max(1, toxic)
    losses = shared.written(ranges.select("logit", loss.alias("loss")), "toxic-losses")
    least, highest = losses.agg(F.min("loss"), F.max("logit")).first()
    above = toxic * max(1, clean)
    if above < least:
        return highest + 0.5
    best = losses.where(F.col("loss") == least).orderBy("logit")
    n = best.count() + (above == least)
    found = best.offset(n // 2).first()
    if found is None:
        return highest + 0.5
    before = losses.where(F.col("logit") < found["logit"]).agg(F.max("logit")).first()[0]
    return found["logit"] - 0.5 if before is None else (before + found["logit"]) / 2


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text_key, held_out, score, predicted`` for each text."""
    network = fitted(docs, labels)
    if network is None:
        rows, score = docs.select("doc_id", _text_key().alias("text_key")), F.lit(0.0)
    else:
        rows = shared.written(logits(docs, network), "toxic-logits")
        score = 1 / (1 + F.exp(F.lit(cut(rows, labels)) - F.col("logit")))
    return rows.select("doc_id", "text_key", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns."""
    bad = scored(docs, labels).where("predicted = 1").select("doc_id", "text_key").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), _text_key().alias("_key"))
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    return rows.join(bad, same, "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
    return found.drop("text_key")
