"""SimHash near-dedup: fingerprints that differ in few bits are linked, pruned by the pigeonring.

A fingerprint is cut into ``SEGMENTS`` segments on a ring.  If two fingerprints
differ in at most ``d`` bits, some segment starts a chain in which the first l
segments together differ in at most l * d / SEGMENTS bits, for every l.  As long
as that bound is below one, the segments are equal: they are the key that
candidates meet by.  The longer chains and then the whole distance are checked
on the pair.

A key that more than ``CROWD`` fingerprints share, as in a large group of near
copies, would give pairs by the square.  Its fingerprints instead meet at every
value one bit away: two of them share such a value exactly if they differ in two
bits or fewer, and no value has more than 65 of them.  So nothing is cut off.
(The distance is therefore 2 at most.)

Links join distinct fingerprints only; copies of a fingerprint are one vertex.

Defined results: a text without words, empty or null, has fingerprint zero and
is linked like any other.  A component is named by its smallest ``doc_id``; null
ids never name one that has others, and are returned with it.  Repeated rows are
returned as often as given.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import shared
from carelake.llm.components import components

SHINGLE, BITS, SEGMENTS, CROWD, SEED = 3, 2, 16, 64, 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 bits, as a signed number, that over half of the shingles' hashes have set."""
    # bytes.lower and bytes.split know ASCII only, which is what is asked for.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = [0, *(ends[: -shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8"
        )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    @F.pandas_udf("bigint")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint(t, shingle, seed) for t in part], dtype="int64")

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", key.alias("text_key"), of("text").alias("print"))


def links(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect all that differ in ``bits`` or fewer.

    ``prints`` has one row per fingerprint, in ``print``.  Every pair that is
    returned is within the distance, and every pair within it is connected.
    """
    if not 0 <= bits <= 2:
        raise ValueError("crowded keys are resolved for distances up to 2")
    width = 64 // segments
    same = -(-segments // bits) - 1 if bits else segments
    mask = (1 << (same * width)) - 1 if same * width < 64 else -1
    turned = f"shiftleft(print, {width} * at) | shiftrightunsigned(print, (64 - {width} * at) % 64)"
    keys = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("at")).select(
        "print", "at", F.expr(turned).alias("ring")
    ).withColumn("key", F.col("ring").bitwiseAND(F.lit(mask)))
    keys = shared.written(keys, "simhash-keys")

    crowds = (
        keys.groupBy("at", "key").count().where(F.col("count") > crowd)
        .select("at", "key", F.lit(True).alias("crowded"))
    )
    marked = keys.join(crowds, ["at", "key"], "left")
    few = marked.where("crowded IS NULL").drop("crowded")

    apart = F.col("ring").bitwiseXOR(F.col("other_ring"))
    chain = F.bit_count(apart) <= bits
    for length in range(segments - 1, same, -1):
        if length * bits // segments < min(bits, (length + 1) * bits // segments):
            part = F.lit((1 << (length * width)) - 1)
            chain = (F.bit_count(apart.bitwiseAND(part)) <= length * bits // segments) & chain
    other = few.select("at", "key", F.col("print").alias("other"), F.col("ring").alias("other_ring"))
    near = few.join(other, ["at", "key"]).where((F.col("print") < F.col("other")) & chain)
    near = near.select(F.col("print").alias("a"), F.col("other").alias("b"))

    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
    zero = F.array(F.lit(0).cast("bigint"))
    around = (
        marked.where("crowded").select("print").distinct()
        .select("print", F.explode(F.concat(zero, flips)).alias("flip"))
        .select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("meets"))
    )
    least = around.groupBy("meets").agg(F.min("print").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    dense = around.join(least, "meets").where("print <> a").select("a", F.col("print").alias("b"))
    return near.union(dense).distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """Each document with its ``print`` and the ``component_id`` of all it is linked with."""
    rows = shared.written(fingerprints(docs, shingle, seed), "simhash-prints")
    prints = shared.written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(prints.select("print"), bits))
    named = prints.join(roots, prints["print"] == roots["node"], "left").select(
        F.col("print").alias("_print"), "least", F.coalesce("root", "print").alias("root")
    )
    names = named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    named = named.join(names, F.col("root") == F.col("_root"))
    return rows.join(named, F.col("print") == F.col("_print")).select(
        "doc_id", "text_key", "print", "root", "component_id"
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with its smallest ``doc_id``, null only if all are."""
    choice = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key")))
    kept = groups(docs).groupBy("root").agg(choice.alias("kept")).select(
        F.col("kept.doc_id").alias("_id"), F.col("kept.text_key").alias("_text")
    )
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    # Keys without nulls, so that the join and the choice among copies share one shuffle.
    id_of = lambda c: (F.coalesce(c, F.lit(0)).alias("id"), c.isNull().alias("no_id"))
    keys = ["id", "no_id", "key"]
    rows = docs.select(F.struct(*docs.columns).alias("row"), *id_of(F.col("doc_id")), key.alias("key"))
    kept = kept.select(*id_of(F.col("_id")), F.col("_text").alias("key"))
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(shared.table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
