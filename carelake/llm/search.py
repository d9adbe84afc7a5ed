"""Exact BM25 top-k search: an inverted index in shards, pruned by block-max WAND.

A shard holds the postings of some hundred documents, cut into blocks of documents
that have frequent words in common.  Document frequencies and lengths are summed over all shards, so
each shard scores as the whole corpus would and the shards' best are merged
exactly.  Every list has the largest weight of each block it reaches.  A query
runs on a shard as follows.

1. Block maxima of all its lists are added up: each block's upper bound.
2. A query without a threshold has the blocks with the largest bounds scored
   first, which gives it one.
3. Of the other blocks only those whose bound reaches it are opened (WAND's rule).
   There the lists of rare words are walked, which makes the bound closer; the
   frequent words are added only where it still reaches the threshold.

Blocks that are not opened are skipped in the lists of rare words and frequent
ones alike.  Queries of a group go through these steps together.  A task keeps
the best scores of each query over the shards that it has searched.

The threshold a query has reached on a first part of the shards, searched in as
many tasks as there are cores, goes along to the others.  Queries are a table of their own, taken in blocks of about
``BLOCK_TERMS`` words each, which is what a task holds of them.  Shards go to a
task one by one and lie in small row groups and pages, so neither an executor's JVM
nor its Python holds more of the index as the corpus grows.

A score is the sum over the query's distinct words of
``idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length))`` with
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``; words are separated by ASCII white
space, with A-Z lower-cased, and are told apart by 64 bits of hash.  Scores are
rounded to six places before they are compared; ties go to the smaller id.

Defined results: null and empty texts are documents without words.  They are
never found, and as queries find nothing.  A null id is last among ties and never
a query.  Repeated rows are documents of their own; queries with equal id and
text are one.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import shared, tokens

K1, B, TOP, EVERY = 1.2, 0.75, 10, 50
SHARD_DOCS, SHARD_BYTES = 8192, 3 << 20
BLOCK_DOCS = 64
#: A list is frequent if it has one of so many documents of the shard.
FREQUENT = 24
#: Steps towards the direction in which a shard's texts differ most.
TURNS = 6
#: Queries that are run together on a shard, and the blocks with the largest bounds that
#: are scored first.
GROUP, FOREMOST = 64, 3
#: Block maxima of rare words that a group of queries may hold; one longer query is a group.
GROUP_ENTRIES = 400_000
#: Words that a task holds of its queries, and of these looked up in a shard at once.
BLOCK_TERMS, AT_ONCE = 2_000_000, 200_000
#: One of so many shards is searched first, for the thresholds.
FIRST = 6
#: A task reduces what it found to the best of each query beyond so many times their number.
LOCAL = 4
FOUND = ["query", "doc_id", "score"]
DIGITS = 6
#: Parquet counts a hundred rows before it looks at their size; a row here is a whole shard.
ROW_GROUPS = {
    "parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": "false",
}
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SLACK = 2 * 10.0**-DIGITS


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct terms, then for each (term, text) that occurs: both and how often."""
    words = tokens.Words(texts, cut=False)
    hashes = np.array([xxhash.xxh64_intdigest(w.lower()) for w in words.raw], dtype=np.uint64)
    terms, of_word = np.unique(hashes, return_inverse=True)
    n = len(words.first_word) - 1
    text = np.repeat(np.arange(n), np.diff(words.first_word))
    pairs = of_word[words.of].astype(np.int64) * n + text if len(words.of) else np.zeros(0, np.int64)
    pairs, counts = np.unique(pairs, return_counts=True)
    return terms, pairs // max(1, n), pairs % max(1, n), counts


def _alike(term: np.ndarray, text: np.ndarray, counts: np.ndarray, df: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """An order of the texts in which those with the same frequent words share blocks.

    They are halved again and again along the direction in which they differ most,
    down to a block; otherwise they stand by length.
    """
    order = np.argsort(lengths, kind="stable")
    often = np.flatnonzero(df * FREQUENT >= len(lengths))
    if not len(often) or len(lengths) <= BLOCK_DOCS:
        return order
    column = np.full(len(df), -1)
    column[often] = np.arange(len(often))
    of = np.flatnonzero(column[term] >= 0)
    vectors = np.zeros((len(lengths), len(often)), dtype=np.float32)
    idf = np.log(1 + (len(lengths) - df[term[of]] + 0.5) / (df[term[of]] + 0.5))
    vectors[text[of], column[term[of]]] = idf * counts[of] / (counts[of] + K1)
    done, todo = [], [order]
    while todo:
        some = todo.pop()
        if len(some) <= BLOCK_DOCS:
            done.append(some)
            continue
        apart = vectors[some] - vectors[some].mean(axis=0)
        along = apart[np.abs(apart).sum(axis=1).argmax()]
        for _ in range(TURNS):
            along = (apart @ along) @ apart
            along /= np.linalg.norm(along) + 1e-9
        some = some[np.argsort(apart @ along, kind="stable")]
        half = -(-len(some) // (2 * BLOCK_DOCS)) * BLOCK_DOCS
        todo += [some[half:], some[:half]]
    return np.concatenate(done)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on, in the smallest type that holds them all."""
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0)).newbyteorder("<"))


def _numbers(held: bytes | pa.Buffer, n: int) -> np.ndarray:
    """The ``n`` numbers that ``_narrow`` made bytes of."""
    return np.frombuffer(held, dtype=f"<u{len(held) // max(1, n) or 1}")


def index(docs: DataFrame) -> DataFrame:
    """One row per shard: ids and lengths of its documents, like ones together, terms and postings."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.parts(batch, most=SHARD_BYTES):
                for at in range(0, part.num_rows, SHARD_DOCS):
                    some = part.slice(at, SHARD_DOCS)
                    terms, term, text, counts = _terms(some.column("text"))
                    lengths = np.bincount(text, weights=counts, minlength=some.num_rows).astype("<i8")
                    df = np.bincount(term, minlength=len(terms))
                    order = _alike(term, text, counts, df, lengths)
                    place = np.empty_like(order)
                    place[order] = np.arange(len(order))
                    by = np.lexsort((place[text], term))
                    arrays = (
                        lengths[order], terms.astype("<u8"), _narrow(df), _narrow(place[text][by]), _narrow(counts[by]),
                    )
                    ids = some.column("doc_id").take(pa.array(order))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                            pa.array([some.num_rows], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                            *(pa.array([a.tobytes()], pa.binary()) for a in arrays),
                        ],
                        ["ids", "n_docs", "n_words", "lengths", "terms", "sizes", "places", "counts"],
                    )

    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: tokens.tidied(of(batches)),
        f"ids array<{kind}>, n_docs bigint, n_words bigint, lengths binary, terms binary, sizes binary, "
        "places binary, counts binary",
    )


def frequencies(shards: DataFrame) -> DataFrame:
    """``term, df`` over all shards."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, sizes in zip(batch.column("terms"), batch.column("sizes")):
                terms = np.frombuffer(held.as_buffer(), dtype="<i8")
                n = _numbers(sizes.as_buffer(), len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], ["term", "n"])

    rows = shards.select("terms", "sizes").mapInArrow(of, "term bigint, n bigint")
    return rows.groupBy("term").agg(F.sum("n").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """``query, text_key, term``: each query's distinct terms."""
    kind = queries.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.parts(batch):
                terms, term, text, _ = _terms(part.column("text"))
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("text_key").take(at), pa.array(terms.view("<i8")[term])],
                    ["query", "text_key", "term"],
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = queries.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    return rows.mapInArrow(of, f"query {kind}, text_key bigint, term bigint").distinct()


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``starts[0], ..., stops[0] - 1, starts[1], ...``: the number of the span, and the value."""
    sizes = stops - starts
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, (starts - ends + sizes)[of] + np.arange(len(of))


class Shard:
    """One shard ready for search: postings with their weights, and block maxima of every list."""

    def __init__(self, row: dict, mean: float) -> None:
        lengths = np.frombuffer(row["lengths"], dtype="<i8")
        self.terms = np.frombuffer(row["terms"], dtype="<u8")
        bounds = np.concatenate(([0], np.cumsum(_numbers(row["sizes"], len(self.terms)), dtype=np.int64)))
        self.places = _numbers(row["places"], bounds[-1]).astype(np.int32)
        counts = _numbers(row["counts"], bounds[-1]).astype(np.int64)
        self.n = len(lengths)
        norm = K1 * (1 - B + B * lengths / mean)
        self.weights = counts * (K1 + 1) / (counts + norm[self.places])
        self.blocks = -(-self.n // BLOCK_DOCS)
        self.width = self.blocks * BLOCK_DOCS
        self._maxima(bounds)
        often = np.flatnonzero(np.diff(bounds) * FREQUENT >= self.n)
        self.column = np.full(len(self.terms), -1)
        self.column[often] = np.arange(len(often))
        self.often = often
        #: Weights of frequent terms by document, and their largest in each block.
        self.full = np.zeros((self.width, len(often)))
        for i, t in enumerate(often):
            span = slice(bounds[t], bounds[t + 1])
            self.full[self.places[span], i] = self.weights[span]
        self.most = self.full.reshape(self.blocks, BLOCK_DOCS, -1).max(axis=1)

    def _maxima(self, bounds: np.ndarray) -> None:
        """An entry for each term and block with postings: block, largest weight, first posting."""
        block = self.places // BLOCK_DOCS
        new = np.ones(len(block), dtype=bool)
        new[1:] = block[1:] != block[:-1]
        new[bounds[:-1]] = True
        start = np.flatnonzero(new)
        self.entry_block = block[start]
        self.entry_most = np.maximum.reduceat(self.weights, start) if len(start) else self.weights
        self.entry_at = np.append(start, len(block))
        #: The entries of term t are ``first[t]`` to ``first[t + 1]``.
        self.first = np.searchsorted(start, bounds)

    def found(
        self, terms: np.ndarray, idf: np.ndarray, asked: np.ndarray, ends: np.ndarray, k: int, reached: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query: its number, and places and scores of all that may be among its best ``k``.

        ``terms`` are distinct and sorted.  Query i asks for those numbered
        ``asked[ends[i]:ends[i + 1]]``, and has reached a k-th best score of
        ``reached[i]`` elsewhere.
        """
        if not len(self.terms) or not len(terms):
            return
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        there = self.terms[at] == terms
        start = 0
        while start < len(ends) - 1:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + AT_ONCE, side="right")) - 1)
            span = slice(ends[start], ends[stop])
            held = np.flatnonzero(there[asked[span]])
            splits = np.searchsorted(held, ends[start : stop + 1] - ends[start])
            term = asked[span][held]
            for i, place, score in self._grouped(at[term], idf[term], splits, k, reached[start:stop]):
                yield start + i, place, score
            start = stop

    def _grouped(
        self, at: np.ndarray, idf: np.ndarray, splits: np.ndarray, k: int, reached: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``found`` for queries of which i asks for the shard's terms ``at[splits[i]:splits[i + 1]]``."""
        column = self.column[at]
        sizes = np.where(column < 0, self.first[at + 1] - self.first[at], 0)
        upto = np.concatenate(([0], np.cumsum(sizes)))[splits]
        asking = np.flatnonzero(np.diff(splits))
        start = 0
        while start < len(asking):
            stop = int(np.searchsorted(upto[asking + 1], upto[asking[start]] + GROUP_ENTRIES, side="right"))
            some = asking[start : max(start + 1, min(stop, start + GROUP))]
            own = slice(splits[some[0]], splits[some[-1] + 1])
            row = np.repeat(np.arange(len(some)), splits[some + 1] - splits[some])
            often = column[own] >= 0
            weights = np.zeros((len(some), len(self.often)))
            weights[row[often], column[own][often]] = idf[own][often]
            few = ~often
            for j, place, score in self._best(row[few], at[own][few], idf[own][few], weights, k, reached[some]):
                yield int(some[j]), place, score
            start += len(some)

    def _walked(self, cell: np.ndarray, entry: np.ndarray, ask: np.ndarray, idf: np.ndarray, sums: np.ndarray) -> None:
        """Add to ``sums`` the rare words' postings of these entries; ``cell`` is row x blocks + block.

        Entries that follow each other in one list, asked for by one query (``ask``), are one run of postings.
        """
        if not len(entry):
            return
        apart = np.flatnonzero((entry[1:] != entry[:-1] + 1) | (ask[1:] != ask[:-1]))
        head, tail = np.concatenate(([0], apart + 1)), np.append(apart, len(entry) - 1)
        start = self.entry_at[entry[head]]
        sizes = self.entry_at[entry[tail] + 1] - start
        at = np.repeat(start - np.cumsum(sizes) + sizes, sizes)
        at += np.arange(len(at))
        to = np.repeat(cell[head] // self.blocks * self.width, sizes)
        to += self.places.take(at)
        weights = np.repeat(idf[ask[head]], sizes)
        weights *= self.weights.take(at)
        sums += np.bincount(to, weights=weights, minlength=sums.size).reshape(sums.shape)

    def _best(
        self, row: np.ndarray, lists: np.ndarray, idf: np.ndarray, asked: np.ndarray, k: int, reached: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Score, for a group of queries, the blocks whose bound reaches the k-th best score."""
        shape = len(asked), self.blocks
        ask, entry = _spread(self.first[lists], self.first[lists + 1])
        cell = (row * self.blocks)[ask] + self.entry_block[entry]
        frequent = asked @ self.most.T + 1e-9
        bounds = np.bincount(cell, weights=self.entry_most[entry] * idf[ask], minlength=frequent.size).reshape(shape) + frequent
        sums = np.zeros((len(asked), self.width))
        scores = np.full_like(sums, -np.inf)
        threshold = reached.copy()

        def opened(chosen: np.ndarray) -> np.ndarray:
            """Walk the rare lists in the chosen blocks; those which may still reach the threshold."""
            take = np.flatnonzero(chosen.ravel()[cell])
            self._walked(cell[take], entry[take], ask[take], idf, sums)
            closer = sums.reshape(*shape, BLOCK_DOCS).max(axis=2) + frequent
            return chosen & (closer >= threshold[:, None] - _SLACK)

        def score(chosen: np.ndarray) -> None:
            for b in np.flatnonzero(chosen.any(axis=0)):
                rows, span = np.flatnonzero(chosen[:, b]), slice(b * BLOCK_DOCS, (b + 1) * BLOCK_DOCS)
                scores[rows, span] = sums[rows, span] + asked[rows] @ self.full[span].T
            if len(new) and self.width >= k:
                threshold[new] = np.partition(scores[new], -k, axis=1)[:, -k]

        # Queries that have reached nothing yet get their threshold from the blocks with the largest bounds.
        new = np.flatnonzero(reached <= 0)
        chosen = bounds >= threshold[:, None] - _SLACK
        if len(new):
            largest = np.zeros((len(new), self.blocks), dtype=bool)
            np.put_along_axis(largest, np.argsort(-bounds[new], axis=1)[:, :FOREMOST], True, axis=1)
            chosen[new] &= largest
        score(opened(chosen))
        if len(new):
            score(opened((bounds >= threshold[:, None] - _SLACK) & ~chosen))
        fits = (scores >= threshold[:, None] - _SLACK) & (scores > 0)
        for j in np.flatnonzero(fits.any(axis=1)):
            place = np.flatnonzero(fits[j])
            yield int(j), place, scores[j, place]


def foremost(found: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of each query: by score, ties by id, null ids last."""
    order = [("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
    rows = found.take(pc.sort_indices(found, sort_keys=order, null_placement="at_end"))
    query = rows.column("query").to_numpy()
    start = np.concatenate(([0], np.flatnonzero(query[1:] != query[:-1]) + 1))
    rank = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    return rows.take(pa.array(np.flatnonzero(rank < k)))


@contextlib.contextmanager
def _singly(spark: SparkSession) -> Iterator[None]:
    """Python gets row by row what is run meanwhile: else a batch has as many shards as fit into 64 MB."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, "1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def _block(asked: pa.Table, n_docs: int) -> tuple:
    """Of a block of queries: ids and keys, where each one's words end, the distinct words, their idf, the words."""
    asked = asked.combine_chunks()
    queries, keys = (pa.array(asked.column(x).to_pylist(), asked.schema.field(x).type) for x in ("query", "text_key"))
    terms, df = (
        np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy(zero_copy_only=False) for c in asked.column(x).chunks)])
        for x in ("terms", "dfs")
    )
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    distinct, first, words = np.unique(terms.view(np.uint64), return_index=True, return_inverse=True)
    ends = np.concatenate(([0], np.cumsum(asked.column("size").to_numpy()))).astype(np.int64)
    return queries, keys, ends, distinct, idf[first], words.astype(np.int32)


def _search(shards: DataFrame, held: Broadcast, reached: Broadcast, mean: float, k: int) -> DataFrame:
    """``query, text_key, doc_id, score``: from each shard what may be among the best of a query."""
    kind = shards.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, keys, ends, terms, idf, asked = held.value
        known, top = reached.value.copy(), np.zeros((len(queries), k))
        out = []
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_buffer() for c in ("lengths", "terms", "sizes", "places", "counts")}
                ids, of, places, scores = batch.column("ids")[n].values, [], [], []
                for i, place, score in Shard(row, mean).found(terms, idf, asked, ends, k, known):
                    of.append(np.full(len(place), i))
                    places.append(place)
                    scores.append(score)
                    top[i] = np.partition(np.concatenate((top[i], score)), -k)[-k:]
                    known[i] = max(known[i], top[i].min())
                if of:
                    found = ids.take(pa.array(np.concatenate(places)))
                    out.append(pa.table([np.concatenate(of), found, np.round(np.concatenate(scores), DIGITS)], FOUND))
                if sum(map(len, out)) > LOCAL * len(known) * k:
                    out = [foremost(pa.concat_tables(out), k)]
        if out:
            rows = foremost(pa.concat_tables(out), k).combine_chunks()
            for batch in rows.to_batches():
                of = batch.column("query")
                yield pa.RecordBatch.from_arrays(
                    [queries.take(of), keys.take(of), *batch.columns[1:]], ["query", "text_key", "doc_id", "score"]
                )

    return shards.mapInArrow(lambda batches: tokens.tidied(run(batches)), f"query {kind}, text_key bigint, doc_id {kind}, score double")


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "text_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _answered(early: DataFrame, others: DataFrame, block: tuple, mean: float, k: int) -> DataFrame:
    """The best ``k`` of each of a block's queries; what was sent out for them is taken back."""
    spark = early.sparkSession
    context = spark.sparkContext
    sent = [context.broadcast(block), context.broadcast(np.zeros(len(block[0])))]
    try:
        with _singly(spark):
            some = shared.written(best(_search(early, *sent, mean, k), k), "search-first")
        reached = {(r["query"], r["text_key"]): r["score"] for r in some.where(F.col("rank") == k).collect()}
        known = [reached.get(x, 0.0) for x in zip(block[0].to_pylist(), block[1].to_pylist())]
        sent.append(context.broadcast(np.array(known)))
        with _singly(spark):
            rest = _search(others, sent[0], sent[2], mean, k)
            return shared.written(best(some.drop("rank").union(rest), k), "search-found")
    finally:
        for held in sent:
            held.destroy()


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``query, text_key, rank, doc_id, score``: the best ``k`` of ``docs`` for each of ``queries``."""
    shards = shared.written(index(docs), "search-index", ROW_GROUPS)
    whole = shards.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = (x or 0 for x in whole)
    asked = shared.written(
        query_terms(queries).join(frequencies(shards), "term").groupBy("query", "text_key")
        .agg(F.collect_list(F.struct("term", "df")).alias("found"))
        .select(
            "query", "text_key", F.size("found").alias("size"), F.col("found.term").alias("terms"),
            F.col("found.df").alias("dfs"),
        ),
        "search-queries",
    )
    total = asked.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_TERMS))
    part = F.pmod(F.xxhash64("query", "text_key"), F.lit(blocks))
    first = F.pmod(F.xxhash64("lengths"), F.lit(FIRST)) == 0
    mean = max(n_words, 1) / max(n_docs, 1)
    # A task gives each query's best, so few tasks, with many shards each, give few rows.
    early = shards.where(first).coalesce(shards.sparkSession.sparkContext.defaultParallelism)
    results = []
    for i in range(blocks):
        results.append(_answered(early, shards.where(~first), _block(asked.where(part == i).toArrow(), n_docs), mean, k))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found.select("query", "text_key", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    found = search(docs, docs.where(F.col("doc_id") % EVERY == 0))
    return found.select(F.col("query").alias("query_id"), "rank", "doc_id", "score")


SQL = f"""
WITH words AS (
  SELECT doc_id, w AS term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{shared.UPPER}', '{shared.LOWER}'), '[^ \\x09-\\x0D]+')) AS w
    FROM documents) GROUP BY doc_id, w
), lengths AS (
  SELECT doc_id, CAST(sum(tf) AS DOUBLE) AS n FROM words GROUP BY doc_id
), whole AS (
  SELECT (SELECT count(*) FROM documents) AS n_docs,
    (SELECT sum(n) FROM lengths) / (SELECT count(*) FROM documents) AS mean
), idf AS (
  SELECT term, ln(1 + (n_docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM words, whole GROUP BY term, n_docs
), scores AS (
  SELECT q.doc_id AS query_id, d.doc_id,
    round(sum(i.idf * d.tf * {K1 + 1} / (d.tf + {K1} * ({1 - B} + {B} * l.n / whole.mean))), {DIGITS}) AS score
  FROM words q JOIN words d ON q.term = d.term JOIN idf i ON i.term = q.term
    JOIN lengths l ON l.doc_id = d.doc_id, whole
  WHERE q.doc_id % {EVERY} = 0 GROUP BY q.doc_id, d.doc_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score FROM scores
)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
