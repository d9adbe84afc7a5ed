import math
import os
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest

from carelake.llm import search
from carelake.sources import scratch


def words(text):
    return [bytes(w).lower() for w in (text or "").encode().split()]


def brute(rows, queries, k):
    docs = [(d, Counter(words(t))) for d, t in rows]
    mean = sum(sum(c.values()) for _, c in docs) / len(docs)
    df = Counter(w for _, c in docs for w in c)
    out = set()
    for q, text in {(q, t or "") for q, t in queries}:
        found = []
        for n, (d, c) in enumerate(docs):
            norm = search.K1 * (1 - search.B + search.B * sum(c.values()) / mean)
            score = sum(
                math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (search.K1 + 1) / (c[w] + norm)
                for w in set(words(text)) if c[w]
            )
            if score > 0:
                found.append((-round(score, search.DIGITS), d is None, d or 0, n))
        out |= {(q, r, None if none else d, -s) for r, (s, none, d, _) in enumerate(sorted(found)[:k], 1)}
    return out


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 5, 40, 200])))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"SHARD_DOCS": 70, "BLOCK_DOCS": 8, "FREQUENT": 4, "BLOCK_TERMS": 300, "GROUP_ENTRIES": 50, "LOCAL": 1}])
def test_equals_scoring_every_document(make, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(search, name, value)
    rows = corpus(1, 500)
    rows += [(600 + i, rows[i][1]) for i in range(40)] + [(700, "W1 w2\tW3")]
    queries = [r for r in rows if r[0] % 50 == 0]
    got = search.search(make(rows), make(queries)).collect()
    assert {(r.query, r["rank"], r.doc_id, r.score) for r in got} == brute(rows, queries, search.TOP)


def test_pruning_skips_documents(make):
    rows = corpus(2, 900)
    row = search.index(make(rows).coalesce(1)).first().asDict()
    shard = search.Shard(row, 60.0)
    idf = search.np.array([0.1, 0.2, 0.3, 3.0, 4.0, 5.0])
    terms = shard.terms[shard.often[:6]]
    [(query, place, score)] = shard.found(terms, idf, search.np.arange(6), search.np.array([0, 6]), 5, search.np.zeros(1))
    assert query == 0 and 5 <= len(place) == len(score) < 20
    assert list(shard.found(terms, idf, search.np.arange(6), search.np.array([0, 6]), 5, search.np.array([1e9]))) == []
    scored = shard.full.copy()
    seen = []

    class Watched:
        def __getitem__(self, span):
            seen.append(span)
            return scored[span]

    shard.full = Watched()
    list(shard.found(terms, idf, search.np.arange(6), search.np.array([0, 6]), 5, search.np.zeros(1)))
    assert 0 < len(seen) < shard.blocks


def skipped(shard, terms, idf, k=5):
    """How many of the query's block maxima of rare words belong to blocks that were not opened."""
    walked = []
    plain = shard._walked
    shard._walked = lambda cell, entry, *rest: (walked.append(len(entry)), plain(cell, entry, *rest))
    list(shard.found(terms, idf, search.np.arange(len(terms)), search.np.array([0, len(terms)]), k, search.np.zeros(1)))
    at = search.np.searchsorted(shard.terms, terms)
    at = at[shard.column[at] < 0]
    return int((shard.first[at + 1] - shard.first[at]).sum()) - sum(walked)


def test_blocks_of_rare_lists_are_skipped(make):
    # Ten short documents hold all three words; a word alone stands in one of a hundred others.
    rows = [(i, "r1 r2 r3") for i in range(10)]
    rows += [(i, f"r{i // 100 % 3 + 1} " * (i % 100 == 0) + "filler " * (i // 100 + 5)) for i in range(10, 5000)]
    shard = search.Shard(search.index(make(rows).coalesce(1)).first().asDict(), 20.0)
    terms = search.np.sort(search.np.array([search.xxhash.xxh64_intdigest(w) for w in (b"r1", b"r2", b"r3")], dtype="u8"))
    assert (shard.column[search.np.searchsorted(shard.terms, terms)] < 0).all()
    assert skipped(shard, terms, search.np.array([3.0, 3.0, 3.0])) > 10


def test_block_maxima_bound_every_posting(make):
    shard = search.Shard(search.index(make(corpus(4, 300)).coalesce(1)).first().asDict(), 60.0)
    for t in range(len(shard.terms)):
        for e in range(shard.first[t], shard.first[t + 1]):
            span = slice(shard.entry_at[e], shard.entry_at[e + 1])
            assert shard.entry_most[e] == shard.weights[span].max()
            assert set(shard.places[span] // search.BLOCK_DOCS) == {shard.entry_block[e]}
    assert shard.first[-1] == len(shard.entry_block)


def test_odd_rows_and_empty_tables(make, odd):
    rows = [r[:2] for r in odd]
    got = search.search(make(odd), make(odd)).collect()
    named = {(r.query, r["rank"], r.doc_id, r.score) for r in got if r.query is not None}
    assert named == {x for x in brute(rows, rows, search.TOP) if x[0] is not None}
    assert search.search(make([]), make([])).collect() == []
    assert search.search(make(odd), make([])).collect() == []


def test_like_documents_share_blocks(make):
    n = 4 * search.BLOCK_DOCS
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i + j) % 7}" for j in range(5))) for i in range(n)]
    shard = search.Shard(search.index(make(rows).coalesce(1)).first().asDict(), 5.0)
    blocks = {}
    for w in {w for _, t in rows for w in t.split()}:
        at = search.np.searchsorted(shard.terms, search.np.uint64(search.xxhash.xxh64_intdigest(w)))
        blocks.setdefault(w[0], set()).update(shard.entry_block[shard.first[at] : shard.first[at + 1]].tolist())
    assert len(blocks["a"]) == len(blocks["b"]) == 2 and not blocks["a"] & blocks["b"]


@pytest.mark.parametrize("reached", [0.0, 2.0])
def test_pieces_of_queries_find_the_same(make, monkeypatch, reached):
    rows = corpus(5, 600)
    shard = search.Shard(search.index(make(rows).coalesce(1)).first().asDict(), 60.0)
    draw = search.np.random.default_rng(1)
    asked = search.np.concatenate([search.np.sort(draw.choice(len(shard.terms), 12, replace=False)) for _ in range(40)])
    ends, idf = search.np.arange(0, 12 * 41, 12), draw.uniform(0.1, 4, len(shard.terms))

    def found():
        known = search.np.full(40, reached)
        return [(i, p.tolist(), s.round(6).tolist()) for i, p, s in shard.found(shard.terms, idf, asked, ends, 5, known)]

    whole = found()
    monkeypatch.setattr(search, "AT_ONCE", 30)
    monkeypatch.setattr(search, "GROUP", 3)
    assert len(whole) == 40 and found() == whole


def test_executors_hold_a_bounded_part_of_the_index(spark, make, monkeypatch, tmp_path):
    monkeypatch.setattr(search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(search, "SHARD_DOCS", 30)
    batch, made, sent = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, []
    before, broadcast = spark.conf.get(batch), type(spark.sparkContext).broadcast

    def folder(_, purpose):
        made.setdefault(purpose, []).append(spark.conf.get(batch))
        return f"{tmp_path}/{purpose}-{len(made[purpose])}"

    monkeypatch.setattr(scratch, "new_folder", folder)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *a: sent.append(broadcast(*a)) or sent[-1])
    rows = corpus(6, 300)
    queries = [r for r in rows if r[0] % 50 == 0]
    got = search.search(make(rows).coalesce(1), make(queries)).collect()
    assert {(r.query, r["rank"], r.doc_id, r.score) for r in got} == brute(rows, queries, search.TOP)
    # Rows are whole shards, of which Python gets one at a time ...
    assert len(made["search-first"]) == len(made["search-found"]) > 1
    assert {*made["search-first"], *made["search-found"]} == {"1"}
    assert made["search-index"] == [before] and spark.conf.get(batch) == before
    # ... and no copy of a block of queries stays behind.
    assert sent and not any(os.path.exists(x._path) for x in sent)


def test_row_groups_of_the_index_are_small(make, monkeypatch, tmp_path):
    monkeypatch.setattr(search, "SHARD_DOCS", 30)
    monkeypatch.setattr(search, "ROW_GROUPS", search.ROW_GROUPS | {"parquet.block.size": 20_000})
    monkeypatch.setattr(scratch, "new_folder", lambda _, purpose: f"{tmp_path}/{purpose}")
    rows = corpus(7, 900)
    search.search(make(rows).coalesce(1), make(rows[:1]))
    [file] = (tmp_path / "search-index").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert groups.num_rows == 30 and groups.num_row_groups >= 5
    assert max(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)) < 40_000


def test_counts_of_any_size_are_kept(make):
    rows = [(50, "a " * 300 + "b " * 70_000 + "c"), (51, "b c c")]
    got = search.search(make(rows), make(rows[:1])).collect()
    assert {(r.query, r["rank"], r.doc_id, r.score) for r in got} == brute(rows, rows[:1], search.TOP)
    large, small = (search.index(make(some).coalesce(1)).first().asDict() for some in (rows, rows[1:]))
    assert [len(large[x]) for x in ("sizes", "places", "counts")] == [3, 5, 20]
    assert [len(small[x]) for x in ("sizes", "places", "counts")] == [2, 2, 2]
