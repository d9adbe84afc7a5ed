import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import packing, token_counts, tokens

HARD = [
    "", " ", "a", "Hello  World!! it's we're 'r 're ''s don'T\n\n x y z", "abc<|endoftext|>def <|endo <|startoftext|>",
    "a\0b \0 c", "É é ÅÅ ΣΑΣ İstanbul J̌", "x" * 200, "abcdefgh" * 30 + "!!?" * 40 + "12345 '" + "re" * 50,
    "日本語のテキスト。" * 20, "ﬁ ǆ ß", "…" * 90 + "a", "é" * 80, "word," * 40 + "<|endoftext|>" * 3,
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.encoder(tokens.default_path())


def test_every_prefix_is_exact(encoder):
    words = tokens.Words(pa.array(HARD))
    steps, begins = token_counts._steps(words, encoder)
    for text, a, b in zip(HARD, begins, begins[1:]):
        assert np.cumsum(steps[a:b]).tolist() == [len(encoder.ids(text[:n])) for n in range(1, len(text) + 1)]


def test_ids_are_those_of_whole_texts(encoder):
    words = tokens.Words(pa.array(HARD))
    ids, bounds = encoder.encode(words.distinct)
    flat, ends = tokens.spread(ids, bounds, words.of)
    begins = ends[words.first_word]
    assert [flat[a:b].tolist() for a, b in zip(begins, begins[1:])] == [encoder.ids(t) for t in HARD]


def test_stored_steps_answer_prefixes_and_budgets(make, odd, encoder):
    rows = token_counts.prefix_steps(make(odd)).collect()
    texts = Counter((d, t or "") for d, t, *_ in odd)
    assert len(rows) == len(odd)
    for d, t in texts:
        n = len(encoder.ids(t))
        steps = next(r.steps for r in rows if r.doc_id == d and r.n_tokens == n and r.n_bytes == len(t.encode()))
        for length in (0, 1, len(t) // 2, len(t)):
            assert token_counts.tokens_of_prefix(steps, length) == len(encoder.ids(t[:length]))
        fits = token_counts.longest_prefix(steps, 100)
        assert len(encoder.ids(t[:fits])) <= 100
        assert fits == len(t) or len(encoder.ids(t[: fits + 1])) > 100


def test_counts(make, odd, encoder):
    rows = token_counts.budgets(make(odd)).collect()
    want = Counter((d, len((t or "").encode()), len(encoder.ids(t or ""))) for d, t, *_ in odd)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.budgets(make([])).collect() == []


def check_packing(rows, docs, encoder, capacity):
    ids = defaultdict(list)
    for d, t, *_ in docs:
        ids[d].append([*encoder.ids(t or ""), 0])
    places = defaultdict(list)
    got = Counter()
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places[r.sequence_id].append((r.offset, r.length))
    want = Counter(
        (d, n, at, len(own[at : at + capacity]), zlib.crc32(struct.pack(f"<{len(own[at : at + capacity])}I", *own[at : at + capacity])))
        for d, texts in ids.items() for own in texts for n, at in enumerate(range(0, len(own), capacity))
    )
    assert got == want
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [8, 2048])
def test_packing_is_a_partition_of_all_ids(make, odd, encoder, capacity):
    check_packing(packing.packed(make(odd), capacity).collect(), odd, encoder, capacity)


def test_packing_empty_table(make):
    assert packing.packed(make([])).collect() == []


def test_plan_places_every_piece_once_and_fills_well():
    for seed in range(60):
        draw = random.Random(seed)
        capacity = draw.choice([10, 30, 2048])
        counts = Counter(draw.randint(1, capacity) for _ in range(draw.choice([0, 1, 5, 60, 3000])))
        placed = Counter()
        bins = 0
        for many, content in packing.plan(counts, capacity):
            assert sum(n * k for n, k in content) <= capacity
            assert sum(k for n, k in content if 3 * n > capacity) <= 2
            bins += many
            for n, k in content:
                placed[n] += many * k
        assert placed == counts
        large = sum(c for n, c in counts.items() if 2 * n > capacity)
        least = max(large, -(-sum(n * c for n, c in counts.items()) // capacity))
        assert bins <= 1.25 * least + 1


def test_plan_grows_with_lengths_only():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    assert len(packing.places(counts)) < 10 * 2048
