"""The draw against a direct computation, document by document."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from carelake.llm import resample

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def features(text, longest):
    words = WORDS.findall((text or "").translate(UPPER))
    return len(words), [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def brute(rows, target, percent, least, longest, buckets, seed):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text, *_ in rows:
        for f in features(text, longest)[1]:
            s[bucket(f)] += 1
    for _, text in target:
        for f in features(text, longest)[1]:
            t[bucket(f)] += 1
    big, small = sum(s), sum(t)
    out = []
    for doc_id, text, *_ in rows:
        n_words, found = features(text, longest)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (small + buckets))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n_words, len(found), weight, score, None])
    eligible = [r for r in out if r[1] >= least]
    eligible.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: len(eligible) * percent // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


def target_of(spark, texts):
    rows = [(i, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id bigint, text string"), rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("longest, percent, least, buckets", [(1, 10, 20, 10_000), (1, 60, 0, 50), (3, 40, 3, 997)])
def test_draw_equals_brute_force(spark, make, odd, longest, percent, least, buckets):
    rows = [*odd, *((30 + i, f"Target words {i % 7}\x00and some others " * (i % 9), "en", "a") for i in range(40))]
    target, wanted = target_of(spark, ["target words and", None, "", "One Two", "É é"])
    found = resample.resampled(
        make(rows), target, percent=percent, least_words=least, longest=longest, buckets=buckets, seed=7
    )
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    expected = brute(rows, wanted, percent, least, longest, buckets, 7)
    # Rows equal but for their rank may take each other's.
    assert rows_of(found.drop("rank")) == sorted((r[:5] for r in expected), key=repr)
    ranked = lambda rows: sorted((r[5], r[0], r[4]) for r in rows if r[5] is not None)
    assert ranked(rows_of(found)) == ranked(expected)


def test_runs_do_not_cross_documents():
    known = resample._Buckets(1 << 20)
    texts = [b"a b", b"", b"c", b" d  e f"]
    found, owner, words = resample.features(texts, known, 2)
    expected = [b"a", b"b", b"c", b"d", b"e", b"f", b"a b", b"d e", b"e f"]
    assert found.tolist() == [zlib.crc32(f) % (1 << 20) for f in expected]
    assert owner.tolist() == [0, 0, 2, 3, 3, 3, 0, 3, 3]
    assert words.tolist() == [2, 0, 1, 3]


def test_batches_and_parts_do_not_matter(spark, make, odd, monkeypatch):
    whole = resample.bucket_counts(make(odd), 2).collect()
    assert sum(r.n for r in whole) == sum(len(features(t, 2)[1]) for _, t, *_ in odd)
    monkeypatch.setattr(resample, "KNOWN", 3)
    known = resample._Buckets(10_000)
    total = np.zeros(10_000, dtype=np.int64)
    for _, text, *_ in odd:
        total += np.bincount(resample.features([(text or "").encode()], known, 2)[0], minlength=10_000)
    assert {r.bucket: r.n for r in whole} == {int(b): int(total[b]) for b in np.flatnonzero(total)}


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_a_long_text_is_counted_piece_by_piece(monkeypatch, longest):
    text = b"One two, three\x00 " + b"x" * 50 + b" a B c d  ee " * 9 + b"; z"
    whole, _, n_words = resample.features([text], resample._Buckets(1 << 30), longest)
    for most in (1, 3, 10, 64, 1000):
        monkeypatch.setattr(resample, "PART_BYTES", most)
        pieces = list(resample.long_features(text, resample._Buckets(1 << 30), longest))
        assert sorted(b for found, _ in pieces for b in found.tolist()) == sorted(whole.tolist())
        assert sum(n for _, n in pieces) == n_words[0]
        taken = []
        texts = [b"", text, b"c", text + b" q"]
        words = resample.in_pieces(
            texts, resample._Buckets(1 << 30), longest, lambda f, o: taken.extend(zip(o.tolist(), f.tolist(), strict=True))
        )
        monkeypatch.setattr(resample, "PART_BYTES", 1 << 20)
        found, owner, n = resample.features(texts, resample._Buckets(1 << 30), longest)
        assert sorted(taken) == sorted(zip(owner.tolist(), found.tolist(), strict=True)) and words.tolist() == n.tolist()


def test_equal_rows_and_ties(spark, make):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text, "en", "a")] * 300 + [(None, text, "en", "a")] * 5
    target, wanted = target_of(spark, ["w1 w2"])
    found = resample.resampled(make(rows), target, percent=50)
    assert sorted(r.rank for r in found.where("rank is not null").collect()) == list(range(1, 153))


def test_empty_tables(spark, make, odd):
    nothing, none = target_of(spark, [])
    found = resample.resampled(make(odd), nothing)
    assert rows_of(found.drop("rank")) == sorted((r[:5] for r in brute(odd, none, 10, 20, 1, 10_000, 2024)), key=repr)
    assert resample.resampled(make([]), nothing).collect() == []
