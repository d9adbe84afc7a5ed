import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import expr, spark_partition_id

from carelake.llm import gated, toxicity


def test_gradients_are_those_of_the_loss():
    network = gated.Network(size=3, hidden=2)
    for k, v in network.p.items():
        network.p[k] = v.astype(np.float64)
    draw = np.random.default_rng(0)
    vectors = np.vstack([draw.standard_normal((5, 3)), np.zeros((1, 3))])
    some = draw.integers(-1, 5, size=(6, 4))
    some[0] = 1
    wanted, weight = np.array([0.0, 1, 1, 0]), np.array([1.0, 2, 1, 1])

    def loss():
        ways = [vectors[some] @ network.p[f"w{w}"] + network.p[f"c{w}"] for w in "fb"]
        a = network._run(ways[0], network.p["uf"]).astype(float)
        b = network._run(ways[1][::-1], network.p["ub"])[::-1].astype(float)
        pooled = network._pool(np.concatenate([a, b], axis=2), some >= 0)[1]
        x = pooled @ network.p["out"] + network.p["bias"]
        return float((weight * (np.log1p(np.exp(x)) - wanted * x)).mean())

    grads = network._gradients(vectors, some, wanted, weight)
    for name in ("wf", "ub", "uf", "cb", "att", "out", "bias"):
        flat = network.p[name].ravel()
        for i in range(min(4, len(flat))):
            kept, step = flat[i], 1e-2
            flat[i] = kept + step
            up = loss()
            flat[i] = kept - step
            down = loss()
            flat[i] = kept
            assert grads[name].ravel()[i] == pytest.approx((up - down) / (2 * step), abs=2e-3), name


def test_windows_cover_every_word_and_overlap():
    for n in [0, 1, 31, 32, 33, 56, 57, 500]:
        text, first = gated.windows(np.array([n]))
        seen = {w for f in first for w in range(f, min(n, f + gated.WINDOW))}
        assert seen == set(range(n)) and len(text) == len(first) >= 1
        assert all(b - a < gated.WINDOW for a, b in zip(first, first[1:]))


def test_windows_hold_the_words_of_their_own_text():
    distinct, index, text = toxicity._cut(pa.array(["A, b!", None, " ".join(map(str, range(40)))]))
    assert text.tolist() == [0, 1, 2, 2]
    assert [[distinct[i] for i in row if i >= 0] for row in index[:2]] == [[b"a", b"b"], []]
    assert [distinct[i] for i in index[3] if i >= 0] == [b"%d" % i for i in range(24, 40)]


def prose(draw, words):
    return ["".join(draw.choices(["ba", "le", "mi", "to", "ru", "sen", "dor"], k=draw.randint(1, 4))) for _ in range(words)]


@pytest.fixture(scope="module")
def corpus(make, spark):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        words = prose(draw, draw.choice([10, 40, 150]))
        bad = i % 4 == 0
        for _ in range(1 + len(words) // 40 if bad else 0):
            words[draw.randrange(len(words))] = draw.choice(["idiot", "zorgh" + draw.choice(["ba", "le", "mi"])])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (3, 1, None)]
    return make(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy_and_whole_texts(corpus, make):
    docs, labels = corpus
    rows = toxicity.scored(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    bad = [r for r in held if r.doc_id % 4 == 0]
    clean = [r for r in held if r.doc_id % 4]
    assert sum(r.predicted for r in bad) >= 0.9 * len(bad)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}
    # Toxic words at the very end of a long text are found as well.
    network = toxicity.fitted(docs, labels)
    clean_text = " ".join(prose(random.Random(1), 4000))
    both = {r.doc_id: r.logit for r in toxicity.logits(make([(1, clean_text), (2, f"{clean_text} idiot zorghle")]), network).collect()}
    assert both[2] > both[1] + 1


def test_odd_rows_and_no_labels(corpus, make, odd):
    _, labels = corpus
    docs = make(odd)
    rows = toxicity.scored(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)} and len(rows) == len(odd)
    network = gated.Network()
    found = toxicity.logits(docs, network).collect()
    assert len(found) == len(odd) and all(np.isfinite(r.logit) for r in found)
    assert toxicity.logits(make([]), network).collect() == []
    assert toxicity.scored(make([]), labels).collect() == []
    assert toxicity.without_toxic(docs, labels.limit(0)).count() == len(odd)


def best_cut(rows):
    """By trying every cut between two scores: the middle one of the best."""
    scores = sorted({x for x, _ in rows})
    cuts = [scores[0] - 0.5, *((a + b) / 2 for a, b in zip(scores, scores[1:])), scores[-1] + 0.5]
    bad, good = (np.sort([x for x, t in rows if t == k]) for k in (1, 0))
    loss = [int(np.searchsorted(bad, c)) * len(good) + 3 * int(len(good) - np.searchsorted(good, c)) * len(bad) for c in cuts]
    best = [c for c, x in zip(cuts, loss) if x == min(loss)]
    return best[len(best) // 2]


@pytest.mark.parametrize("n, score", [(140_000, "double(logit)"), (3000, "round(logit, 1)"), (40, "0.5D")])
def test_cut_reads_every_labelled_score(spark, n, score):
    """Of the largest case 28,000 scores count; the cut of 20,000 is another one."""
    kind = "int(xxhash64(id, 1) % 5 = 0) AS toxic"
    rows = spark.range(n).selectExpr("id AS doc_id", "xxhash64(id) / double(1e18) AS logit", kind)
    rows = rows.selectExpr("doc_id", f"{score} + toxic * 4 AS logit", "toxic")
    unseen = rows.where(~toxicity.held_out() & toxicity._kept_back()).select("logit", "toxic").toPandas()
    assert toxicity.cut(rows.drop("toxic"), rows.select("doc_id", "toxic")) == best_cut(list(unseen.itertuples(index=False)))


def test_cut_without_one_kind_or_any(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(40)], "doc_id bigint, logit double")
    labels = rows.selectExpr("doc_id", "0 AS toxic")
    most = rows.where(~toxicity.held_out()).agg({"logit": "max"}).first()[0]
    assert toxicity.cut(rows, labels) == most + 0.5
    assert toxicity.cut(rows, labels.limit(0)) == 0.0


def test_fit_reads_every_labelled_window(spark, make):
    rows = [(i, f"word{i % 7} of {i}") for i in range(6000)] + [(6000, " ".join(map(str, range(40_000)))), (6001, " "), (6002, None)]
    docs = make(rows)
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    texts, shares = toxicity.labelled(docs, labels)
    wanted = {r.doc_id for r in docs.where(~toxicity.held_out() & ~toxicity._kept_back()).collect()}
    assert shares == texts.rdd.getNumPartitions() == 1 and {r.doc_id for r in texts.collect()} == wanted and len(wanted) > 2 * 1700
    counts, n_texts, windows = toxicity._counted(texts)
    per_text = {i: len(gated.windows(np.array([len(t.split())]))[0]) if t and t.split() else 0 for i, t in rows}
    for kind in (0, 1):
        own = [i for i in wanted if i % 2 == kind]
        assert n_texts[kind] == len(own) and windows[kind] == sum(per_text[i] for i in own)
        [[at], _] = [x[:1] for x in gated.grams([b"word3"])]
        assert counts[kind, at] == sum(i % 7 == 3 and i < 6000 for i in own)


def test_shares_make_one_network(corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(toxicity, "SHARE", 60_000)
    texts, shares = toxicity.labelled(docs, labels)
    assert shares == texts.rdd.getNumPartitions() > 3
    network = toxicity.fitted(docs, labels)
    again = toxicity.fitted(docs, labels)
    assert all(np.array_equal(v, again.p[k]) for k, v in network.p.items())
    logit = {r.doc_id: r.logit for r in toxicity.logits(docs.where(toxicity.held_out()), network).collect()}
    bad, clean = ([x for i, x in logit.items() if (i % 4 == 0) == kind] for kind in (True, False))
    assert np.mean([a > b for a in bad for b in clean]) > 0.95


def test_mean_of_shares_weighs_windows(spark):
    network = gated.Network()
    telling = np.zeros(gated.BUCKETS, dtype=bool)
    telling[:3] = True
    network.p["emb"] *= telling[:, None]
    buckets = np.flatnonzero(telling)
    same = network.moved(buckets, network.flat(buckets))
    assert all(np.array_equal(v, same.p[k]) for k, v in network.p.items())
    texts = spark.createDataFrame([(i, f"a b{i}", i % 2) for i in range(30)], "doc_id bigint, text string, toxic int")
    texts = texts.repartition(2, "doc_id").sortWithinPartitions("doc_id")
    shares = texts.withColumn("share", spark_partition_id()).toPandas().groupby("share")
    (a, one), (b, two) = (
        (len(x), toxicity._moved(spark.createDataFrame(x[texts.columns]).coalesce(1), network, telling, 2, 1.0, clear=False))
        for _, x in shares
    )
    both = toxicity._moved(texts, network, telling, 2, 1.0, clear=False).flat(buckets)
    one, two = one.flat(buckets), two.flat(buckets)
    assert a != b and not np.allclose(one, two) and np.allclose(both, (a * one + b * two) / (a + b), atol=1e-6)


def brute_grams(word):
    marked, found = b"<" + word + b">", [zlib.crc32(word) + 7]
    for n in gated.GRAMS:
        for at in range(len(marked) - n + 1):
            value = 0
            for byte in marked[at : at + n]:
                value = value * 257 + byte
            found.append(value + (n << 60))
    return [(x * int(gated._MIX) % 2**64) >> 47 for x in found]


def test_grams_some_words_at_a_time(monkeypatch):
    monkeypatch.setattr(gated, "_WORDS", 3)
    words = [b"", b"a", b"long" * 9, b"\xc3\xa9t\xc3\xa9", b"word", b"a", b"idiot"]
    wanted = np.zeros(gated.BUCKETS, dtype=bool)
    wanted[brute_grams(b"idiot")[::2]] = True
    for some in (None, wanted):
        buckets, bounds = gated.grams_of(words, some)
        plain = [[x for x in brute_grams(w) if some is None or wanted[x]] for w in words]
        assert [buckets[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == plain
    network = gated.Network()
    network.p["emb"] *= wanted[:, None]
    sums = [network.p["emb"][brute_grams(w)].sum(axis=0) for w in words]
    assert np.allclose(network.vectors(words), [*sums, np.zeros(network.size)], atol=1e-6)
    assert len(gated.grams_of([])[0]) == 0


def test_counts_hold_little_beside_their_buckets():
    words = [b"word%d of" % i for i in range(120_000)]
    index = np.arange(len(words)).reshape(-1, gated.WINDOW)
    text = np.arange(len(index)) // 4
    tracemalloc.start()
    gated.texts_with(words, index, text, text % 2 == 0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Four bytes for each bucket (40 a word), twice while pieces are joined, and one piece's n-grams.
    assert most < 160e6


def test_windows_found_toxic_need_only_their_own_words(monkeypatch):
    rows = [("idiot zorgh idiot", 1), *((" ".join(f"w{i}x{k}" for k in range(40)), 0) for i in range(30)), ("idiot", 1)]
    share = toxicity._Share([pa.record_batch({"text": [t for t, _ in rows], "toxic": [k for _, k in rows]})])
    network = gated.Network()
    network.p["bias"] += 1
    bad = np.flatnonzero(share.toxic)
    logits = network.logits(share.words, share.index[bad])
    seen, vectors = [], gated.Network.vectors
    monkeypatch.setattr(gated.Network, "vectors", lambda self, words: (seen.append(words), vectors(self, words))[1])
    clear = share.clear(network)
    assert seen == [[b"idiot", b"zorgh"]] and clear[~share.toxic].all()
    best = [logits[share.text[bad] == t].max() for t in share.text[bad]]
    assert clear[bad].tolist() == ((logits > 0) | (logits >= np.array(best) - 1e-6)).tolist()


@pytest.mark.parametrize("partitions", [4, 23])
def test_shares_are_dealt_by_id(spark, make, monkeypatch, partitions):
    """However many partitions the join has, each share gets the texts of its own ids, whole and in order."""
    monkeypatch.setattr(toxicity, "SHARE", 10_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = make([(i, f"text {i} " * 20) for i in range(800)])
        texts, shares = toxicity.labelled(docs, docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic"))
        dealt = texts.select(spark_partition_id().alias("at"), expr(f"pmod(hash(doc_id), {shares})").alias("own")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert shares > 4 and shares != partitions and all(r["at"] == r["own"] for r in dealt)
    assert {r["at"] for r in dealt} == set(range(shares))
