import random
import re
from collections import Counter

import pytest

from carelake.llm import measures, pairwise_quality, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            inside |= {i, i + 1, i + 2}
    seen, same = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), same, len(inside)


def test_counts_against_brute_force(odd):
    draw = random.Random(1)
    texts = [t for _, t, *_ in odd] + [
        "".join(draw.choices("ab é#|\n\t", k=draw.choice([3, 40, 400]))) for _ in range(60)
    ]
    for text in texts:
        assert measures.measure(text)[:5] == brute_counts(text)


def test_windows_of_many_distinct_words():
    words = [b"%d" % (i % 5000) for i in range(10_001)]
    assert measures.repeated_words(words) == (10_001, 5000)


def prose(i, words=80):
    draw = random.Random(i)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(3, 7))) for _ in range(words))


def test_rules_adapt_to_language_and_source(make):
    rows = [(i, prose(i), "en", "plain") for i in range(300)]
    rows += [(1000 + i, " | ".join(prose(i).split()), "en", "tables") for i in range(300)]
    rows += [(5000, " | ".join(prose(7).split()), "en", "plain"), (5001, "short text", "en", "plain"),
             (5002, " ".join(["same three words"] * 30), "en", "plain")]
    got = {r.doc_id: r for r in quality_rules.judged(make(rows)).collect()}
    assert not got[5000].kept and not got[5000].base_failed
    assert got[5001].base_failed and got[5002].base_failed
    assert all(got[d].kept for d, *_ in rows if d < 5000)


def test_small_sources_lean_on_their_language_and_it_on_the_whole(make):
    rows = [(i, prose(i), "en", f"s{i % 20}") for i in range(100)]
    rows += [(200, prose(200), "xx", "lone"), (201, " ".join(f"{w}###" for w in prose(3).split()), None, None)]
    got = {r.doc_id: r.kept for r in quality_rules.judged(make(rows)).collect()}
    assert got.pop(201) is False
    assert all(got.values())


def test_two_sources_get_different_limits(make):
    stars = lambda i, n: " ".join(w + "*" * (j < n) for j, w in enumerate(prose(i).split()))
    rows = [(i, stars(i, i % 20), "en", "starred") for i in range(400)]
    rows += [(1000 + i, stars(i, i % 2), "en", "bare") for i in range(400)]
    rows += [(5000, stars(1, 40), "en", "starred"), (5001, stars(2, 40), "en", "bare"), (5002, stars(3, 80), "en", "starred")]
    judged = quality_rules.judged(make(rows))
    got = {r.doc_id: r for r in judged.collect()}
    a, b = got[0].limit_symbols_per_word, got[1000].limit_symbols_per_word
    # No floor decides: the limit is the high quantile and its distance from the median.
    assert a.up > 0.1 > 1 / 80 and a.high > 10 * b.high
    assert got[5000].kept and not got[5001].kept and not got[5002].kept
    assert all(got[d].kept for d, *_ in rows if d < 5000)


def test_a_prior_weighs_less_the_larger_a_source_is(make):
    symbols = {}
    for n in (10, 1000):
        rows = [(i, " ".join(w + "#" for w in prose(i).split()), "en", "hash") for i in range(n)]
        rows += [(5000 + i, prose(i), "en", "plain") for i in range(300)]
        symbols[n] = quality_rules.judged(make(rows)).where("source = 'hash'").first().limit_symbols_per_word
    assert symbols[10].low == 0
    assert symbols[1000].low == pytest.approx(1, rel=0.02)


def test_quantiles_of_merged_sketches(spark, make):
    rows = quality_rules.measured(make([(i, prose(i, 60 + i % 50), "en", f"s{i % 9}") for i in range(500)]))
    exact = sorted(r.chars_per_word for r in rows.where("NOT base_failed").collect())
    merged = quality_rules.quantiles(quality_rules.sketches(rows), []).where("ratio = 'chars_per_word'").first()
    for q, got in ((0.1, merged.low), (0.5, merged.middle), (0.9, merged.high)):
        assert got == pytest.approx(exact[int(q * len(exact))], rel=0.02)


def test_rules_on_odd_rows_and_empty_table(make, odd):
    rows = quality_rules.judged(make(odd)).collect()
    want = Counter((d, *brute_counts(t)) for d, t, *_ in odd)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.kept is False for r in rows if r.base_failed)
    assert quality_rules.judged(make([])).collect() == []


@pytest.fixture(scope="module")
def corpus(make, spark):
    rows = [(i, prose(i, 20 + i % 90)) for i in range(600)]
    rows += [(1000 + i, "!! ".join(prose(i, 20 + i % 90).upper().split())) for i in range(150)]
    labels = spark.createDataFrame(
        [(d, int(d < 1000), 0) for d, _ in rows] + [(5, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    return make(rows), labels


def test_pairs_separate_held_out_documents(corpus):
    docs, labels = corpus
    rows = pairwise_quality.scored(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.predicted == (r.doc_id < 1000) for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_fit_is_bounded_and_repeatable(corpus):
    docs, labels = corpus
    a, b = ({r.doc_id: r.score for r in pairwise_quality.scored(docs, labels, 100).collect()} for _ in range(2))
    assert a == b


def test_scores_of_odd_rows_and_without_labels(make, odd, corpus, spark):
    _, labels = corpus
    rows = pairwise_quality.scored(make(odd), labels).collect()
    assert len(rows) == len(odd) and all(r.score is not None for r in rows)
    rows = pairwise_quality.scored(make(odd), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.5, 0)}
    assert pairwise_quality.scored(make([]), labels).collect() == []
