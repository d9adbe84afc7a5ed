import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from carelake.llm import line_dedup, shared

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Rows under one id count as one document."""
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(WHITE))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = float("inf") if doc is None else doc
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == own]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(lines), len(lines) - len(kept), digest))
    return Counter(out)


def result(docs):
    rows = line_dedup.dedup_lines(docs).collect()
    digest = lambda r: hashlib.sha256(r.kept_text.encode()).hexdigest()
    return Counter((r.doc_id, r.n_lines, r.n_dropped, digest(r)) for r in rows)


def test_odd_rows(make, odd):
    assert result(make(odd)) == brute([r[:2] for r in odd])


def test_long_documents_and_words_of_the_bitmap(make):
    draw = random.Random(3)
    lines = [f"a line with number {i}" for i in range(400)]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.choice([1, 63, 64, 65, 300])))) for i in range(40)]
    assert result(make(rows)) == brute(rows)


def test_heavy_lines_are_salted_and_exact(make, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE", 0.9)
    monkeypatch.setattr(line_dedup, "HEAVY_SHARE", 20)
    rows = [(i, f"Everyone has this line\n  own line of {i} \nEVERYONE HAS THIS LINE") for i in range(200)]
    assert result(make(rows)) == brute(rows)


def test_empty_table(make):
    assert line_dedup.dedup_lines(make([])).collect() == []
    assert line_dedup.without_repeated_lines(make([])).collect() == []


def test_stage_drops_documents_left_empty_and_keeps_others(make, odd):
    left = line_dedup.without_repeated_lines(make(odd)).collect()
    assert 9 not in {r.doc_id for r in left}
    assert {3, 4, 5, 1} <= {r.doc_id for r in left}


@pytest.mark.parametrize("text", ["a", "Straße É", "ABC é", ""])
def test_lower_ascii(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    got = rows.select(shared.lower_ascii(F.col("t")).alias("t")).first().t
    assert got == "".join(c.lower() if c.isascii() else c for c in text)
