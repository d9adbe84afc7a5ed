"""The audit against a direct count over all documents and orders."""

import re
from itertools import permutations

import pytest

from carelake.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int, text string"


def failures(rows):
    """Each document's part and failed filters."""
    out = []
    for doc_id, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 50:
            failed.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            failed.add("C")
        if re.search("[#$%&*|]", text):
            failed.add("D")
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, *_ in rows):
            failed.add("E")
        out.append((doc_id, source or "", failed))
    return out


def brute(rows, labels):
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    docs, found = failures(rows), {}
    for part in {p for _, p, _ in docs}:
        mine = [(i, f) for i, p, f in docs if p == part]
        summed = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                summed[name] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in mine) - len(gone),
                    sum(f == {name} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(summed[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


@pytest.fixture(scope="module")
def rows(odd):
    plain = " ".join(f"w{i}" for i in range(60))
    more = [(20 + i, plain, "en", "abc"[i % 3]) for i in range(9)]
    loud = [(40, plain.upper(), "en", "a"), (41, plain + " #", "en", "b"), (42, "same " * 60, "en", None),
            (43, plain + " ", "en", "a"), (44, plain.replace(" ", "\xa0"), "en", "a")]
    return [*odd, *more, *loud, (20, plain, "en", "a"), (19, plain, "fr", "zz")]


LABELLED = [(20, 1, 0, "x"), (21, 0, 1, "x"), (21, 1, 0, "x"), (40, 1, 1, None), (None, 1, 1, "x"), (999, 1, 1, "x")]


def rows_of(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


@pytest.mark.parametrize("piece", [1000, 2])
def test_audit_equals_brute_force(spark, make, rows, piece):
    labels = spark.createDataFrame(LABELLED, LABELS)
    found = filter_audit.audit(make(rows), labels, piece)
    assert found.columns[3:] == [*filter_audit.COUNTS, "shapley"]
    assert rows_of(found) == brute(rows, LABELLED)


def test_copies_are_told_by_their_texts_not_their_hashes(spark, make, monkeypatch):
    plain = filter_audit._texts
    from pyspark.sql import functions as F

    def clashing(docs):
        return plain(docs).withColumns({"hash_a": F.lit(1).cast("bigint"), "hash_b": F.lit(2).cast("bigint")})

    monkeypatch.setattr(filter_audit, "_texts", clashing)
    rows = [(1, "a", "en", "s"), (2, "b", "en", "s"), (3, "a", "en", "s"), (4, "c", "en", "s"), (5, "b", "en", "s")]
    docs = make(rows)
    marks = filter_audit.repeated(docs, filter_audit.checked(docs)).select("doc_id").collect()
    assert sorted(r.doc_id for r in marks) == [3, 5]


def test_copies_are_dealt_over_tasks(spark, make):
    docs = make([(i, "the same text", "en", "s") for i in range(500)])
    found = filter_audit.marked(docs, piece=10).collect()
    assert {r.doc_id: r.mask for r in found} == {i: 1 if i == 0 else 17 for i in range(500)}
    assert all(r.docs == 1 for r in found)


def test_empty_tables(spark, make, rows):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(make([]), labels).collect() == []
    assert rows_of(filter_audit.audit(make(rows), labels)) == brute(rows, [])
