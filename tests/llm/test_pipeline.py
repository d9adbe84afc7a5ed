"""The corpus pipeline stage by stage against the operators' own results."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from carelake.llm import line_dedup, shared, simhash, source_mix, tokens, toxicity
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"
DOCUMENT = list(corpus_pipeline.DOCUMENT)


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    docs, found = shared.table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = shared.written(stage(spark, docs, SF), f"test-{name}")
        found[name] = docs, out
        docs = out
    return found


def rows(df):
    return Counter(map(tuple, df.select(*DOCUMENT).collect()))


def test_stages_in_order(stages):
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "source_mix", "packing"]
    assert all(out.columns == DOCUMENT for name, (_, out) in stages.items() if name != "packing")


def test_toxic_documents_go_and_others_stay(spark, stages):
    before, after = stages["toxicity"]
    scored = toxicity.scored(before, shared.table(spark, SF, "labels")).collect()
    bad = {r.doc_id for r in scored if r.predicted}
    assert bad
    assert rows(after) == Counter({r: n for r, n in rows(before).items() if r[0] not in bad})


def test_lines_of_earlier_documents_go(stages):
    before, after = stages["line_dedup"]
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(before).collect()}
    left = {r.doc_id: r for r in after.collect()}
    for doc, r in kept.items():
        empty = r.n_dropped and not r.kept_text.strip(shared.WHITE)
        assert (doc not in left) == bool(empty)
        assert empty or (left[doc].text, left[doc].n_chars) == (r.kept_text, len(r.kept_text))


def test_one_document_of_each_group_stays(stages):
    before, after = stages["simhash"]
    named = {r.component_id for r in simhash.groups(before).collect()}
    assert rows(after) == Counter({r: 1 for r in rows(before) if r[0] in named})


def test_sources_come_near_their_targets(stages):
    before, after = stages["source_mix"]
    taken = source_mix.taken(before).collect()
    target = {r.source: r.target for r in taken}
    got, longest = defaultdict(int), defaultdict(int)
    for r in after.collect():
        got[r.source] += len((r.text or "").encode().split())
    for r in taken:
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(got[s] - t) <= longest[s] + 0.01 * t + 10 for s, t in target.items())
    assert max(rows(after).values()) <= 3


def test_packing_holds_every_token(stages):
    before, after = stages["packing"]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    check_packing(after.collect(), docs, tokens.encoder(tokens.default_path()), 2048)


def test_run_is_the_stages_one_after_the_other(spark, stages):
    pieces = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32")
    assert Counter(map(tuple, pieces.collect())) == Counter(
        map(tuple, stages["packing"][1].select("doc_id", "piece", "length", "ids_crc32").collect())
    )
