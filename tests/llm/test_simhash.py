import random

import xxhash

from carelake.llm import components, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unsigned(x):
    return x % (1 << 64)


def classes(prints):
    """Class of each fingerprint by comparing all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_odd_rows_against_all_pairs(make, odd):
    rows = simhash.groups(make(odd)).collect()
    prints = {t: brute_print(t) for _, t, *_ in odd}
    assert sorted(map(lambda r: (r.doc_id or -1, unsigned(r.print)), rows)) == sorted(
        (d or -1, prints[t]) for d, t, *_ in odd
    )
    found = classes(set(prints.values()))
    least = {}
    for d, t, *_ in odd:
        c = found[prints[t]]
        least[c] = min(x for x in (least.get(c), d) if x is not None) if (d, least.get(c)) != (None, None) else None
    assert all(r.component_id == least[found[unsigned(r.print)]] for r in rows)


def linked(spark, prints, **options):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "print bigint"), **options)
    rows = components.components(links).collect()
    own = {unsigned(r.node): unsigned(r.root) for r in rows}
    groups = {}
    for p in prints:
        groups.setdefault(own.get(p, p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def expected(prints):
    found, groups = classes(prints), {}
    for p in prints:
        groups.setdefault(found[p], set()).add(p)
    return sorted(map(sorted, groups.values()))


def near_prints(seed, centres, each, flips):
    draw, out = random.Random(seed), set()
    for _ in range(centres):
        c = draw.getrandbits(64)
        for _ in range(each):
            p = c
            for b in draw.sample(range(64), draw.randint(0, flips)):
                p ^= 1 << b
            out.add(p)
    return out


def test_pigeonring_finds_all_links(spark):
    prints = near_prints(1, 60, 6, 4)
    assert linked(spark, prints) == expected(prints)


def test_crowded_keys_lose_no_link(spark):
    prints = near_prints(2, 3, 120, 4)
    assert linked(spark, prints, crowd=4) == expected(prints)
    assert linked(spark, prints) == expected(prints)


def test_other_distances_and_segments(spark):
    prints = near_prints(3, 30, 5, 3)
    rows = linked(spark, prints, segments=8)
    assert rows == expected(prints)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    rows = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_one_document_of_each_group_stays(make, odd):
    kept = simhash.without_near_copies(make(odd))
    assert kept.columns == make(odd).columns
    groups = simhash.groups(make(odd)).select("root").distinct().count()
    assert kept.count() == groups
    assert sum(r.doc_id == 2 for r in kept.collect()) == 1


def test_empty_table(make):
    assert simhash.groups(make([])).collect() == []
    assert simhash.without_near_copies(make([])).collect() == []
