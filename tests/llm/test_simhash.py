import random

import pytest
import xxhash

from tests.llm.messy import documents, prose
from tidemark.llm import graph, simhash


def brute_print(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def classes(values, radius=2):
    """The smallest value that links reach from each."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {v: find(v) for v in values}


def test_components_equal_brute_force(spark):
    docs = documents(spark)
    got = simhash.near_duplicates(docs).collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    root = classes({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = sorted(((i, f"{p:016x}", least.get(root[p])) for i, p in prints), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {3}


@pytest.mark.parametrize("radius, most", [(0, 4096), (1, 4096), (2, 4096), (3, 4096), (1, 3), (2, 3), (2, 30), (3, 10)])
def test_links_join_all_pairs_within_the_radius(spark, radius, most):
    chance = random.Random(radius)
    values = set()
    for _ in range(25):
        centre = chance.getrandbits(64)
        for _ in range(12):
            centre ^= 1 << chance.randrange(64) if chance.random() < 0.8 else 0b11 << chance.randrange(60)
            values.add(centre)
    if most < 4096:  # many fingerprints that share most of their blocks
        values |= {centre ^ chance.getrandbits(9) << 20 for _ in range(150)}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    found = simhash.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), radius, most)
    roots = {r.node: r.root for r in graph.components(found).collect()}
    groups = lambda of: sorted(sorted(v for v in values if of(v) == k) for k in {of(v) for v in values})
    expected = classes(values, radius)
    assert groups(lambda v: roots.get(signed[v], signed[v])) == groups(expected.get)


def test_finer_masks_keep_pairs_within_the_radius_together_and_end():
    for radius in (1, 2, 3):
        masks, rounds = simhash._finer(0, radius, simhash.AGREE), 0
        while any(64 - m.bit_count() > radius for m in masks):
            mask = min(masks, key=int.bit_count)
            free = [k for k in range(64) if not mask >> k & 1]
            masks, rounds = simhash._finer(mask, radius, 2), rounds + 1
            assert all(m & mask == mask and m != mask for m in masks)
            for _ in range(200):
                other = sum(1 << k for k in random.Random(rounds).sample(free, min(radius, len(free))))
                assert any(not other & m for m in masks)
        assert rounds < 8


def test_tree_search_finds_all_within_the_radius():
    chance, tree, values = random.Random(1), simhash.BKTree(), []
    for _ in range(400):
        value = chance.getrandbits(8)
        assert sorted(tree.near(value, 2)) == sorted({v for v in values if (v ^ value).bit_count() <= 2})
        tree.add(value)
        values.append(value)


def test_one_row_of_each_group_stays_whole(spark):
    docs = documents(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    root = classes({brute_print(r.text) for r in docs.collect()})
    groups = {}
    for r in docs.collect():
        groups.setdefault(root[brute_print(r.text)], []).append(r.doc_id)
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_components_of_a_long_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (7, 6), (7, 6)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark).limit(0)).collect() == []
    assert simhash.representatives(documents(spark).limit(0)).collect() == []


def test_single_words_and_long_texts():
    for text in ("a", "a b", "a b c", "a b c d", prose(3, 9000), "A B C"):
        assert simhash.fingerprint(text) == brute_print(text)
