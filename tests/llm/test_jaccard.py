"""The Jaccard join against all pairs."""

import pickle
import random

import numpy as np
import pytest
from cases import as_docs, order, pairs_of, words

from cartwheel.llm import jaccard
from cartwheel.llm.jaccard import MORE, components, in_order, jaccard_components, one_per_component, prefix_length, prefix_tree, shingle_set, similar_in_tree


def shingles(text):
    w = words((text or "").encode().lower().decode())
    return frozenset(tuple(w[p : p + 5]) for p in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(pairs):
    sets = {}
    for n, (i, t) in enumerate(pairs):
        sets[n] = (i, shingles(t))
    parent = {i: i for i, _ in pairs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in sets.items():
        for b, (j, y) in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(i), root(j)), key=order)
                parent[high] = low
    return sorted(((i, len(x), root(i)) for i, x in sets.values()), key=repr)


@pytest.mark.parametrize("last_count,block", [(8, 256), (2, 5)])
@pytest.mark.parametrize("name", ["messy_docs", "small_docs", "no_docs"])
def test_components_equal_all_pairs(request, name, last_count, block, monkeypatch):
    monkeypatch.setattr(jaccard, "LAST_COUNT", last_count)
    monkeypatch.setattr(jaccard, "GROUP_SETS", block)
    docs = request.getfixturevalue(name)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=repr)
    assert got == brute(pairs_of(docs))


def test_chains_of_similar_texts(spark):
    """Each text is similar to the next, the ends are not: links beyond the first of a prefix are found."""
    rng = random.Random(5)
    rows = []
    for family in range(4):
        text = [f"f{family}x{k}" for k in range(60)]
        for step in range(12):
            rows.append((family * 100 + step, " ".join(text), "en", "s"))
            text[rng.randrange(60)] = f"n{family}y{step}"
            text[rng.randrange(60)] = f"n{family}z{step}"
    rng.shuffle(rows)
    docs = as_docs(spark, rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=repr) == brute(pairs_of(docs))


def test_an_id_with_several_texts_links_what_each_of_them_links(spark):
    rng = random.Random(9)
    prose = lambda n, tag: " ".join(f"{tag}{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, d = (prose(50, tag) for tag in "abcd")
    rows = [(3, a), (7, b), (9, a), (9, b), (9, c), (12, c + " more"), (20, d), (20, "short"), (21, "x " + d), (5, "short"), (30, prose(50, "e")), (30, ""), (31, None), (31, d + " end")]
    docs = as_docs(spark, [(i, t, "en", "s") for i, t in rows])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=repr)
    assert got == brute(pairs_of(docs))
    assert {i: c for i, _, c in got} == {3: 3, 7: 3, 9: 3, 12: 3, 20: 5, 21: 5, 5: 5, 30: 30, 31: 5}


def test_one_row_of_each_component_stays(messy_docs):
    stay = one_per_component(messy_docs)
    assert stay.columns == messy_docs.columns
    want = {i for i, _, c in brute(pairs_of(messy_docs)) if i == c}
    assert {r.doc_id for r in stay.collect()} == want


def test_tree_walk_equals_pairwise_overlap():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(200)] + [np.arange(30, dtype=np.uint64)] * 3
    tree = prefix_tree(sets)
    for probe in sets:
        want = [i for i, s in enumerate(sets) if 4 * len(np.intersect1d(s, probe)) >= 3 * len(np.union1d(s, probe))]
        assert sorted(similar_in_tree(tree, probe)) == want


def test_frequent_shingles_come_last():
    s = shingle_set(b"a b c d e f g h i j k l m n")
    last = np.array([[s[0], 5], [s[2], 1]], np.uint64)
    keys = in_order(s, last[np.argsort(last[:, 0])])
    assert len(keys) == len(s) and list(keys[-2:]) == [(1 << 63) + 1, (1 << 63) + 5]


def test_similar_sets_share_enough_of_their_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        both = np.sort(rng.choice(10_000, rng.integers(4, 200), replace=False))
        own, other = (np.sort(rng.choice(both, rng.integers(int(0.75 * len(both)), len(both) + 1), replace=False)) for _ in range(2))
        if 4 * len(np.intersect1d(own, other)) < 3 * len(np.union1d(own, other)):
            continue
        shared = np.intersect1d(own[: prefix_length(len(own))], other[: prefix_length(len(other))])
        for n in (len(own), len(other)):
            assert len(shared) >= (n * 3 + 3) // 4 // MORE + 1


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}


def test_frequent_shingles_are_searched_where_they_lie(spark):
    """The sorted hashes lie in one piece in a task, too; else every search copies them."""
    _, last = jaccard.shapes(spark.createDataFrame([(i, "a b c d e f g") for i in range(20)], "doc_id long, text string").coalesce(1))
    found = pickle.loads(pickle.dumps(last, 5))
    assert len(found) == 3 and found[:, 0].flags.c_contiguous and (np.diff(found[:, 0].astype(object)) > 0).all()


def test_a_long_run_is_dropped_after_its_prefix(monkeypatch):
    rng = np.random.default_rng(5)
    probe, other = (np.unique(rng.integers(0, 2**62, 1000).astype(np.uint64)) for _ in range(2))
    tree, looked_up, search = prefix_tree([other]), [], np.searchsorted
    monkeypatch.setattr(jaccard.np, "searchsorted", lambda a, v, side="left": looked_up.append(np.size(v)) or search(a, v, side))
    assert list(similar_in_tree(tree, probe)) == [] and sum(looked_up) <= prefix_length(1000) + 1


def test_a_walk_finds_what_all_pairs_find():
    rng = np.random.default_rng(6)
    bases = [rng.integers(0, 2**62, n).astype(np.uint64) for n in (3, 40, 200, 400)]
    sets = []
    for base in bases:
        for _ in range(25):
            kept = base[rng.random(len(base)) < rng.choice([0.7, 0.87, 0.95, 1.0])]
            more = rng.integers(0, 2**62, rng.integers(0, 1 + len(base) // 4)).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[:1], kept, more])))
    tree = prefix_tree(sets)
    for probe in sets:
        similar = {k for k, s in enumerate(sets) if 4 * len(np.intersect1d(s, probe)) >= 3 * len(np.union1d(s, probe))}
        found = list(similar_in_tree(tree, probe))
        assert set(found) == similar and len(found) == len(similar)
