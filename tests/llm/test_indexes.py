"""FM-index, vantage-point tree and components against plain versions."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from midyear.llm.components import component_stars
from midyear.llm.fmindex import Bits, FMIndex
from midyear.llm.simhash import fingerprint
from midyear.llm.vptree import build_tree, close_stars, route


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=120), st.integers(1, 9))
def test_index_finds_and_locates(text, sample):
    text = np.array([0, *text])
    index = FMIndex(text, 7, sample)
    n = len(text)
    assert index.order.tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
    assert index.locate(np.arange(n)).tolist() == index.order.tolist()
    for size in (1, 2, 4):
        patterns = [text[i : i + size] for i in range(1, n - size + 1)] + [np.arange(1, size + 1)]
        low, high = index.search(np.array(patterns), np.full(len(patterns), size))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(n - size + 1) if (text[i : i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_patterns_of_unequal_length():
    index = FMIndex(np.array([0, 1, 2, 3, 1, 2, 1]), 4)
    low, high = index.search(np.array([[-1, 1, 2], [1, 2, 3], [-1, -1, 1]]), np.array([2, 3, 1]))
    assert (high - low).tolist() == [2, 1, 3]


def _brute(points, reach):
    parent = {p: p for p in points}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if bin(a ^ b).count("1") <= reach:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def _clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, n // 4).astype(np.uint64)
    out = set(centres.tolist())
    while len(out) < n:
        c = int(rng.choice(centres))
        for bit in rng.integers(0, 64, rng.integers(1, 4)):
            c ^= 1 << int(bit)
        out.add(c)
    return sorted(out)


def test_tree_links_as_all_pairs_do():
    for seed, n, leaf in ((1, 400, 16), (2, 900, 64), (3, 30, 4)):
        points = _clustered(seed, n)
        links = close_stars(np.array(points, np.uint64), 2, leaf)
        parent = {p: p for p in points}

        def find(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in links:
            assert a in parent and b in parent
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        assert {p: find(p) for p in points} == _brute(points, 2)


def test_close_points_meet_in_a_leaf_of_the_shared_tree():
    points = np.array(_clustered(5, 800), np.uint64)
    tree = build_tree(points[::3], len(points), 60, 2)
    leaves = {}
    for leaf, at in route(points, tree, 2):
        for i in at.tolist():
            leaves.setdefault(i, set()).add(leaf)
    assert len(tree) > 5 and len(leaves) == len(points)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i] ^ points) <= 2).tolist():
            assert leaves[i] & leaves[j]


def test_dense_cluster_of_points():
    points = [0] + [1 << i for i in range(64)] + [3 << i for i in range(63)]
    links = close_stars(np.array(points, np.uint64), 2, 16)
    assert {a for a, _ in links} | {b for _, b in links} == set(points)


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {r.a: r.b for r in component_stars(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in list(parent) if find(n) != n}


def test_fingerprint():
    assert fingerprint(None) == fingerprint(b" \n") == 0
    assert fingerprint(b"A b C d e") == fingerprint(b"a\tb  c d E")
    assert fingerprint(b"a b") != 0
    words = " ".join(f"w{i}" for i in range(500)).encode()
    assert fingerprint(words) == fingerprint(words, block=7)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.integers(1, 9))
def test_parents_from_the_tree_alone(symbols, depth):
    text = np.array([0, *symbols], np.int64)
    index = FMIndex(text, 4)
    index.drop_order()
    ring = [tuple(np.roll(text, -i)[:depth]) for i in sorted(range(len(text)), key=lambda i: [*text[i:]])]
    same = [a == b for a, b in zip(ring, ring[1:])]
    parents = index.parents(depth)
    marks = [bool(x) for x in parents.get(np.arange(index.n + 1))]
    assert marks == [True, *[not x for x in same], True]
    rows = np.arange(index.n)
    low, high = index.widen(parents, rows, rows + 1)
    for row, a, b in zip(rows, low, high):
        assert ring[a:b] == [ring[row]] * (b - a) and ring.count(ring[row]) == b - a


def test_select():
    bits = np.random.default_rng(1).random(1000) < 0.1
    bits[300:700] = False
    assert (Bits(bits).select(np.arange(bits.sum())) == np.flatnonzero(bits)).all()
