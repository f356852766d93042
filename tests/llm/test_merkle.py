"""The manifest against a tree built in one piece."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from midyear.llm.merkle import dealt_third, exchange, fold, lower_ascii, manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_hash(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def _path(tree, i, fanout):
    steps = []
    for nodes in tree[:-1]:
        first = i - i % fanout
        steps.append((i % fanout, nodes[first:i] + nodes[i + 1 : first + fanout]))
        i //= fanout
    return steps


def _plain(rows, fanout=8):
    def leaf(r, text):
        fields = [r[0], r[1], r[2], r[3], text]
        return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf(r, r[4])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {g: _tree([x[1] for x in groups[g]], fanout) for g in order}
    top, out = _tree([trees[g][-1][0] for g in order], fanout), []
    root = top[-1][0]
    for j, g in enumerate(order):
        for i, (r, own) in enumerate(groups[g]):
            steps, node = _path(trees[g], i, fanout) + _path(top, j, fanout), own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            proof = _hash(*[x for _, others in steps for x in others])
            node = fold(node, steps)
            out.append((r[0], own, trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def _got(frame, **options):
    changed = (dealt_third(F.col("doc_id")), lower_ascii(F.col("text")))
    return sorted(map(tuple, manifest(frame, tampered=changed, **options).collect()), key=str)


def _rows(seed, n):
    rng = random.Random(seed)
    langs = ["en", "fr", None, *[f"l{k}" for k in range(9)]]
    rows = [(i, rng.choice(["a", None]), rng.choice(langs) if i % 2 else "en", i, rng.choice(["Hi", "é", None, ""]))
            for i in range(n)]
    return rows + [(None, "x", "en", None, "Z")] * 2 + [(5, "q", "en", 1, "dup")] * 2


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_as_one_tree(rows, levels):
    data = _rows(levels, 330)
    got = _got(rows(data, SCHEMA).repartition(3), block_levels=levels)
    assert got == _plain(data)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 26, 29])
def test_exchange_reaches_every_partition(rows, n):
    """Any number of partitions, at a fanout of three: all come to one root with all siblings."""
    nodes = [_hash(str(i)) for i in range(n)]
    frame = rows([(1, i, n, h) for i, h in enumerate(nodes)], "g int, at bigint, n bigint, node string")
    tree = _tree(nodes, 3)
    got = exchange(frame, ["g"], 3).collect()
    assert len(got) == n
    for r in got:
        assert r.root == tree[-1][0]
        assert [(s.spot, s.others) for s in r.proof] == _path(tree, r.at, 3)


def test_edges_of_the_manifest(rows):
    assert _got(rows([], SCHEMA)) == []
    lone = [(1, "s", "en", 3, "A" * 200_000)]
    frame = rows(lone, SCHEMA)
    for name in ("grp", "key", "leaf", "at", "n", "part", "line", "block", "root"):
        frame = frame.withColumn(name, F.lit("extra"))
    assert _got(frame) == _plain(lone)
    nothing = [(None, None, None, None, None)] * 3
    assert _got(rows(nothing, SCHEMA)) == _plain(nothing)
