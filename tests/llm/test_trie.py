"""The prefix trie against one built from whole conversations."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from midyear.llm.trie import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _plain(rows):
    def digest(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]

    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(t, key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))]
           for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    nodes, children, sums = {}, {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path in sorted(nodes, key=len, reverse=True):
        below, members = children.get(path, []), nodes[path]
        saved = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        sums[path] = (sum(sums[x][0] for x in below) or 1, saved + sum(sums[x][1] for x in below))
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(below),
                    *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed):
    rng, rows = random.Random(seed), []
    for c in [*range(-12, 50), 1000, 2003]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 12, 30])):
            role = rng.choice(["u", "a", None]) if rng.random() < 0.2 else "u"
            text = rng.choice(["x", "é", None, "yy"]) if rng.random() < 0.4 else "same"
            rows.append((c, rng.choice([t, t, t, None, 1]), role, text))
    return rows + [(None, 1, "u", "x")] * 3


def _got(frame, **options):
    return sorted((tuple(r)[:8] for r in prefix_trie(frame, **options).collect()), key=str)


@pytest.mark.parametrize("options", [
    {}, {"stretch": 3, "shard_conversations": 5}, {"stretch": 2, "shard_turns": 4}])
def test_trie_as_built_whole(rows, options):
    data = _rows(3)
    assert _got(rows(data, SCHEMA).repartition(3), **options) == _plain(data)


def test_edges_of_the_trie(rows):
    assert prefix_trie(rows([], SCHEMA)).collect() == []
    assert prefix_trie(rows([(None, 1, "u", "x")], SCHEMA)).collect() == []
    alone = [(5, None, None, None)]
    long = [(7, t, "u", "w" * 50_000 if t == 1 else "") for t in range(12)]
    for data in (alone, alone * 3, long):
        frame = rows(data, SCHEMA)
        for name in ("conv", "path", "parent", "n", "k", "start", "digest", "turns", "depth"):
            frame = frame.withColumn(name, F.lit("extra"))
        assert _got(frame) == _plain(data)


def test_one_hot_conversation_and_one_hot_turn(rows):
    data = [(1, t, "u", f"t{t % 3}") for t in range(300)]  # a third of the rows
    data += [(c, t, "u", "same") for c in range(10, 210) for t in range(3)]
    assert _got(rows(data, SCHEMA).repartition(4), stretch=16, shard_conversations=32) == _plain(data)
