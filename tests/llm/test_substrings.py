"""Repeated passages: spans of segments, rows of repeated keys, and where texts go."""

import numpy as np

from midyear.llm.hasharrays import HashArray, save
from midyear.llm.substrings import segment_spans, without_repeats


def test_texts_stay_in_their_tasks(documents):
    out = without_repeats(documents([(i, "a b c d e f g h " * 8) for i in range(9)]), window=4, gram=2)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan


def test_passages_between_other_spaces(documents):
    plain = "one two three four five six"
    texts = ["x " + plain + " y", "one\ttwo three\nfour  five six", "z\r\n" + plain, "one two three four five", "a\x0bb c d"]
    got = {r.doc_id: (r.n_words, r.kept) for r in without_repeats(
        documents(list(enumerate(texts))), window=5, gram=2).collect()}
    assert got == {0: (8, "x y"), 1: (6, ""), 2: (7, "z"), 3: (5, ""), 4: (4, "a b c d")}


def test_segments_are_compared_at_their_place():
    segments = [b"a b c d", b"a b c e", b"p q r", b"s t u", b"v w x", b"v w x y"]
    counts, places = np.array([1, 1, 2, 1, 3, 2]), np.array([7, 7, 8, 9, 5, 5])
    assert segment_spans(segments, counts, places, 3) == [[(0, 3)], [(0, 3)], [(0, 3)], [], [(0, 3)], [(0, 4)]]
    once = segment_spans([b"k l m n", b"j k l m"], np.array([1, 4]), np.array([2, 2]), 3)
    assert once == [[(0, 3)], [(0, 4)]]


def test_all_rows_of_repeated_keys(tmp_path):
    rng = np.random.default_rng(1)
    keys = np.sort(rng.choice(np.arange(50, dtype=np.uint64) << np.uint64(58), 200))
    rows = np.arange(400).reshape(200, 2)
    for k in range(16):
        inside = (keys >> np.uint64(60)) == k
        if inside.any():
            save(f"{tmp_path}/{k:06d}.keys.npy", keys[inside])
            save(f"{tmp_path}/{k:06d}.counts.npy", rows[inside])
    asked = np.append(rng.choice(keys, 30), np.array([3, 2**63 + 1], np.uint64))
    at, found = HashArray(str(tmp_path), 16, (2,)).rows_of(asked)
    want = [(i, *row) for i, key in enumerate(asked) for row in rows[keys == key].tolist()]
    assert sorted(zip(at.tolist(), *found.T.tolist())) == sorted(want)
    none, empty = HashArray(str(tmp_path), 16, (2,)).rows_of(np.zeros(0, np.uint64))
    assert len(none) == 0 and empty.shape == (0, 2)
