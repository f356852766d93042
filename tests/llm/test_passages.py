"""Column-wise transforms and repeated passages against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from midyear.llm import columns
from midyear.llm.columns import range_least, repeated_starts
from midyear.llm.passages import segments_of, without_passages

TEXTS = st.lists(st.binary(max_size=60).map(lambda b: bytes(b"abc"[x % 3] for x in b)), max_size=8)


def _windows(texts, window):
    return Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([(1, 3), (2, 4), (4, 4), (8, 16)]), st.sampled_from([10, 10**7]))
def test_starts_of_repeated_windows(texts, sizes, spool):
    width, window = sizes
    counts = _windows(texts, window)
    want = [i + window <= len(t) and counts[t[i : i + window]] > 1 for t in texts for i in range(len(t))]
    assert repeated_starts(texts, window, width, spool).tolist() == want


def test_files_read_in_small_blocks(monkeypatch):
    monkeypatch.setattr(columns.Written.blocks, "__defaults__", (3,))
    texts = [b"abracadabra" * 4, b"cadabracab" * 3, b"zz"]
    counts = _windows(texts, 6)
    want = [i + 6 <= len(t) and counts[t[i : i + 6]] > 1 for t in texts for i in range(len(t))]
    assert repeated_starts(texts, 6, 2, spool=16).tolist() == want


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200), st.data())
def test_least_of_ranges(values, data):
    pairs = [sorted(data.draw(st.tuples(*[st.integers(0, len(values) - 1)] * 2))) for _ in range(9)]
    first, last = np.array(pairs).T
    got = range_least(np.array(values, np.uint8), first, last)
    assert got.tolist() == [min(values[a : b + 1]) for a, b in pairs]


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(2, 12))
def test_every_window_lies_in_one_segment(texts, gram):
    joined, starts, owner, first, last, keys = segments_of([*texts, None, b"a" * 40], 12, gram)
    found, key_of = [], {}
    for i, a, b, key in zip(owner.tolist(), first.tolist(), last.tolist(), keys.tolist()):
        windows = [joined[p : p + 12] for p in range(a, b + 1)]
        assert len(set(windows)) == len(windows)
        assert all(key_of.setdefault(w, key) == key for w in windows)
        found += [(i, p - int(starts[i])) for p in range(a, b + 1)]
    every = [*texts, b"", b"a" * 40]
    assert sorted(found) == [(i, p) for i, t in enumerate(every) for p in range(len(t) - 11)]


def _plain(rows, window):
    counts, out = _windows([t for _, t in rows], window), []
    for doc_id, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            gone[i : i + window] |= counts[text[i : i + window]] > 1
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [
    {"window": 12, "grams": (5,)},
    {"window": 12, "grams": (4, 8), "hot_segments": 1, "shard_bytes": 200},  # hot anchors split down to windows
    {"window": 20, "grams": (7, 9, 15), "hot_segments": 0},
])
def test_passages_as_counted(documents, options):
    rng = random.Random(2)
    rows = [(i if i % 7 else None, "".join(rng.choices("abé", k=rng.randint(0, 60)))) for i in range(60)]
    rows += [(1, "a" * 70), (2, None), (2, None), (3, "x" * 50), (3, "x" * 50)]
    cut = without_passages(documents(rows), **options)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in cut.collect()]
    assert sorted(got, key=str) == _plain([(d, (t or "").encode()) for d, t in rows], options["window"])


def test_passages_of_odd_rows(odd):
    rows = without_passages(odd, carry=("doc_id", "kept", "a b")).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    by = {r.doc_id: tuple(r)[1:] for r in rows}
    assert len(rows) == 12 and by[1] == by[2] == (0, 0, 0) and by[7] == (1, 0, 0)
    assert by[6][0] > 400_000
    assert without_passages(odd.limit(0)).collect() == []


def test_removed_runs_and_kept_bytes(documents):
    same = "0123456789"
    rows = without_passages(documents([(1, f"ab{same}cd{same}"), (2, "é")]), window=10, grams=(4,)).collect()
    by = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by[1].removed] == [(2, 12), (14, 24)] and bytes(by[1].kept) == b"abcd"
    assert by[2].removed == [] and bytes(by[2].kept) == "é".encode()
