"""Passages, lines and benchmark windows against brute-force versions."""

import hashlib
import math
import re

import numpy as np
import pytest

from midyear.llm.decontamination import contaminated_spans, remove_spans
from midyear.llm.lines import without_near_lines
from midyear.llm.substrings import without_repeats


def _random_texts(seed, n, vocabulary, lines=False):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(n):
        kind = rng.integers(0, 4)
        words = [f"w{x}" for x in rng.zipf(1.4, rng.integers(0, 40)) % vocabulary]
        if texts and kind == 0:
            base = texts[rng.integers(0, len(texts))].split(" ")
            at = int(rng.integers(0, len(base)))
            words = base[:at] + words[:2] + base[at + 1:]
        text = " ".join(words)
        if lines:
            text = re.sub(r" (w[1-3])\b", lambda m: "\n" + m[1], text)
        texts.append(text)
    return texts


def _repeats(texts, window):
    words = [t.split() for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] = seen.get(tuple(w[i : i + window]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("seed, window, gram, hot", [(1, 4, 2, 4096), (2, 5, 1, 1), (3, 7, 3, 2), (4, 3, 3, 0)])
def test_repeated_passages(documents, seed, window, gram, hot):
    texts = _random_texts(seed, 60, 12)
    docs = documents(list(enumerate(texts)))
    got = {r.doc_id: r for r in without_repeats(docs, window=window, gram=gram, hot_segments=hot, shard_words=40).collect()}
    for i, (n, gone, kept) in enumerate(_repeats(texts, window)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (n, gone, kept)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def _late_lines(docs, share):
    num, den = share
    rows = [(d, i, frozenset(line.encode().lower().split())) for d, text in docs for i, line in enumerate(text.split("\n"))]
    rows = sorted(r for r in rows if r[2])
    return {(d, i) for k, (d, i, s) in enumerate(rows)
            if any(den * len(s & t) >= num * len(s | t) for _, _, t in rows[:k])}


@pytest.mark.parametrize("seed, frequent, long, share", [(1, 256, 64, (4, 5)), (2, 1, 6, (4, 5)), (3, 2, 1000, (4, 5)),
                                                         (4, 1, 0, (1, 2)), (5, 3, 8, (1, 1))])
def test_near_lines(documents, seed, frequent, long, share):
    texts = list(enumerate(_random_texts(seed, 70, 25, lines=True)))
    got = {r.doc_id: r for r in without_near_lines(documents(texts), share=share, frequent=frequent, long=long).collect()}
    late = _late_lines(texts, share)
    assert len(late) > 10
    for d, text in texts:
        kept = "\n".join(line for i, line in enumerate(text.split("\n")) if (d, i) not in late)
        assert got[d].kept == kept and got[d].n_removed == sum(x == d for x, _ in late)


def test_long_lines_of_common_words(documents):
    line = " ".join(f"c{i}" for i in range(200))
    texts = [(k, line + f" own{k} other{k}") for k in range(50)] + [(60, "short and different words in a line")]
    got = {r.doc_id: r.n_removed for r in without_near_lines(documents(texts), frequent=10, long=64).collect()}
    assert got == {0: 0, 60: 0} | {k: 1 for k in range(1, 50)}


def _hits(text, items, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, raw in items:
        own = split(raw)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            w = own[i : i + window]
            for p in range(len(words) - len(w) + 1):
                if words[p : p + len(w)] == w:
                    hit |= set(range(p, p + len(w)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found), [w for i, w in enumerate(words) if i not in hit]


@pytest.mark.parametrize("shard_words, block_bytes", [(1_000_000, 16_000_000), (7, 60)])
def test_benchmark_windows(spark, documents, shard_words, block_bytes):
    texts = _random_texts(7, 50, 15) + ["W1, w2-W3! été w4", "ÉTÉ w4 w1"]
    items = [(k, t) for k, t in enumerate(texts[:8])] + [(100, "w1 w2"), (101, ""), (102, None), (103, "été w4"), (100, "w3")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(list(enumerate(texts)))
    found = contaminated_spans(docs, bench, ("doc_id", "text"), 4, shard_words, block_bytes)
    got = {r.doc_id: r for r in found.collect()}
    left = {r.doc_id: r.cleaned for r in remove_spans(found, ("doc_id",)).collect()}
    for i, text in enumerate(texts):
        n, hit, ids, kept = _hits(text, items, 4)
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (n, hit, ids), i
        assert _hits(left[i], [], 4)[3] == kept
        assert hit or left[i] == text


def test_prefix_lengths_are_exact():
    from midyear.llm.lines import Join

    join = Join("", 16, (4, 5), 1, 1)
    sizes = np.arange(1, 300)
    assert join.prefix(sizes).tolist() == [n - math.ceil(4 * n / 5) + 1 for n in sizes.tolist()]
    assert join.overlap(sizes, sizes + 3).tolist() == [math.ceil(4 * (2 * n + 3) / 9) for n in sizes.tolist()]
    assert sizes[join.alone(sizes)].tolist() == [1, 2, 3]


def test_a_frequent_line_is_sent_once_a_block(spark, tmp_path):
    import pandas as pd

    from midyear.llm.hasharrays import count_keys
    from midyear.llm.lines import Join, _sets
    from midyear.llm.texts import Words

    texts = [f"the same line in all\nbut this {i}\nthe same line in all" for i in range(300)]
    (tmp_path / "words").mkdir()
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    count_keys(docs, lambda some: Words(some, lower=True).hashes, str(tmp_path / "words"), 16)
    frame = pd.DataFrame({"id": list(range(300, 0, -1)), "raw": [t.encode() for t in texts]})
    sent = list(_sets(Join(str(tmp_path), 16, (4, 5), 256, 64))([frame]))
    rows = [x for part in sent for docs, lines in zip(part["docs"], part["lines"])
            for x in zip(np.frombuffer(docs, np.int64).tolist(), np.frombuffer(lines, np.int32).tolist())]
    assert len(rows) == 301 and rows.count((1, 0)) == 1 and (300, 0) not in rows


def test_a_bucket_of_sets_opens_each_file_once(spark, tmp_path, monkeypatch):
    import collections

    import pandas as pd

    from midyear.llm import hasharrays, lines
    from midyear.llm.texts import Words

    rng = np.random.default_rng(3)
    texts = ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 30, 12)) for _ in range(20)) for _ in range(60)]
    for name in ("words", "sets", "heads"):
        (tmp_path / name).mkdir()
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    hasharrays.count_keys(docs, lambda some: Words(some, lower=True).hashes, str(tmp_path / "words"), 16)
    join = lines.Join(str(tmp_path), 16, (4, 5), 256, 64)
    sent = pd.concat(list(lines._sets(join)([pd.DataFrame({"id": range(60), "raw": [t.encode() for t in texts]})])))
    stored = pd.concat([lines._store(join)(part) for _, part in sent.groupby("range_no")])
    opened, mapped = collections.Counter(), hasharrays._mapped
    monkeypatch.setattr(hasharrays, "OPEN", 2)
    monkeypatch.setattr(hasharrays, "_mapped", lambda path: opened.update([path]) or mapped(path))
    for _, bucket in stored.groupby("bucket"):
        opened.clear()
        lines._matches(join)(bucket)
        assert max(opened.values()) == 1


def test_pairs_are_verified_alike_on_copied_and_on_mapped_words(documents, monkeypatch):
    import pandas as pd

    from midyear.llm import lines

    docs = documents(list(enumerate(_random_texts(11, 80, 12, lines=True))))
    got = []
    for most in (16_000_000, 0):
        join, _ = lines.matched_lines(docs, (4, 5), 1, 1)
        sent = list(lines._sets(join)(iter([docs.selectExpr("doc_id AS id", "cast(text AS binary) AS raw").toPandas()])))
        sent = pd.concat(sent)
        stored = pd.concat([lines._store(join)(part) for _, part in sent.groupby("range_no")])
        monkeypatch.setattr(lines, "COPIED", most)
        found = pd.concat([lines._matches(join)(part) for _, part in stored.groupby("bucket")])
        got.append(sorted(set(map(tuple, found.to_numpy().tolist()))))
    assert got[0] and got[0] == got[1]
