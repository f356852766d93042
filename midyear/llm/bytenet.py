"""A byte-level convolutional network in numpy that scores the quality of whole documents.

Bytes are embedded, ``FILTERS`` filters of ``WIDTH`` bytes pass over the text, each chunk of
``CHUNK`` bytes (a new one every ``STEP`` bytes, so that chunks overlap) keeps the maximum of each
filter, and a logistic unit turns the maxima into a chunk's log odds.  A document's score is the
probability at the mean of its chunks' log odds; chunks cover the document to its last byte.

The unit weighs the maxima anew by how much of a chunk is missing, as short chunks have lower ones.
Filters and unit are learned together by gradient descent on the loss of whole documents, whose odds are
the means over all their chunks, and each round of a short and a longer part of each, cut from any
place.  The sample is at most ``per_class`` documents of either label, in the order of a hash of their id, of
at most ``doc_bytes`` each and ``label_bytes`` together; a document is in it whole or not at all.  Null and empty texts count as one chunk
of zero bytes; repeated rows are learned from once per id and scored alike.  Without labels of both kinds,
as with empty tables, every score is 0.5.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from midyear.llm.texts import map_texts

EMBED, WIDTH, STRIDE, FILTERS = 8, 8, 2, 32
CHUNK, STEP = 512, 256
GROUP = STEP // STRIDE  # filter positions that begin within a step


class ByteNet:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.offset = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)  # for the maxima, and for them times the missing part
        self.size_weight = np.zeros(1, np.float32)  # of that part
        self.bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.offset, self.out, self.size_weight, self.bias]

    def _answers(self, raw: np.ndarray) -> np.ndarray:
        """What the filters answer at every second byte of ``raw``."""
        points = self.embed[raw].reshape(-1)
        n = (len(raw) - WIDTH) // STRIDE + 1
        windows = np.lib.stride_tricks.as_strided(
            points, (n, WIDTH * EMBED), (4 * EMBED * STRIDE, 4), writeable=False)
        return np.maximum(windows @ self.filters + self.offset, 0)

    def odds(self, maxima: np.ndarray, missing: np.ndarray) -> np.ndarray:
        both = maxima @ self.out.reshape(2, FILTERS).T
        return both[:, 0] + missing * both[:, 1] + self.size_weight * missing + self.bias

    def score(self, raw: bytes | None, block: int = 1 << 20) -> float:
        """The document's probability of label 1, read in blocks of ``block`` bytes."""
        raw = raw or b""
        steps = max(1, -(-max(0, len(raw) - (CHUNK - STEP)) // STEP))  # chunks
        maxima = []
        for first in range(0, max(1, len(raw)), block):
            part = raw[first : first + block + WIDTH]
            part = np.frombuffer(part + bytes(max(0, WIDTH + STRIDE - len(part))), np.uint8)
            answers = self._answers(part)[: block // STRIDE]
            cuts = np.arange(0, len(answers), GROUP)
            maxima.append(np.maximum.reduceat(answers, cuts, axis=0))
        half = np.concatenate(maxima)  # by steps; a chunk is two of them
        if len(half) > 1:
            half = np.concatenate([np.maximum(half[:-1], half[1:]), half[-1:]])
        half = half[:steps]
        sizes = np.minimum(CHUNK, np.maximum(len(raw) - STEP * np.arange(len(half)), 0)) / CHUNK
        odds = self.odds(half, (1 - sizes).astype(np.float32))
        return float(1 / (1 + np.exp(-np.clip(odds.mean(dtype=np.float64), -30, 30))))


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts side by side, each from a whole step on; where their steps begin, and which windows are theirs."""
    sizes = np.array([len(t) for t in texts])
    steps = np.maximum(1, -(-sizes // STEP))
    first = np.concatenate([[0], np.cumsum(steps)])
    raw = np.frombuffer(b"".join(t.ljust(n * STEP, b"\0") for t, n in zip(texts, steps)) + bytes(WIDTH), np.uint8)
    spots = np.arange(first[-1] * GROUP) * STRIDE - np.repeat(first[:-1] * STEP, steps * GROUP)
    within = spots <= np.repeat(np.maximum(sizes, WIDTH + STRIDE) - WIDTH, steps * GROUP)
    return raw, first, within


def _step_maxima(net: ByteNet, raw: np.ndarray, within: np.ndarray, piece: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's maximum in each step, and the byte where its window begins; ``piece`` steps at once."""
    n = len(within) // GROUP
    maxima, where = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64)
    for a in range(0, n, piece):
        b = min(n, a + piece)
        answers = net._answers(raw[a * STEP : b * STEP + WIDTH])[: (b - a) * GROUP]
        answers[~within[a * GROUP : b * GROUP]] = 0
        answers = answers.reshape(b - a, GROUP, FILTERS)
        best = answers.argmax(axis=1)
        maxima[a:b] = np.take_along_axis(answers, best[:, None], axis=1)[:, 0]
        where[a:b] = (np.arange(a, b)[:, None] * GROUP + best) * STRIDE
    return maxima, where


def _slopes(net: ByteNet, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Slopes of the loss on the documents' odds, the means over all their chunks."""
    raw, first, within = _laid_out(texts)
    maxima, where = _step_maxima(net, raw, within)
    sizes = np.array([len(t) for t in texts])
    n_chunks = np.maximum(1, -(-np.maximum(0, sizes - (CHUNK - STEP)) // STEP))
    doc = np.repeat(np.arange(len(texts)), n_chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    low = first[doc] + nth
    high = np.minimum(low + 1, first[doc + 1] - 1)  # a chunk is two steps, or a text's only one
    later = maxima[high] > maxima[low]
    maxima, where = np.where(later, maxima[high], maxima[low]), np.where(later, where[high], where[low])
    missing = (1 - np.clip(sizes[doc] - STEP * nth, 0, CHUNK) / CHUNK).astype(np.float32)
    odds = np.bincount(doc, net.odds(maxima, missing)) / n_chunks
    error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels) * weight / len(texts)
    error = (error / n_chunks)[doc].astype(np.float32)
    through = error[:, None] * (net.out[:FILTERS] + missing[:, None] * net.out[FILTERS:]) * (maxima > 0)
    spots = raw[where[:, :, None] + np.arange(WIDTH)]  # chunk, filter, byte
    picked = net.embed[spots].reshape(len(doc), FILTERS, WIDTH * EMBED)
    d_filters = np.einsum("cf,cfw->wf", through, picked)
    d_points = (through[:, :, None] * net.filters.T[None]).reshape(-1, EMBED)
    d_embed = np.stack([np.bincount(spots.reshape(-1), d_points[:, e], 256) for e in range(EMBED)], axis=1)
    d_out = np.concatenate([maxima.T @ error, maxima.T @ (error * missing)]) + 1e-4 * net.out
    return [d_embed.astype(np.float32), d_filters, through.sum(axis=0), d_out,
            np.array([(error * missing).sum()], np.float32), np.array([error.sum()], np.float32)]


def _copies(texts: list[bytes], rng: np.random.Generator, least: int) -> list[bytes]:
    """A part of each text from any place, with a length from ``least`` to ``CHUNK`` bytes, whatever its label."""
    lengths = np.exp(rng.uniform(np.log(least), np.log(CHUNK), len(texts))).astype(int)
    starts = [int(rng.integers(0, max(0, len(t) - n) + 1)) for t, n in zip(texts, lengths)]
    return [t[a : a + n] for t, a, n in zip(texts, starts, lengths)]


def train(texts: list[bytes], labels: np.ndarray, rounds: int = 8, batch: int = 64, seed: int = 5) -> ByteNet:
    """Adam on the log loss of whole documents and, each round, of new copies of parts; both labels weigh alike."""
    net, rng = ByteNet(seed), np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean()).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step, n_steps = 0, rounds * -(-3 * len(texts) // batch)
    for _ in range(rounds):
        seen = texts + _copies(texts, rng, 6) + _copies(texts, rng, CHUNK // 2)
        order = rng.permutation(len(seen))
        for first in range(0, len(order), batch):
            some = order[first : first + batch]
            own = some % len(texts)
            slopes = _slopes(net, [seen[i] for i in some], labels[own], weight[own])
            step += 1
            rate = 0.01 * (1 - 0.9 * step / n_steps)
            for p, slope, (m, v) in zip(net.parameters(), slopes, moments):
                m *= 0.9
                m += 0.1 * slope
                v *= 0.999
                v += 0.001 * slope**2
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            if step <= 1:
                net.out[:FILTERS] += rng.normal(0, 0.1, FILTERS).astype(np.float32)
    return net


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 2000, doc_bytes: int = 1 << 16, label_bytes: int = 1 << 23,
) -> ByteNet | None:
    """A network from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); runs its jobs."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    taken = []
    for label in (0, 1):
        some = known.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        taken.append(some)
    ids = F.broadcast(taken[0].union(taken[1]))  # at most 2 * per_class rows
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    once = docs.select("doc_id", raw.alias("raw")).filter(F.length("raw") <= doc_bytes).join(ids, "doc_id").groupBy(
        "doc_id", "quality").agg(F.min("raw").alias("raw"))  # of rows with one id the least text
    so_far = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)  # over at most per_class rows
    rows = once.withColumn("bytes", F.sum(F.length("raw")).over(so_far)).filter(
        F.col("bytes") <= label_bytes).drop("bytes").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    if rows["quality"].nunique() < 2:
        return None
    return train([bytes(t) for t in rows["raw"]], rows["quality"].to_numpy(np.float32))


def score(docs: DataFrame, net: ByteNet | None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` and ``score``."""
    def work(batches):
        for texts in batches:
            yield {"score": [0.5 if net is None else net.score(raw) for raw in texts]}

    return map_texts(docs, work, "score double", carry)
