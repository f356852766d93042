"""Language identification in two steps: the family first, then the language within it.

A text becomes the square roots of its hashed byte trigram counts, A-Z and other capitals lowered,
at length one.  A linear support vector machine per family (one against the rest) picks the
family; within it, one machine for each pair of languages (one against one) votes.  The machines are
fitted on at most about ``sample`` labelled rows, as many of each language, chosen by a hash of the
document id; every text is read whole, in blocks.

Null texts and texts without a letter are ``und`` with score 0; so is everything when no row is
labelled.  Null languages are not learned from.  Languages without a known family are families
of their own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.llm.texts import map_texts

# Language codes by family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la lad oc pt rm ro sc",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "ckb fa ku ps tg",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "uralic": "et fi hu se",
    "semitic": "am ar he mt ti",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
DIMENSIONS = 4096
BLOCK = 2_000_000


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], f"only {lang}")


def trigram_vectors(texts: list[bytes]) -> np.ndarray:
    """A row per text; no trigram reaches over two texts or depends on how texts are blocked."""
    counts = np.zeros((len(texts), DIMENSIONS), np.float32)
    pieces, size = [], 0

    def add():
        raw = np.frombuffer(b"".join(p for _, p in pieces), np.uint8).astype(np.uint32)
        owner = np.repeat([i for i, _ in pieces], [len(p) for _, p in pieces])
        part = np.repeat(np.arange(len(pieces)), [len(p) for _, p in pieces])
        code = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
        inside = part[:-2] == part[2:]
        base = pieces[0][0]
        rows = pieces[-1][0] - base + 1
        spot = (owner[:-2][inside] - base) * DIMENSIONS + code[inside]
        counts[base : base + rows] += np.bincount(spot, minlength=rows * DIMENSIONS).reshape(rows, -1)

    for i, raw in enumerate(texts):
        spaced = b"".join([b" ", b" ".join(raw.split()), b" "])
        for first in range(0, max(1, len(spaced) - 2), BLOCK):
            pieces.append((i, spaced[first : first + BLOCK + 2]))
            size += len(pieces[-1][1])
            if size > BLOCK or i - pieces[0][0] >= 500:
                add()
                pieces, size = [], 0
    if pieces:
        add()
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.sqrt(counts / total)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 300, penalty: float = 1e-4) -> np.ndarray:
    """Weights (the last one is the offset) for squared hinge loss, classes weighing alike."""
    x = np.hstack([x, np.full((len(x), 1), 0.3, np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, rate = w, 1.0 / (2.2 + penalty)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        slope = penalty * ahead - 2 * x.T @ (weight * y * slack)
        step = ahead - rate * slope
        ahead = step + k / (k + 3) * (step - w)
        w = step
    return w


class Hierarchy:
    """The fitted machines: one a family, one a pair of languages within a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(lang) for lang in self.langs})
        self.members = [[i for i, lang in enumerate(self.langs) if family_of(lang) == f] for f in self.families]
        own = np.array([self.langs.index(lang) for lang in langs], np.int64)
        kin = np.array([self.families.index(family_of(lang)) for lang in langs], np.int64)
        self.pairs = [pair for some in self.members for pair in combinations(some, 2)]
        machines = [fit_svm(x, np.where(kin == f, 1, -1).astype(np.float32)) for f in range(len(self.families))
                    if len(self.families) > 1]
        for a, b in self.pairs:
            some = (own == a) | (own == b)
            machines.append(fit_svm(x[some], np.where(own[some] == a, 1, -1).astype(np.float32)))
        self.weights = np.stack(machines, axis=1) if machines else np.zeros((DIMENSIONS + 1, 0), np.float32)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights[:-1] + 0.3 * self.weights[-1]
        n_families = len(self.families) if len(self.families) > 1 else 0
        sure = np.ones(len(x))
        family = np.zeros(len(x), np.int64)
        if n_families:
            family = margins[:, :n_families].argmax(axis=1)
            sure = 1 / (1 + np.exp(-4 * margins[:, :n_families].max(axis=1).astype(np.float64)))
        votes = np.zeros((len(x), len(self.langs)))
        for k, (a, b) in enumerate(self.pairs):
            belief = 1 / (1 + np.exp(-4 * margins[:, n_families + k].astype(np.float64)))
            votes[:, a] += (belief >= 0.5) + belief * 1e-3  # beliefs part equal votes
            votes[:, b] += (belief < 0.5) + (1 - belief) * 1e-3
        langs, scores = [], np.empty(len(x))
        for i, f in enumerate(family.tolist()):
            some = self.members[f]
            best = max(some, key=lambda m: votes[i, m])
            langs.append(self.langs[best])
            duels = max(1, len(some) - 1)
            share = 1.0 if len(some) == 1 else (votes[i, best] - int(votes[i, best])) * 1e3 / duels
            scores[i] = sure[i] * share
        return langs, np.clip(scores, 0.0, 1.0)


def _lowered(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.when(F.col("text").rlike(r"\p{L}"), F.lower("text")).alias("text"))


def fit(labelled: DataFrame, sample: int = 2000) -> Hierarchy | None:
    """Machines from ``doc_id, text, lang`` (runs its jobs); None without labelled rows."""
    known = labelled.filter(F.col("lang").isNotNull())
    totals = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    if not totals:
        return None
    each = max(20, sample // len(totals))
    bound = F.create_map(*[F.lit(v) for lang, n in totals.items() for v in (lang, each / n)])[F.col("lang")]
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = known.filter(place < bound).select("doc_id", "lang", "text").distinct()  # repeated rows are one
    chosen = _lowered(some, "lang", "doc_id").filter(F.col("text").isNotNull())

    def vectors(batches):
        for texts in batches:
            yield {"vector": [v.tobytes() for v in trigram_vectors(texts)]}

    rows = map_texts(chosen, vectors, "vector binary", ("lang", "doc_id")).toPandas()  # within the sample's bound
    if not len(rows):
        return None
    rows = rows.sort_values(["doc_id", "lang", "vector"], kind="stable")
    x = np.stack([np.frombuffer(v, np.float32) for v in rows["vector"]])
    return Hierarchy(x, rows["lang"].tolist())


def predict(docs: DataFrame, model: Hierarchy | None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` with ``lang_pred`` and ``score``."""
    def work(batches):
        for texts in batches:
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            there = [i for i, raw in enumerate(texts) if raw is not None]
            if there and model:
                found, sure = model.predict(trigram_vectors([texts[i] for i in there]))
                for i, lang, s in zip(there, found, sure.tolist()):
                    langs[i], scores[i] = lang, s
            yield {"lang_pred": langs, "score": scores}

    rows = _lowered(docs, F.struct(*dict.fromkeys(carry)).alias("row"))
    return map_texts(rows, work, "lang_pred string, score double", ("row",)).select("row.*", "lang_pred", "score")
