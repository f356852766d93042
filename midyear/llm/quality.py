"""Robust multivariate outliers among text statistics, per language and source.

Every document becomes a vector of transformed statistics.  Those of short texts have other centres and
wider spreads, so they are first counted from the median of their language and class of ``LENGTHS``, in
spreads of that class.  A group is the documents of a language and source, of any length.  For each group
a minimum-covariance-determinant estimate is found by concentration steps over all its rows: the ``share``
of rows nearest to a centre gives the next centre and covariance.  Each group begins from four starts
(unit spreads, the rows' directions, two slices of the rows by a hash); after ``steps`` steps the one with
the least determinant goes on until its determinant falls no more.  Documents whose Mahalanobis distance
exceeds the bound go.

Each step is two aggregations with partial sums, however the rows are spread over the groups; a
group's rows are never gathered.  Groups under ``least_rows`` documents (a covariance of eight statistics
needs about six rows each) are judged by the estimate of their language, those under it by that of all
documents; under ``least_rows`` in all, only the base rules hold.  Length classes widen in the same way.
Null and empty texts have no words and fail the base rules.  Null languages and sources are groups of their
own.  Repeated rows count each.  Without rows the result is empty.  Long texts are read whole.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.llm.texts import map_texts
from midyear.sources.shared import cut_lineage

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("length", "symbols", "dup_lines", "repeats", "capitals", "marks", "variety", "digits")
#: Least standard deviation of each transformed statistic: clean groups have constant ones.
FLOORS = (0.25, 0.03, 0.12, 0.10, 0.04, 0.05, 0.03, 0.08)
#: Variance that a statistic of a one-word text has by chance; a text of n words has an n-th of it.  For
#: shares of characters it is 1 / 4 over five characters; lines and repeats do not vary by chance.
CHANCE = (0.25, 0.05, 0.0, 0.0, 0.05, 0.05, 0.0, 0.05)
#: Words from which on the next class of lengths begins.
LENGTHS = (10, 40, 80, 160, 320, 640)
#: Slices of rows of which two are starts; a fall of the logarithmic volume that counts as none.
SLICES, SETTLED = 8, 1e-4

SYMBOLS = b"#*$%&|<>"
CAPITALS = string.ascii_uppercase.encode()
DIGITS = string.digits.encode()
MARKS = bytes(set(string.punctuation.encode()) - set(SYMBOLS))
TAILS = bytes(range(0x80, 0xC0))  # bytes that continue a code point


def _without(raw: bytes, some: bytes) -> int:
    return len(raw) - len(raw.translate(None, some))


def repeated_words(words: list[bytes], span: int = 5) -> int:
    """Words in ``span``-word windows that the text holds twice or more."""
    windows = list(zip(*[words[i:] for i in range(span)]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, upto = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + span - max(i, upto)
            upto = i + span
    return covered


def text_statistics(raw: bytes | None) -> tuple:
    """The base counts, then the transformed statistics (None without words)."""
    words = raw.split() if raw else []
    n_symbols = _without(raw, SYMBOLS) if raw else 0
    if not words:
        return 0, 0, n_symbols, 0, 0, None
    joined = b"".join(words)
    chars = len(joined.translate(None, TAILS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_dup = len(lines) - len(set(lines))
    n_words, n_repeat = len(words), repeated_words(words)
    features = (
        np.log(chars / n_words),
        np.sqrt(n_symbols / (chars + n_symbols)),
        np.sqrt(n_dup / len(lines)),
        np.sqrt(n_repeat / n_words),
        np.sqrt(_without(joined, CAPITALS) / chars),
        np.sqrt(_without(joined, MARKS) / chars),
        np.log(len(set(words)) + 9) / np.log(n_words + 9),
        np.sqrt(_without(joined, DIGITS) / chars),
    )
    return n_words, chars, n_symbols, n_dup, n_repeat, [float(x) for x in features]


def with_statistics(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    made = ", ".join(f"{name} bigint" for name in BASE) + ", features array<double>"

    def work(batches):
        for texts in batches:
            rows = list(map(text_statistics, texts))
            yield dict(zip([*BASE, "features"], zip(*rows) if rows else [[]] * 6))

    return map_texts(docs, work, made, carry)


def _chi2_bound(z: float, d: int) -> float:
    """The chi-squared value with ``d`` degrees at the normal deviate ``z`` (Wilson-Hilferty)."""
    return d * (1 - 2 / (9 * d) + z * np.sqrt(2 / (9 * d))) ** 3


def _fit(frames):
    """Centre, inverse covariance and its logarithmic volume of each start of a cell, from sums."""
    d = len(FEATURES)
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            n = row.n
            mean = np.array([getattr(row, f"s{i}") for i in range(d)]) / n
            cov = np.empty((d, d))
            for i in range(d):
                for j in range(i, d):
                    cov[i, j] = cov[j, i] = getattr(row, f"s{i}_{j}") / n - mean[i] * mean[j]
            cov += np.diag([getattr(row, f"l{i}") / n for i in range(d)])
            out.append((row.cell, row.start, mean.tolist(), np.linalg.inv(cov).ravel().tolist(), np.linalg.slogdet(cov)[1]))
        yield pd.DataFrame(out, columns=["cell", "start", "centre", "inverse", "volume"])


FITTED = "cell string, start int, centre array<double>, inverse array<double>, volume double"


def _estimates(rows: DataFrame) -> DataFrame:
    """The estimate of each start of a cell from all of ``rows`` (cell, start, z, slack)."""
    d = len(FEATURES)
    z, slack = F.col("z"), F.col("slack")
    sums = rows.groupBy("cell", "start").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(z[i]).alias(f"s{i}") for i in range(d)], *[F.sum(slack[i]).alias(f"l{i}") for i in range(d)],
        *[F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i in range(d) for j in range(i, d)])
    return cut_lineage(sums.mapInPandas(_fit, FITTED))


def _distance(d: int) -> Column:
    gap = [F.col("z")[i] - F.col("centre")[i] for i in range(d)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(i, d):
            total = total + gap[i] * gap[j] * F.col("inverse")[i * d + j] * (1 if i == j else 2)
    return total


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with names of their groups and of their length classes, nulls included."""
    name = lambda prefix, *names: F.concat(F.lit(prefix), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    rows = rows.withColumn("_class", sum((F.col("n_words") >= n).cast("int") for n in LENGTHS))
    return rows.withColumns({
        "_own": name("own:", "lang", "source"), "_lang": name("lang:", "lang"),
        "_sized": name("sized:", "lang", "_class"), "_size": name("size:", "_class")})


def _ladder(counts: DataFrame, own: str, wider: str, least_rows: int) -> tuple[DataFrame, DataFrame]:
    """Which cell serves each ``own`` group: itself, the wider one or all, whichever is large enough; and
    the cells that the rows of each group count for."""
    sized = counts.groupBy(own, wider).agg(F.sum("n").alias("n"))
    sized = sized.join(sized.groupBy(wider).agg(F.sum("n").alias("n_wider")), wider)
    cell = F.when(F.col("n") >= least_rows, F.col(own)).when(F.col("n_wider") >= least_rows, F.col(wider))
    sized = cut_lineage(sized.withColumn("cell", cell.otherwise("all")))
    parts = sized.select(own, F.explode(F.array(own, wider, F.lit("all"))).alias("cell"))
    parts = parts.join(sized.select("cell").distinct(), "cell", "left_semi")
    return sized.select(own, "cell"), cut_lineage(parts)


def _yardsticks(known: DataFrame, counts: DataFrame, least_rows: int) -> DataFrame:
    """Median, spread and share of the floor in it of each statistic, per language and class of lengths."""
    d = len(FEATURES)
    x, median = F.col("features"), F.col("median")
    cells, parts = _ladder(counts, "_sized", "_size", least_rows)
    known = known.select("_sized", "n_words", "features").join(parts, "_sized")
    medians = cut_lineage(known.groupBy("cell").agg(
        F.avg(1 / F.col("n_words")).alias("per_word"),
        F.array(*[F.percentile_approx(x[i], 0.5) for i in range(d)]).alias("median")))
    spread = known.join(medians, "cell").groupBy("cell").agg(
        *[F.percentile_approx(F.abs(x[i] - median[i]), 0.5).alias(f"m{i}") for i in range(d)]).join(medians, "cell")
    floor = [FLOORS[i] ** 2 + CHANCE[i] * F.col("per_word") for i in range(d)]
    wide = [F.pow(1.4826 * F.col(f"m{i}"), 2) + floor[i] for i in range(d)]
    spread = spread.select("cell", "median", F.array(*[F.sqrt(w) for w in wide]).alias("spread"),
                           F.array(*[f / w for f, w in zip(floor, wide)]).alias("slack"))
    return cut_lineage(cells.join(spread, "cell").select("_sized", "median", "spread", "slack"))


def _starts(known: DataFrame) -> DataFrame:
    """Rows by start: their directions from the centre, and two slices of them by a hash."""
    d, z = len(FEATURES), F.col("z")
    length = F.sqrt(sum(z[i] * z[i] for i in range(d)))
    length = F.when(length > 0, length).otherwise(F.lit(1.0))
    part = F.pmod(F.xxhash64("z"), F.lit(SLICES)).cast("int")
    direction = F.array(*[z[i] / length for i in range(d)])
    return known.select("cell", F.lit(1).alias("start"), direction.alias("z"), "slack").union(
        known.filter(part < 2).select("cell", (part + 2).alias("start"), "z", "slack"))


def _concentrated(known: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """One step: the estimates of the ``share`` of rows nearest to each present centre."""
    placed = known.join(params.drop("volume"), "cell").withColumn("d2", _distance(len(FEATURES)))
    near = cut_lineage(placed.groupBy("cell", "start").agg(F.percentile_approx("d2", share).alias("bound")))
    core = placed.select("cell", "start", "z", "slack", "d2").join(near, ["cell", "start"]).filter("d2 <= bound")
    return _estimates(core)


def _least(params: DataFrame) -> DataFrame:
    """Of the estimates of a cell the one with the least volume."""
    best = F.min(F.struct("volume", "start", "centre", "inverse")).alias("best")
    return cut_lineage(params.groupBy("cell").agg(best).select("cell", "best.start", "best.centre", "best.inverse", "best.volume"))


def robust_estimates(rows: DataFrame, share: float, steps: int, least_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The yardsticks of lengths, which cell judges each group, and the cells' ``centre, inverse, volume, scale``.

    Runs jobs over ``rows`` (lang, source, n_words, features), which should be written already.
    Cells with too few rows are left out.
    """
    d = len(FEATURES)
    rows = _named(rows.filter("features IS NOT NULL"))
    counts = cut_lineage(rows.groupBy("_own", "_lang", "_sized", "_size").agg(F.count(F.lit(1)).alias("n")))
    yards = _yardsticks(rows, counts, least_rows)
    cells, parts = _ladder(counts, "_own", "_lang", least_rows)
    known = cut_lineage(rows.join(yards, "_sized").join(parts, "_own").select("cell", _standard().alias("z"), "slack"))
    names = known.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(names.filter(F.col("n") >= least_rows))
    unit = F.array(*[F.lit(float(i == j)) for i in range(d) for j in range(d)])
    plain = sizes.select("cell", F.lit(0).alias("start"), F.array(*[F.lit(0.0)] * d).alias("centre"),
                         unit.alias("inverse"), F.lit(0.0).alias("volume"))
    params = plain.union(_estimates(_starts(known)).join(sizes, "cell", "left_semi"))
    for _ in range(steps):
        params = _concentrated(known, params, share)
    live, settled = _least(params), None
    while live.count():  # every step lowers a cell's volume by a part of SETTLED, or settles the cell
        now = _concentrated(known, live, share).select("cell", *[F.col(c).alias(f"_{c}") for c in ("centre", "inverse", "volume")])
        both = cut_lineage(live.join(now, "cell").withColumn("falls", F.col("_volume") < F.col("volume") - SETTLED))
        done = both.filter("NOT falls").select("cell", "start", "centre", "inverse", "volume")
        settled = done if settled is None else settled.union(done)
        live = both.filter("falls").select("cell", "start", F.col("_centre").alias("centre"),
                                           F.col("_inverse").alias("inverse"), F.col("_volume").alias("volume"))
    if settled is None:
        settled = live
    placed = known.join(settled, "cell").withColumn("d2", _distance(d))
    middle = placed.groupBy("cell").agg(F.percentile_approx("d2", 0.5).alias("middle"))
    # the nearest share underestimates the spread; where the floors make it wide, it stays
    scale = F.least(F.lit(1.0), _chi2_bound(0.0, d) / F.nullif(F.col("middle"), F.lit(0.0)))
    scaled = settled.drop("start").join(cut_lineage(middle), "cell").withColumn("scale", scale).drop("middle")
    return yards, cells, cut_lineage(scaled)


def _standard() -> Column:
    """Statistics as gaps from the median of their length, in spreads of that length."""
    return F.array(*[(F.col("features")[i] - F.col("median")[i]) / F.col("spread")[i] for i in range(len(FEATURES))])


def quality_rules(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    share: float = 0.75,
    steps: int = 2,
    deviate: float = 2.33,
    least_rows: int = 50,
) -> DataFrame:
    """Columns ``carry``, the base counts, ``base_failed``, ``distance`` and ``kept`` per document.

    ``distance`` is squared, and null without words or an estimate.  The texts are read twice, once for
    the estimates and once for the verdicts, so that they are neither written nor shuffled.
    """
    groups = ("lang", "source")
    held = with_statistics(docs.select(*groups, "text"), groups)
    yards, cells, scaled = robust_estimates(
        cut_lineage(held.select(*groups, "n_words", "features")), share, steps, least_rows)
    rows = docs.select(F.struct(*dict.fromkeys(carry)).alias("row"), *groups, "text")
    judged = _named(with_statistics(rows, ("row", *groups))).join(cells, "_own", "left").join(
        scaled, "cell", "left").join(yards, "_sized", "left")
    distance = F.col("scale") * _distance(len(FEATURES))
    judged = judged.withColumn("z", _standard()).withColumn("distance", distance)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    usual = F.coalesce(F.col("distance") <= _chi2_bound(deviate, len(FEATURES)), F.lit(True))
    return judged.select(
        "row.*", *BASE, failed.alias("base_failed"), (~failed & usual).alias("kept"), "distance")
