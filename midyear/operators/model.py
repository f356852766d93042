"""One binomial-logit age model per key, fitted and scored as grouped Spark jobs.

The response is a row's share of its (key, year) total, the predictors are year and
age, the prior weight is the total.  Each fitting round is one aggregation of nine sums
per key, solved in columns; cells are never gathered per key, so a key that owns a
large part of the rows costs no more than its share of partial sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.numbers import share, strict_sum, sum_of
from midyear.operators.joins import join_on
from midyear.operators.shape import expand_over
from midyear.operators.totals import group_sum
from midyear.sources.shared import cut_lineage, fresh_path

MAX_ROUNDS = 25
ROUNDS_PER_JOB = 5
# Rounds converge quadratically: a change below this leaves an error far below it.
TOLERANCE = 1e-9
# Fixed value: change of the deviance, relative to 0.1 and itself, below which a fit has converged.
DEVIANCE_TOLERANCE = 1e-8
# Fixed value: the fit bounds the linear predictor, so that no weight becomes 0 in doubles.
FIT_BOUND = 30.0


def logistic(eta: Column) -> Column:
    """NULL and NaN have no share."""
    known = eta.isNotNull() & ~F.isnan(eta)
    return F.when(known, 1 / (1 + F.exp(-eta)))


def model_cells(population: DataFrame, keys: Sequence[str], year: str = "year",
                age: str = "age", value: str = "population") -> DataFrame:
    """One row per (key, year, age): mean response ``p`` and weight ``w``.

    A NULL population makes its whole (key, year) total NULL, and such years, like years
    that total 0, take no part in the fit.
    """
    cells = population.groupBy(*keys, F.col(year).alias("year"), F.col(age).alias("age")).agg(
        strict_sum(F.col(value), sum_of(population, value)).alias("part"), F.count(F.lit(1)).alias("n")
    )
    totals = group_sum(cells, [*keys, "year"], "part", "total").filter(F.col("total") > 0)
    rows = join_on(cells, totals, [*keys, "year"], "inner")
    return rows.filter(F.col("year").isNotNull() & F.col("age").isNotNull()).select(
        *keys,
        "year",
        "age",
        (F.col("part") / (F.col("n") * F.col("total"))).alias("p"),
        (F.col("n") * F.col("total")).alias("w"),
    )


# Centres of the predictors and which of them can be estimated, per key.  Years and ages
# are whole numbers, so the rank of the design is found exactly: the sums are decimals.
DESIGN = """
SELECT __id, year_mean, age_mean, vy > 0 AS has_year,
  va > 0 AND NOT (vy > 0 AND cya * cya = vy * va) AS has_age,
  CAST(NULL AS DOUBLE) AS c0, CAST(NULL AS DOUBLE) AS c1, CAST(NULL AS DOUBLE) AS c2,
  CAST(NULL AS DOUBLE) AS dev
FROM (SELECT __id, avg(year) AS year_mean, avg(age) AS age_mean,
  CAST(count(*) * sum(y * y) - sum(y) * sum(y) AS DOUBLE) AS vy,
  CAST(count(*) * sum(a * a) - sum(a) * sum(a) AS DOUBLE) AS va,
  CAST(count(*) * sum(y * a) - sum(y) * sum(a) AS DOUBLE) AS cya
FROM (SELECT *, CAST(year AS DECIMAL(10, 0)) AS y, CAST(age AS DECIMAL(10, 0)) AS a FROM {cells})
GROUP BY __id)
"""


# One round, innermost step first.  ``old_*`` are the last coefficients, NULL before the first round,
# which starts from the observed shares.  Cells and state have one partitioning, by ``__id``: a round
# exchanges neither.
ROUND = """
SELECT __id, year_mean, age_mean, has_year, has_age, c0, c1, c2, dev,
  abs(dev - old_dev) / (0.1D + abs(dev)) AS dev_moved,
  greatest(abs(c0 - old_c0) / (1 + abs(c0)), abs(c1 - old_c1) / (1 + abs(c1)),
           abs(c2 - old_c2) / (1 + abs(c2))) AS moved
FROM (SELECT *, (sz - c1 * sy - c2 * sa) / s AS c0
FROM (SELECT *,
  CASE WHEN has_year AND has_age THEN (cyz * va - caz * cya) / (vy * va - cya * cya)
       WHEN has_year THEN cyz / vy ELSE 0D END AS c1,
  CASE WHEN has_year AND has_age THEN (caz * vy - cyz * cya) / (vy * va - cya * cya)
       WHEN has_age THEN caz / va ELSE 0D END AS c2
FROM (SELECT *, syy - sy * sy / s AS vy, saa - sa * sa / s AS va, sya - sy * sa / s AS cya,
  syz - sy * sz / s AS cyz, saz - sa * sz / s AS caz
FROM (SELECT __id, year_mean, age_mean, has_year, has_age, old_c0, old_c1, old_c2, old_dev,
  sum(2 * w * (CASE WHEN p > 0 THEN p * ln(p / mu) ELSE 0D END
    + CASE WHEN p < 1 THEN (1 - p) * ln((1 - p) / (1 - mu)) ELSE 0D END)) AS dev,
  sum(u) AS s, sum(u * y) AS sy, sum(u * a) AS sa, sum(u * z) AS sz,
  sum(u * y * y) AS syy, sum(u * y * a) AS sya, sum(u * a * a) AS saa,
  sum(u * y * z) AS syz, sum(u * a * z) AS saz
FROM (SELECT *, eta + (p - mu) / (mu * (1 - mu)) AS z, w * mu * (1 - mu) AS u
FROM (SELECT *, 1 / (1 + exp(-greatest(least(eta, bound), -bound))) AS mu
FROM (SELECT *, coalesce(old_c0 + old_c1 * y + old_c2 * a, ln(start / (1 - start))) AS eta
FROM (SELECT cells.*, year_mean, age_mean, has_year, has_age,
  c0 AS old_c0, c1 AS old_c1, c2 AS old_c2, dev AS old_dev, year - year_mean AS y, age - age_mean AS a,
  (w * p + 0.5D) / (w + 1) AS start
FROM {cells} AS cells JOIN {state} AS state ON cells.__id = state.__id))))
GROUP BY __id, year_mean, age_mean, has_year, has_age, old_c0, old_c1, old_c2, old_dev))))
"""


ROUND = ROUND.replace("bound", f"{FIT_BOUND}D")


def _round(cells: DataFrame, state: DataFrame) -> DataFrame:
    """One reweighted least-squares round: new coefficients per key and their change.

    ``state`` holds the design of each key and its last coefficients.
    """
    return cells.sparkSession.sql(ROUND, cells=cells, state=state)


@contextmanager
def _by_bucket(cells: DataFrame, keys: Sequence[str]) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The cells bucketed by the number of their key, and the keys with their numbers.

    One file a bucket, in order of year and age, so that all rounds add a key's cells up in one order.
    """
    spark, n = cells.sparkSession, int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = cut_lineage(cells.select(*keys).distinct().withColumn("__id", F.monotonically_increasing_id()))
    name, order = f"midyear_cells_{uuid.uuid4().hex}", ["__id", "year", "age"]
    dealt = join_on(cells, numbered, keys, "inner").select("__id", "year", "age", "p", "w").repartition(n, "__id")
    dealt.sortWithinPartitions(*order).write.bucketBy(n, "__id").sortBy(*order).option(
        "path", fresh_path(spark, "cells")).saveAsTable(name)
    try:
        yield spark.table(name), numbered
    finally:
        spark.sql(f"DROP TABLE {name}")


def fit_grouped_logit(
    population: DataFrame,
    keys: Sequence[str],
    year: str = "year",
    age: str = "age",
    value: str = "population",
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(keys, b0, b_year, b_age, converged)`` of one model per key.

    Runs jobs: the cells are written to the shared folder, then once more in buckets by key, and the
    coefficients after every ``ROUNDS_PER_JOB`` rounds; rounds exchange no rows but those coefficients.  Keys whose coefficients have stopped moving leave the
    rounds; those whose deviance still moves after ``max_rounds`` are marked, and ``with_model``
    refuses them.  A predictor that is constant, or that repeats an earlier one, has a NULL coefficient.
    Years and ages are whole numbers.
    """
    clash = {"year", "age", "p", "w", "__id"} & set(keys)
    if clash:
        raise ValueError(f"rename key columns {sorted(clash)}: the fit uses these names")
    cells = cut_lineage(model_cells(population, keys, year, age, value))
    with _by_bucket(cells, keys) as (bucketed, numbered):
        state = cells.sparkSession.sql(DESIGN, cells=bucketed)
        moving, settled = F.coalesce(F.col("moved"), F.lit(1.0)) > tolerance, []
        for first in range(0, max_rounds, ROUNDS_PER_JOB):
            for _ in range(first, min(first + ROUNDS_PER_JOB, max_rounds)):
                state = _round(bucketed, state)
            state = cut_lineage(state)
            settled.append(state.filter(~moving).withColumn("converged", F.lit(True)))
            state = state.filter(moving)
            if state.limit(1).count() == 0:
                break
    # coefficients run away where shares of 0 and 1 are parted; the deviance comes to rest there
    rest = F.coalesce(F.col("dev_moved") < DEVIANCE_TOLERANCE, F.lit(False))
    every = reduce(DataFrame.union, settled, state.withColumn("converged", rest))
    return numbered.join(every, "__id").select(
        *keys,
        (F.col("c0") - F.col("c1") * F.col("year_mean") - F.col("c2") * F.col("age_mean"))
        .alias("b0"),
        F.when(F.col("has_year"), F.col("c1")).alias("b_year"),
        F.when(F.col("has_age"), F.col("c2")).alias("b_age"),
        "converged",
    )


def linear_predictor(year: Column, age: Column) -> Column:
    """Of a row that carries ``b0, b_year, b_age``; a NULL slope takes no part."""
    zero = F.lit(0.0)
    return (
        F.col("b0")
        + F.coalesce("b_year", zero) * year
        + F.coalesce("b_age", zero) * age
    )


def with_model(df: DataFrame, coefs: DataFrame, keys: Sequence[str], no_model: str = "fail") -> DataFrame:
    """Attach coefficients; a row with a model that did not converge fails.

    So does a row without a model (its key has no year that the fit could use), unless ``no_model`` is
    ``drop``: such rows leave then.
    """
    if no_model not in ("fail", "drop"):
        raise ValueError(f"no_model is fail or drop, not {no_model}")
    done = F.col("converged") if "converged" in coefs.columns else F.lit(True)
    joined = join_on(df, coefs.select(*keys, "b0", "b_year", "b_age", done.alias("__done")), keys,
                     "left" if no_model == "fail" else "inner")
    missing = F.raise_error(
        F.concat(F.lit("no converged model for "), F.to_json(F.struct(*keys)))
    ).cast("double")
    return joined.withColumn("b0", F.when(F.col("__done"), F.col("b0")).otherwise(missing)).drop("__done")


def score(df: DataFrame, coefs: DataFrame, keys: Sequence[str], year: str = "year",
          age: str = "age", into: str = "predicted", no_model: str = "fail") -> DataFrame:
    """Predicted share of every row; ``no_model`` as in ``with_model``."""
    scored = with_model(df, coefs, keys, no_model).withColumn(
        into, logistic(linear_predictor(F.col(year), F.col(age)))
    )
    return scored.drop("b0", "b_year", "b_age")


def disaggregate(
    totals: DataFrame,
    ages: DataFrame,
    coefs: DataFrame,
    keys: Sequence[str],
    year: str = "year",
    value: str = "population",
    age: str = "age",
    no_model: str = "fail",
) -> DataFrame:
    """Spread each total over the distinct ages of ``ages`` by predicted share.

    Shares are normalised within (keys, year) by one aggregation of the expanded rows.  A total
    without a year has no shares: its parts are NULL.  ``no_model`` as in ``with_model``.
    """
    group = [*keys, year]
    keep = [c for c in totals.columns if c != value]
    cells = expand_over(with_model(totals, coefs, keys, no_model), ages, age).withColumn(
        "predicted", logistic(linear_predictor(F.col(year), F.col(age)))
    )
    sums = group_sum(cells, group, "predicted", "__sum")
    return join_on(cells, sums, group, "inner").select(
        *keep,
        F.col(age),
        (F.col(value) * share(F.col("predicted"), F.col("__sum"))).alias(value),
    )
