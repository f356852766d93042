"""Grouped age model, scoring and disaggregation on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog.registry import derived, plain, query
from midyear.operators import model

# Quantity shipped as a population table: the line number is the age.
LINES = """
SELECT l_returnflag, l_linestatus, cast(year(l_shipdate) AS INT) AS year,
  l_linenumber AS age, CASE WHEN l_orderkey % 4999 = 11 AND l_linenumber = 3 THEN NULL
    ELSE l_quantity + l_linenumber % 3 * year(l_shipdate) % 7 END AS population
FROM {lineitem}"""
PER_SUPPLIER = """
SELECT l_suppkey, cast(year(l_shipdate) AS INT) AS year, l_linenumber AS age,
  l_quantity AS population FROM {lineitem}"""
# Totals of two later years, to be spread over the ages.
TOTALS = """
SELECT l_returnflag, l_linestatus, cast(year(l_shipdate) + 7 AS INT) AS year,
  sum(l_extendedprice) AS population FROM {lineitem} GROUP BY 1, 2, 3"""


def sql_fit(source: str, keys: list[str], rounds: int = 10, name: str = "fit") -> str:
    """CTEs that end in ``{name}``: keys, b0, b_year, b_age.

    Every round is an unrolled CTE; predictors are centred at 2000 and 4.
    """
    k = ", ".join(keys)

    def on(a: str, b: str, names: list[str]) -> str:
        return " AND ".join(f"{a}.{n} IS NOT DISTINCT FROM {b}.{n}" for n in names)

    ctes = [
        f"""{name}_cells AS (SELECT {k}, year, age, sum(population) AS part, count(*) AS n,
  count(population) AS m FROM ({plain(source)}) p GROUP BY ALL)""",
        f"""{name}_obs AS (SELECT {k}, year - 2000 AS y, age - 4 AS a, part / (n * t) AS p, n * t AS w
  FROM (SELECT *, sum(part) OVER g AS t, sum(n) OVER g = sum(m) OVER g AS whole
    FROM {name}_cells WINDOW g AS (PARTITION BY {k}, year)) x WHERE whole AND t > 0)""",
    ]
    for r in range(rounds):
        if r == 0:
            state = f"SELECT *, (w * p + 0.5) / (w + 1) AS mu, ln(mu / (1 - mu)) AS eta FROM {name}_obs"
        else:
            state = (
                f"SELECT o.*, c0 + c1 * y + c2 * a AS eta, 1 / (1 + exp(-eta)) AS mu "
                f"FROM {name}_obs o JOIN {name}_{r - 1} c ON {on('o', 'c', keys)}"
            )
        ctes.append(f"""{name}_{r} AS (SELECT {k}, (sz - c1 * sy - c2 * sa) / s AS c0, c1, c2 FROM (
  SELECT *, CASE WHEN flat_y THEN 0 WHEN flat_a THEN cyz / vy ELSE (cyz * va - caz * cya) / det END AS c1,
    CASE WHEN flat_a THEN 0 WHEN flat_y THEN caz / va ELSE (caz * vy - cyz * cya) / det END AS c2
  FROM (SELECT *, syy - sy * sy / s AS vy, saa - sa * sa / s AS va, sya - sy * sa / s AS cya,
      syz - sy * sz / s AS cyz, saz - sa * sz / s AS caz, vy * va - cya * cya AS det
    FROM (SELECT {k}, min(y) = max(y) AS flat_y, min(a) = max(a) AS flat_a, sum(u) AS s,
        sum(u * y) AS sy, sum(u * a) AS sa, sum(u * z) AS sz, sum(u * y * y) AS syy,
        sum(u * y * a) AS sya, sum(u * a * a) AS saa, sum(u * y * z) AS syz, sum(u * a * z) AS saz
      FROM (SELECT *, eta + (p - mu) / (mu * (1 - mu)) AS z, w * mu * (1 - mu) AS u
        FROM ({state}) s0) s1 GROUP BY ALL) s2) s3) s4)""")
    ctes.append(f"""{name} AS (SELECT {k}, c0 - 2000 * c1 - 4 * c2 AS b0, c1 AS b_year, c2 AS b_age
  FROM {name}_{rounds - 1})""")
    return ",\n".join(ctes)


KEYS = ["l_returnflag", "l_linestatus"]


@query("grouped_logit", f"""
WITH {sql_fit(LINES, KEYS)}
SELECT l_returnflag, l_linestatus, round(b0, 5) + 0.0 AS b0, round(b_year, 7) + 0.0 AS b_year,
  round(b_age, 7) + 0.0 AS b_age, TRUE AS converged FROM fit""")
def _grouped_logit(spark, sf):
    coefs = model.fit_grouped_logit(derived(spark, sf, LINES), KEYS)
    return coefs.select(*KEYS, *[(F.round(c, d) + F.lit(0.0)).alias(c)
                                 for c, d in (("b0", 5), ("b_year", 7), ("b_age", 7))], "converged")


@query("supplier_logit", f"""
WITH {sql_fit(PER_SUPPLIER, ['l_suppkey'])}
SELECT l_suppkey, round(b_year, 6) + 0.0 AS b_year, round(b_age, 6) + 0.0 AS b_age FROM fit""")
def _supplier_logit(spark, sf):
    coefs = model.fit_grouped_logit(derived(spark, sf, PER_SUPPLIER), ["l_suppkey"])
    return coefs.select("l_suppkey", *[(F.round(c, 6) + F.lit(0.0)).alias(c)
                                       for c in ("b_year", "b_age")])


@query("model_cells", f"""
WITH {sql_fit(LINES, KEYS, rounds=1)}
SELECT l_returnflag, l_linestatus, y + 2000 AS year, a + 4 AS age, round(p, 8) AS p,
  round(w, 4) AS w FROM fit_obs""")
def _model_cells(spark, sf):
    cells = model.model_cells(derived(spark, sf, LINES), KEYS)
    return cells.withColumns({"p": F.round("p", 8), "w": F.round("w", 4)})


# Ages without a year, years without an age, and ages far out where the share is next to 0 or 1.
_ODD = """
SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber = 1 THEN NULL ELSE cast(year(l_shipdate) AS INT)
    END AS year, CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN -900 WHEN 4 THEN 900 ELSE l_linenumber
    END AS age, l_extendedprice FROM {lineitem}"""
_ETA = "b0 + b_year * year + b_age * age"


@query("grouped_score", f"""
WITH {sql_fit(LINES, KEYS)}
SELECT c.l_returnflag, c.l_linestatus, year, age, n, round(1 / (1 + exp(-({_ETA}))), 7) AS predicted,
  round(ln(1 / (1 + exp(-({_ETA})))), 3) + 0.0 AS log_predicted
FROM (SELECT l_returnflag, l_linestatus, year, age, count(*) AS n FROM ({plain(_ODD)}) o GROUP BY ALL) c
JOIN fit f ON c.l_returnflag = f.l_returnflag AND c.l_linestatus = f.l_linestatus""")
def _grouped_score(spark, sf):
    coefs = model.fit_grouped_logit(derived(spark, sf, LINES), KEYS)
    counts = derived(spark, sf, _ODD).groupBy(*KEYS, "year", "age").agg(F.count(F.lit(1)).alias("n"))
    scored = model.score(counts, coefs, KEYS, no_model="drop")
    return scored.withColumns({"log_predicted": F.round(F.ln("predicted"), 3) + F.lit(0.0),
                               "predicted": F.round("predicted", 7)})


# The totals of the first year have lost their year, and one age is missing.
_SOME_TOTALS = f"""
SELECT l_returnflag, l_linestatus, CASE WHEN year = 2002 THEN NULL ELSE year END AS year, population
FROM ({TOTALS}) t"""
_SPLIT = f"""
WITH {sql_fit(LINES, KEYS)},
  grid AS (SELECT t.*, a.age, 1 / (1 + exp(-(b0 + b_year * t.year + b_age * a.age))) AS predicted
    FROM ({plain(_SOME_TOTALS)}) t JOIN fit USING (l_returnflag, l_linestatus),
      (SELECT DISTINCT l_linenumber AS age FROM lineitem) a)
SELECT l_returnflag, l_linestatus, year, age, CASE WHEN year IS NOT NULL THEN round(population * predicted
  / sum(predicted) OVER (PARTITION BY l_returnflag, l_linestatus, year), 0) END AS population FROM grid"""


@query("disaggregate", _SPLIT)
def _disaggregate(spark, sf):
    lines = derived(spark, sf, LINES)
    coefs = model.fit_grouped_logit(lines, KEYS)
    split = model.disaggregate(derived(spark, sf, _SOME_TOTALS), lines, coefs, KEYS, no_model="drop")
    return split.withColumn("population", F.round("population", 0))
