"""Projections, unions, reshaping, sections and totals on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from midyear.catalog.registry import derived, plain, query, table
from midyear.functions import recode
from midyear.operators import ordered, shape, totals
from midyear.operators.joins import unknown_names
from midyear.plans.layouts import (
    age_sections, department_blocks, distinct_columns, spanning_names,
)
from midyear.sources.shared import cut_lineage

# --- projections -----------------------------------------------------------------


@query("project_rename", """
SELECT c_custkey AS muni_id, c_name AS municipality, c_nationkey AS department FROM customer""")
def _project_rename(spark, sf):
    return shape.select_as(
        table(spark, sf, "customer"),
        {"muni_id": "c_custkey", "municipality": "c_name", "department": "c_nationkey"})


@query("reorder_drop", """
SELECT c_nationkey, c_name, c_custkey, c_mktsegment FROM customer""")
def _reorder_drop(spark, sf):
    return shape.move_first(table(spark, sf, "customer"), "c_nationkey", "c_name",
                            drop=["c_acctbal"])


@query("select_like", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _select_like(spark, sf):
    supplier = table(spark, sf, "supplier")
    wider = supplier.withColumn("extra", F.lit(1)).select(
        "extra", *reversed(supplier.columns))
    return shape.select_like(wider, supplier)


@query("multi_column_map", """
SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer""")
def _multi_column_map(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return shape.map_columns(c, ["c_name", "c_mktsegment"], F.lower)


@query("normalise_names", """
SELECT c_custkey AS codigo_municipal, c_acctbal AS poblacion_total FROM customer""")
def _normalise_names(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Código  Municipal"),
        F.col("c_acctbal").alias("POBLACIÓN Total"))
    return shape.normalise_names(c)


@query("union_missing", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS suppkey
FROM customer UNION ALL
SELECT NULL, s_name, NULL, s_suppkey FROM supplier""")
def _union_missing(spark, sf):
    customers = shape.select_as(table(spark, sf, "customer"),
                                {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"})
    suppliers = shape.select_as(table(spark, sf, "supplier"),
                                {"suppkey": "s_suppkey", "name": "s_name"})
    return shape.union_by_name(customers, suppliers)


# --- long, wide, nested ---------------------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("wide_to_long", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS variable, nullif({m}, 0) AS value FROM lineitem"
    for m in _MEASURES))
def _wide_to_long(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.nullif(F.col(m), F.lit(0.0)).alias(m)
                                        for m in _MEASURES])
    return shape.wide_to_long(lines, ["l_orderkey", "l_linenumber"], _MEASURES)


@query("split_key", """
SELECT p_partkey, nullif(split_part(p_name, ' ', 1), '') AS municipality,
  try_cast(nullif(string_split(p_brand, '#')[2], '') AS INTEGER) AS year,
  CASE WHEN len(string_split(p_name, ' ')) > 1 THEN split_part(p_name, ' ', 2) END AS sex
FROM part""")
def _split_key(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey", F.replace(F.col("p_name"), F.lit(" "), F.lit(":")).alias("key"), "p_brand")
    named = shape.split_key(parts, "key", {"municipality": "string", "sex": "string"}, ":")
    return shape.split_key(named, "p_brand", {"__word": "string", "year": "int"},
                           "[^A-Za-z0-9]+").drop("__word")


@query("nest_unnest", """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, l_linenumber, l_quantity, l_returnflag
FROM lineitem""")
def _nest_unnest(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), "l_linenumber", "l_quantity", "l_returnflag")
    return shape.unnest(shape.nest(lines, ["l_suppkey", "year"]), "data")


@query("nested_rows", """
SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey""")
def _nested_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity")
    nested = shape.nest(lines, ["l_suppkey"])
    total = F.aggregate("data", F.lit(0.0), lambda s, row: s + row["l_quantity"])
    return nested.select("l_suppkey", F.size("data").cast("long").alias("n"), total.alias("quantity"))


@query("distinct_domains", """
SELECT c_nationkey, y AS year FROM (SELECT DISTINCT c_nationkey FROM customer) c,
  (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) o""")
def _distinct_domains(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return shape.value_grid(table(spark, sf, "customer"), "c_nationkey", years, "year")


@query("wide_grid", """
SELECT n_nationkey, d AS o_orderdate FROM (SELECT DISTINCT n_nationkey FROM nation) n,
  (SELECT DISTINCT o_orderdate AS d FROM orders) o""")
def _wide_grid(spark, sf):
    return shape.value_grid(table(spark, sf, "nation"), "n_nationkey", table(spark, sf, "orders"),
                            "o_orderdate")


@query("grid_expand", """
SELECT o_custkey, year, population, age FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS population
  FROM (SELECT o_custkey, o_orderdate, round(o_totalprice) AS o_totalprice FROM orders) o
  GROUP BY ALL) t,
  (SELECT DISTINCT l_linenumber AS age FROM lineitem) a""")
def _grid_expand(spark, sf):
    orders = table(spark, sf, "orders")
    rows = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(F.round("o_totalprice")).alias("population"))
    ages = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("age"))
    return shape.expand_over(rows, ages, "age")


@query("set_difference", """
SELECT o_custkey FROM orders EXCEPT SELECT s_suppkey FROM supplier""")
def _set_difference(spark, sf):
    customers = table(spark, sf, "orders").select("o_custkey")
    return customers.subtract(table(spark, sf, "supplier").select("s_suppkey"))


# --- order-dependent operators ----------------------------------------------------------

_MARKED = """
SELECT c_nationkey, c_custkey, c_acctbal, c_mktsegment,
  sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) OVER w AS section
FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)"""


@query("section_fill", f"""
SELECT c_nationkey, c_custkey, CAST(section AS BIGINT) AS section,
  first_value(c_custkey) OVER s AS section_start, first_value(c_acctbal) OVER s AS head
FROM ({_MARKED}) m
WINDOW s AS (PARTITION BY c_nationkey, section ORDER BY c_custkey)""")
def _section_fill(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal",
                                            "c_mktsegment")
    filled = ordered.sections(c, ["c_nationkey"], "c_custkey",
                              F.col("c_mktsegment") == "BUILDING",
                              {"head": F.col("c_acctbal")})
    return filled.drop("c_acctbal", "c_mktsegment")


_SHEET_AGE = """
SELECT c_nationkey, c_custkey, CAST(CASE WHEN c_mktsegment = 'BUILDING'
  THEN 2000 + c_custkey % 21 WHEN c_custkey % 9 = 0 THEN 100 ELSE c_custkey % 90 END AS INTEGER)
  AS age FROM {customer}"""


@query("section_year", f"""
WITH m AS (SELECT *, sum(CASE WHEN age > 100 THEN 1 ELSE 0 END) OVER (
    PARTITION BY c_nationkey ORDER BY c_custkey) AS section FROM ({_SHEET_AGE}) x),
  y AS (SELECT *, first_value(age) OVER (PARTITION BY c_nationkey, section ORDER BY c_custkey)
    AS year FROM m),
  k AS (SELECT * FROM y WHERE age < 100)
SELECT c_custkey, age, CASE WHEN year < 100 THEN
  min(CASE WHEN year > 100 THEN year END) OVER (PARTITION BY c_nationkey) - 1 ELSE year END AS year
FROM k""")
def _section_year(spark, sf):
    rows = age_sections(derived(spark, sf, _SHEET_AGE), ["c_nationkey"], "c_custkey")
    return rows.select("c_custkey", "age", "year")


_LABELS = """
SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 6 = 0 OR c_mktsegment = 'MACHINERY' THEN NULL
  ELSE c_name END AS label FROM {customer}"""


@query("block_headers", f"""
WITH p AS (SELECT *, lag(label) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS before
  FROM ({_LABELS}) x),
  s AS (SELECT *, CAST(sum(CASE WHEN before IS NULL AND label IS NOT NULL THEN 1 ELSE 0 END) OVER (
    PARTITION BY c_nationkey ORDER BY c_custkey) AS BIGINT) AS block FROM p),
  k AS (SELECT *, first_value(label) OVER w AS department, row_number() OVER w AS rn FROM s
    WHERE label IS NOT NULL WINDOW w AS (PARTITION BY c_nationkey, block ORDER BY c_custkey))
SELECT c_nationkey, c_custkey, label, block, department FROM k WHERE rn > 1""")
def _block_headers(spark, sf):
    return department_blocks(derived(spark, sf, _LABELS), ["c_nationkey"], "c_custkey", "label")


_SPANS = """
SELECT c_nationkey AS sheet, c_custkey AS col_idx, CASE c_mktsegment WHEN 'BUILDING' THEN 'Total'
    WHEN 'MACHINERY' THEN 'Menores de 1 y mas' WHEN 'AUTOMOBILE' THEN 'X__1' END AS label,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE cast(2016 + c_custkey % 5 AS STRING) END AS detail
FROM {customer}"""
_SPANNED = f"""
  g AS (SELECT *, sum(CASE WHEN label IN ('Total', 'Menores de 1 y mas') THEN 1 ELSE 0 END) OVER (
    PARTITION BY sheet ORDER BY col_idx) AS span FROM ({plain(_SPANS)}) x),
  n AS (SELECT sheet, col_idx, regexp_replace(lower(max(
      CASE WHEN label IN ('Total', 'Menores de 1 y mas') THEN label END)
      OVER (PARTITION BY sheet, span)), '[ y\n]+', '_', 'g')
    || '_' || coalesce(detail, '') AS name FROM g)"""


@query("span_header", f"WITH {_SPANNED} SELECT sheet, col_idx, name FROM n")
def _span_header(spark, sf):
    return spanning_names(derived(spark, sf, _SPANS), ["sheet"], "col_idx", "label", "detail")


@query("distinct_headers", f"""
WITH {_SPANNED} SELECT sheet, name, min(col_idx) AS col_idx FROM n
WHERE NOT regexp_matches(name, '_[0-9]_') GROUP BY ALL""")
def _distinct_headers(spark, sf):
    names = spanning_names(derived(spark, sf, _SPANS), ["sheet"], "col_idx", "label", "detail")
    return distinct_columns(names, ["sheet"], "col_idx")


@query("header_places", """
SELECT c_nationkey, c_mktsegment, CAST(row_number() OVER (PARTITION BY c_nationkey
  ORDER BY first) AS BIGINT) AS place_no FROM (
  SELECT c_nationkey, c_mktsegment, min(c_custkey) AS first FROM customer GROUP BY ALL) x""")
def _header_places(spark, sf):
    names = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.min("c_custkey").alias("first"))
    return ordered.numbered(names, ["c_nationkey"], "first", "place_no").drop("first")


@query("first_row", """
SELECT c_custkey, c_name, c_nationkey FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) = 1""")
def _first_row(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return ordered.first_rows(c, ["c_nationkey"], "c_custkey")


@query("drop_first", """
SELECT c_custkey, c_name, c_nationkey FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) > 1""")
def _drop_first(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return ordered.without_first(c, ["c_nationkey"], "c_custkey")


@query("first_overwrite", """
SELECT c_custkey, c_nationkey, CASE WHEN row_number() OVER (PARTITION BY c_nationkey
  ORDER BY c_custkey) = 1 THEN 'first' ELSE c_name END AS c_name FROM customer""")
def _first_overwrite(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return ordered.overwrite_first(c, ["c_nationkey"], "c_custkey", "c_name", F.lit("first"))


@query("previous_row", f"""
SELECT c_custkey, lag(label) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS before
FROM ({_LABELS}) x""")
def _previous_row(spark, sf):
    rows = ordered.previous(derived(spark, sf, _LABELS), ["c_nationkey"], "c_custkey", "label",
                            "before")
    return rows.select("c_custkey", "before")


# --- sorts --------------------------------------------------------------------------------

_PRIORITIES = ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT", "4-NOT SPECIFIED"]


@query("ordered_sort", """
SELECT o_orderpriority, o_orderdate, o_orderkey, row_number() OVER (
  PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS place,
  CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3
    WHEN '1-URGENT' THEN 4 WHEN '4-NOT SPECIFIED' THEN 5 END AS block FROM orders""")
def _ordered_sort(spark, sf):
    """The rows as they come out of the sort, with their place in it within each priority.

    The number of a row's sorted partition and its place there give its place in the whole:
    both are read off the sorted rows, so an unsorted result has wrong places.
    """
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    block = recode.ordinal(F.col("o_orderpriority"), _PRIORITIES)
    rows = orders.withColumn("block", block).orderBy("block", "o_orderdate", "o_orderkey")
    seen = cut_lineage(rows.withColumn("at", F.monotonically_increasing_id()))
    return ordered.numbered(seen, ["o_orderpriority"], "at", "place").drop("at")


# --- totals ---------------------------------------------------------------------------------

_QTY = "CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_quantity END"
_FLAGGED = f"SELECT l_suppkey, l_returnflag, l_linestatus, {_QTY} AS q FROM {{lineitem}}"


@query("group_sum", f"""
SELECT l_suppkey, l_returnflag, l_linestatus,
  CASE WHEN count(q) = count(*) THEN sum(q) END AS total
FROM ({_FLAGGED}) x GROUP BY ALL""")
def _group_sum(spark, sf):
    return totals.group_sum(derived(spark, sf, _FLAGGED),
                            ["l_suppkey", "l_returnflag", "l_linestatus"], "q", "total")


@query("group_tally", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n
FROM orders GROUP BY ALL""")
def _group_tally(spark, sf):
    return totals.group_count(table(spark, sf, "orders"),
                              [F.year("o_orderdate").alias("year"), "o_orderstatus"])


@query("weighted_count", """
SELECT CAST(year(d) AS INTEGER) AS year, o_orderstatus, CAST(sum(n) AS BIGINT) AS births FROM (
  SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) x
GROUP BY ALL""")
def _weighted_count(spark, sf):
    daily = totals.group_count(
        table(spark, sf, "orders"),
        [F.col("o_orderdate").cast("date").alias("d"), "o_orderstatus"])
    return totals.group_count(daily, [F.year("d").alias("year"), "o_orderstatus"], "births",
                              weight="n")


@query("group_mean", """
SELECT c_mktsegment, c_nationkey, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY ALL""")
def _group_mean(spark, sf):
    means = totals.group_mean(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"],
                              "c_acctbal", "mean")
    return means.withColumn("mean", F.round("mean", 6))


@query("conditional_min", """
SELECT c_custkey, min(CASE WHEN c_acctbal > 100 THEN c_acctbal END)
  OVER (PARTITION BY c_nationkey) - 1 AS lowest FROM customer""")
def _conditional_min(spark, sf):
    c = table(spark, sf, "customer")
    above = F.when(F.col("c_acctbal") > 100, F.col("c_acctbal"))
    rows = totals.with_group_min(c, ["c_nationkey"], above, "lowest")
    return rows.select("c_custkey", (F.col("lowest") - 1).alias("lowest"))


@query("global_min", """
SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS first_year FROM orders""")
def _global_min(spark, sf):
    return table(spark, sf, "orders").agg(F.min(F.year("o_orderdate")).alias("first_year"))


@query("keep_minimum", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
QUALIFY o_orderpriority = min(o_orderpriority) OVER (PARTITION BY o_custkey)""")
def _keep_minimum(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return totals.keep_group_min(orders, ["o_custkey"], "o_orderpriority")


@query("row_gate", """
SELECT count(*) AS n_violations FROM (SELECT DISTINCT c_nationkey, c_custkey FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier))""")
def _row_gate(spark, sf):
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    missing = unknown_names(table(spark, sf, "customer"), known, "c_custkey",
                            ["c_nationkey", "c_custkey"])
    return missing.agg(F.count(F.lit(1)).alias("n_violations"))


_EVENTS = """
SELECT event_id, user_id, CASE WHEN user_id % 50 = 7 AND event_id % 5 = 0 THEN NULL
  WHEN user_id % 50 = 9 THEN 0.0 ELSE value END AS value FROM {events}"""


@query("share_of_total", f"""
SELECT event_id, user_id, round(CASE WHEN t = 0 THEN 'NaN'::DOUBLE ELSE value / t END, 8) AS share
FROM (SELECT *, CASE WHEN count(value) OVER w = count(*) OVER w THEN sum(value) OVER w END AS t
  FROM ({_EVENTS}) e WINDOW w AS (PARTITION BY user_id)) x""")
def _share_of_total(spark, sf):
    rows = totals.share_of_total(derived(spark, sf, _EVENTS), ["user_id"], "value", "share")
    return rows.select("event_id", "user_id", F.round("share", 8).alias("share"))


@query("group_total", f"""
SELECT event_id, round(CASE WHEN count(value) OVER w = count(*) OVER w THEN sum(value) OVER w END,
  4) AS total FROM ({_EVENTS}) e WINDOW w AS (PARTITION BY user_id)""")
def _group_total(spark, sf):
    rows = totals.with_group_total(derived(spark, sf, _EVENTS), ["user_id"], "value")
    return rows.select("event_id", F.round("total", 4).alias("total"))
