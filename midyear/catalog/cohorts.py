"""Cohort labels, decoded records, survivors, shares and bands on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog import expected, raw
from midyear.catalog.registry import derived, plain, query, table
from midyear.catalog.scalars import (
    SQL_DEATH_YEAR, sql_ascii, sql_boundary, sql_case, sql_int, sql_months_back, sql_pad,
    sql_shift, sql_title, sql_ymd,
)
from midyear.functions.dates import next_boundary
from midyear.functions.recode import recode
from midyear.operators import cohort, events
from midyear.operators.bands import band_rollup, split_age
from midyear.operators.totals import group_count, share_of_total
from midyear.plans.vital import infant_shares, place_names, under_five, vital_table
from midyear.sources.shared import cut_lineage

# The given tables cover 1995-2001: births count from mid-1996 on.
FIRST = "1996-07-01"
YEARS = (1997, 2000)

# --- SQL counterparts ----------------------------------------------------------------


def sql_label(day: str, boundary: str) -> str:
    whens = []
    for label, unit, amount in expected.INFANT_THRESHOLDS:
        low = f"{boundary} - {amount}" if unit == "days" else sql_months_back(boundary, str(amount))
        whens.append(f"WHEN {day} >= {low} THEN '{label}'")
    return f"CASE WHEN {day} >= {boundary} THEN NULL {' '.join(whens)} END"


def sql_code(dept: str, muni: str) -> str:
    return (
        f"CASE WHEN {sql_int(muni)} < 99 THEN ({sql_pad(dept)}) || ({sql_pad(muni)}) "
        f"WHEN {sql_int(muni)} >= 99 THEN {muni} END"
    )


def _map(col: str, mapping: dict) -> str:
    return sql_case(col, mapping)


SQL_EVENT = sql_ymd(sql_pad("coalesce(anoocu, file_year)"), "mesocu", "diaocu")
SQL_RECORD = sql_ymd(sql_pad("anoreg"), "mesreg", "'01'")

SQL_BIRTHS = f"""
SELECT CAST(year(event_date) AS INTEGER) AS event_year, * FROM (
SELECT {SQL_EVENT} AS event_date, depocu AS event_department, mupocu AS event_municipality,
  {SQL_RECORD} AS record_date, depreg AS record_department, mupreg AS record_municipality,
  {_map('sexo', expected.SEX)} AS sex,
  CASE WHEN libras = '99' OR onzas = '99' THEN NULL
    ELSE (CAST(libras AS DOUBLE) + CAST(onzas AS DOUBLE) / 16) / 2.20462 END AS weight_kg,
  {_map('tipar', expected.BIRTH_TYPE)} AS birth_type,
  {_map('viapar', expected.DELIVERY)} AS delivery_type, deprem AS mother_department,
  muprem AS mother_municipality, edadm AS mother_age,
  {_map('pueblopm', expected.GROUP)} AS mother_group,
  {_map('pueblopp', expected.GROUP)} AS father_group
FROM ({plain(raw.BIRTHS)}) b) x"""

SQL_UNIT = "CASE perdif WHEN '1' THEN 'days' WHEN '2' THEN 'months' WHEN '3' THEN 'years' END"

SQL_DETAILS = f"""
SELECT death_year, {sql_ymd('CAST(death_year AS VARCHAR)', sql_pad('mesocu'), sql_pad('diaocu'))}
    AS death_date, {_map('sexo', expected.SEX)} AS sex, {sql_int('edadif')} AS age_value,
  {SQL_UNIT} AS age_unit, dnadif AS death_department, mnadif AS death_municipality,
  dredif AS dept_resid, mredif AS muni_resid, {_map('puedif', expected.GROUP)} AS cult_group,
  caudef AS cause_icd10, cause_text AS cause_description,
  {_map('asist', expected.ASSISTANCE)} AS assistance_type,
  {_map('ocur', expected.DEATH_SITE)} AS death_site,
  {_map('cerdef', expected.CERTIFIER)} AS certified_death
FROM (SELECT *, {SQL_DEATH_YEAR} AS death_year FROM ({plain(raw.DEATHS)}) d) x"""

SQL_INFANTS = f"""
SELECT CAST(year(event_date) AS INTEGER) AS event_year, event_date, event_department,
  event_municipality, age_value, age_unit,
  {sql_shift('event_date', 'age_value', 'age_unit')} AS birth_date
FROM (SELECT {SQL_EVENT} AS event_date, depreg AS event_department, mupreg AS event_municipality,
    {sql_int('edadif')} AS age_value, {SQL_UNIT} AS age_unit
  FROM ({plain(raw.DEATHS)}) d
  WHERE {sql_int('edadif')} < 999 AND perdif IN ('1', '2') AND depreg IN ('6', '9')) x"""

# Pairs of mid-year and event year, joined on the year and filtered by range, as an
# independent form of the boundary expression.
SQL_COHORTS = f"""
births AS ({SQL_BIRTHS}),
infants AS ({SQL_INFANTS}),
years AS (SELECT DISTINCT event_year AS y FROM births WHERE event_date IS NOT NULL),
mids AS (SELECT make_date(m.y, 7, 1) AS mid_year, e.e AS event_year FROM years m,
  (SELECT CAST(range AS INTEGER) AS e FROM range(1900, 2100)) e
  WHERE e.e BETWEEN (SELECT min(y) FROM years) AND m.y),
places AS (SELECT code AS muni_id, {sql_title(sql_ascii('name'))} AS municipality
  FROM ({plain(raw.PLACES)}) p),
born_codes AS (SELECT CAST(year(mid_year) AS INTEGER) AS year, mother_department AS dept,
    mother_municipality AS muni, age_group, count(*) AS births
  FROM (SELECT *, {sql_label('event_date', 'mid_year')} AS age_group
    FROM births JOIN mids USING (event_year)) x
  WHERE event_date < mid_year AND event_date >= {sql_months_back('mid_year', '12')}
    AND event_date >= DATE '{FIRST}' AND mid_year > DATE '{FIRST}'
    AND mother_department IN ('6', '9') GROUP BY ALL),
born AS (SELECT year, {sql_case('dept', expected.DEPARTMENTS)} AS department, municipality,
    age_group, births
  FROM born_codes LEFT JOIN places ON muni_id = {sql_code('dept', 'muni')}),
died AS (SELECT CAST(year(mid_year) AS INTEGER) AS year,
    {sql_case('event_department', expected.DEPARTMENTS)} AS department, municipality,
    age_group, count(*) AS deaths
  FROM (SELECT *, {sql_label('birth_date', 'mid_year')} AS age_group
    FROM infants JOIN mids USING (event_year)) x
  LEFT JOIN places ON muni_id = event_municipality
  WHERE event_date < mid_year AND birth_date > {sql_months_back('mid_year', '12')}
  GROUP BY ALL),
alive AS (SELECT b.*, coalesce(d.deaths, 0) AS deaths, b.births - coalesce(d.deaths, 0) AS alive
  FROM born b LEFT JOIN died d ON b.year = d.year AND b.department = d.department
    AND b.municipality IS NOT DISTINCT FROM d.municipality AND b.age_group = d.age_group),
shares AS (SELECT *, CASE WHEN t <> 0 THEN alive / t WHEN alive = 0 THEN 'NaN'::DOUBLE
    ELSE alive * 'Infinity'::DOUBLE END AS proportion
  FROM (SELECT *, sum(alive) OVER (PARTITION BY year, department, municipality) AS t FROM alive) s),
means AS (SELECT age_group, avg(proportion) AS proportion FROM shares GROUP BY ALL)"""


def _births(spark, sf):
    return derived(spark, sf, raw.BIRTHS)


def _deaths(spark, sf):
    return derived(spark, sf, raw.DEATHS).withColumnRenamed("cause_text", "caudef.descrip")


def _places(spark, sf):
    return place_names(derived(spark, sf, raw.PLACES), "code", "name")


def _shares(spark, sf):
    return infant_shares(_births(spark, sf), _deaths(spark, sf), _places(spark, sf),
                         first_date=FIRST)


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


# --- labels -----------------------------------------------------------------------------

_ORDER_DAY = "CAST(o_orderdate AS DATE)"


@query("cohort_label", f"""
WITH l AS (SELECT o_orderstatus, {sql_boundary(_ORDER_DAY)} AS mid_year, {_ORDER_DAY} AS d
  FROM orders),
  c AS (SELECT mid_year, o_orderstatus, label, count(*) AS n FROM (
    SELECT *, {sql_label('d', 'mid_year')} AS label FROM l) x WHERE label IS NOT NULL GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY mid_year, o_orderstatus), 6) AS proportion FROM c""")
def _cohort_label(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", F.col("o_orderdate").cast("date").alias("d"))
    rows = orders.withColumn("mid_year", next_boundary(F.col("d")))
    counts = group_count(cohort.cohort_label(rows, "d"), ["mid_year", "o_orderstatus", "label"])
    return _rounded(share_of_total(counts, ["mid_year", "o_orderstatus"], "n"), "proportion")


@query("replicate_labels", " UNION ALL ".join(f"""
SELECT o_orderkey, '{label}' AS label, {i} AS correlative FROM (SELECT o_orderkey,
  {_ORDER_DAY} AS d, {sql_boundary(_ORDER_DAY)} AS b FROM orders) o
WHERE d >= {f'b - {n}' if unit == 'days' else sql_months_back('b', str(n))}"""
    for i, (label, unit, n) in enumerate(expected.INFANT_THRESHOLDS, 1)))
def _replicate_labels(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = orders.withColumn("mid_year", next_boundary(F.col("d")))
    return cohort.label_variants(rows, "d").select("o_orderkey", "label", "correlative")


@query("youngest_label", f"""
SELECT o_orderkey, {sql_label('d', 'b')} AS label FROM (SELECT o_orderkey, {_ORDER_DAY} AS d,
  {sql_boundary(_ORDER_DAY)} AS b FROM orders) o""")
def _youngest_label(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = orders.withColumn("mid_year", next_boundary(F.col("d")))
    youngest = cohort.youngest_label(cohort.label_variants(rows, "d"), ["o_orderkey"])
    return youngest.select("o_orderkey", "label")


# --- records ------------------------------------------------------------------------------


@query("decode_births", f"""
SELECT * REPLACE (round(weight_kg, 6) AS weight_kg) FROM ({SQL_BIRTHS}) b""")
def _decode_births(spark, sf):
    decoded = events.decode_births(_births(spark, sf))
    return decoded.withColumn("weight_kg", F.round("weight_kg", 6))


@query("decode_deaths", SQL_DETAILS)
def _decode_deaths(spark, sf):
    return events.decode_deaths(_deaths(spark, sf))


@query("infant_deaths", SQL_INFANTS)
def _infant_deaths(spark, sf):
    return events.infant_deaths(_deaths(spark, sf))


@query("cohort_births", f"WITH {SQL_COHORTS} SELECT * FROM born")
def _cohort_births(spark, sf):
    daily = cut_lineage(cohort.daily_births(events.decode_births(_births(spark, sf))))
    return cohort.births_at(daily, cohort.mid_years(daily), _places(spark, sf), first_date=FIRST,
                            weight="n")


_DAILY = f"""
SELECT mother_department, mother_municipality, event_date, count(*) AS n
FROM ({SQL_BIRTHS}) b GROUP BY ALL"""


@query("daily_births", _DAILY)
def _daily_births(spark, sf):
    return cohort.daily_births(events.decode_births(_births(spark, sf)))


@query("cohort_deaths", f"WITH {SQL_COHORTS} SELECT * FROM died")
def _cohort_deaths(spark, sf):
    years = cohort.mid_years(events.decode_births(_births(spark, sf)))
    return cohort.deaths_at(events.infant_deaths(_deaths(spark, sf)), years, _places(spark, sf))


@query("cohort_deaths_padded", f"""
WITH {SQL_COHORTS}
SELECT CAST(year(mid_year) AS INTEGER) AS year,
    {sql_case('event_department', expected.DEPARTMENTS)} AS department, p.municipality,
    age_group, count(*) AS deaths
  FROM (SELECT *, {sql_label('birth_date', 'mid_year')} AS age_group
    FROM infants JOIN mids USING (event_year)) x
  LEFT JOIN places p ON muni_id = {sql_code('event_department', 'event_municipality')}
  WHERE event_date < mid_year AND birth_date > {sql_months_back('mid_year', '12')}
  GROUP BY ALL""")
def _cohort_deaths_padded(spark, sf):
    years = cohort.mid_years(events.decode_births(_births(spark, sf)))
    return cohort.deaths_at(events.infant_deaths(_deaths(spark, sf)), years, _places(spark, sf),
                            normalise_codes=True)


# --- shares ---------------------------------------------------------------------------------


@query("survivor_share", f"""
WITH {SQL_COHORTS} SELECT year, department, municipality, age_group, births, deaths, alive,
  round(proportion, 6) + 0.0 AS proportion FROM shares""")
def _survivor_share(spark, sf):
    return _rounded(_shares(spark, sf), "proportion")


@query("mean_share", f"""
WITH {SQL_COHORTS} SELECT age_group, round(proportion, 6) + 0.0 AS proportion FROM means""")
def _mean_share(spark, sf):
    return _rounded(cohort.mean_share(_shares(spark, sf)), "proportion")


@query("trend_share", f"""
WITH {SQL_COHORTS} SELECT year, department, age_group, round(avg(proportion), 6) + 0.0
  AS proportion FROM shares GROUP BY ALL""")
def _trend_share(spark, sf):
    return _rounded(cohort.trend_share(_shares(spark, sf)), "proportion")


_UNIFORM = sql_case("age_group", expected.INFANT_MONTHS, "NULL")


@query("uniform_gate", f"""
WITH {SQL_COHORTS} SELECT age_group, round(proportion, 6) + 0.0 AS proportion,
  round({_UNIFORM} / 12.0, 6) AS uniform_proportion,
  round(proportion - {_UNIFORM} / 12.0, 6) AS deviation FROM means
WHERE proportion - {_UNIFORM} / 12.0 > 0.01 AND NOT isnan(proportion)""")
def _uniform_gate(spark, sf):
    violations = cohort.uniform_violations(cohort.mean_share(_shares(spark, sf)))
    return _rounded(violations, "proportion", "uniform_proportion", "deviation")


# --- population by band -----------------------------------------------------------------------

# Line items as a population table: the line number counts ages from 0, the place is the
# supplier's nation.
POPULATION = """
SELECT cast(year(l_shipdate) AS INT) AS year,
  CASE s_nationkey % 3 WHEN 0 THEN 'Santa Rosa' WHEN 1 THEN 'Quetzaltenango' ELSE 'Peten' END
    AS department, concat('San Jose NATION_', cast(s_nationkey AS STRING)) AS municipality,
  CASE l_linestatus WHEN 'O' THEN 'male' ELSE 'female' END AS sex,
  cast(l_linenumber - 1 AS INT) AS age,
  CASE WHEN l_orderkey % 4999 = 17 THEN NULL ELSE l_quantity END AS population
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey"""

_SCOPE = f"""
  scope AS (SELECT year, department, municipality, age,
    CASE WHEN count(population) = count(*) THEN sum(population) END AS population
    FROM ({plain(POPULATION)}) p WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]}
      AND age BETWEEN 0 AND 4 AND department IN ('Santa Rosa', 'Quetzaltenango') GROUP BY ALL),
  split AS (SELECT year, department, municipality,
    {sql_case('age', expected.AGE_TO_GROUP, 'm.age_group')} AS age_group,
    CASE WHEN age = 0 AND proportion IS NOT NULL AND NOT isnan(proportion)
      THEN population * proportion ELSE population END AS population
    FROM scope LEFT JOIN means m ON age = 0)"""


@query("age_split", f"""
WITH {SQL_COHORTS}, {_SCOPE} SELECT * REPLACE (round(population, 4) AS population) FROM split""")
def _age_split(spark, sf):
    population = derived(spark, sf, POPULATION).filter(
        F.col("year").between(*YEARS) & F.col("age").between(0, 4)
        & F.col("department").isin("Santa Rosa", "Quetzaltenango"))
    split = split_age(population, cohort.mean_share(_shares(spark, sf)))
    return split.withColumn("population", F.round("population", 4))


def _bridge(bands: dict) -> str:
    pairs = [(b, b) for b in expected.BASE_GROUPS]
    pairs += [(base, band) for band, bases in bands.items() for base in bases]
    return "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in pairs) + ") bridge(base, band)"


_AGE_LABEL = {i: label for i, label in enumerate(expected.BASE_GROUPS[2:], 1)}


@query("band_rollup", f"""
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, band AS age_group,
  CASE WHEN count(q) = count(*) THEN sum(q) END AS population
FROM (SELECT *, {sql_case('l_linenumber', _AGE_LABEL, 'NULL')} AS label,
    CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem) l
JOIN {_bridge(expected.BANDS)} ON base = label GROUP BY ALL""")
def _band_rollup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"),
        recode(F.col("l_linenumber"), _AGE_LABEL, default=F.lit(None).cast("string"))
        .alias("age_group"),
        F.when(F.col("l_orderkey") % 997 != 0, F.col("l_quantity")).alias("population"))
    return band_rollup(lines, "age_group", ["l_suppkey", "year"], "population")


_REPORT = f"""
WITH {SQL_COHORTS}, {_SCOPE}
SELECT department, municipality, year, band AS age_group,
  round(CASE WHEN count(population) = count(*) THEN sum(population) END, 4) AS population
FROM split JOIN {_bridge(expected.BANDS)} ON base = age_group GROUP BY ALL"""


@query("under_five", _REPORT)
def _under_five(spark, sf):
    bands = under_five(derived(spark, sf, POPULATION), cohort.mean_share(_shares(spark, sf)),
                       years=YEARS)
    return bands.withColumn("population", F.round("population", 4))


@query("vital_table", _REPORT)
def _vital_table(spark, sf):
    report = vital_table(_births(spark, sf), _deaths(spark, sf), _places(spark, sf),
                         derived(spark, sf, POPULATION), first_date=FIRST, years=YEARS,
                         check=False)
    return report.withColumn("population", F.round("population", 4))
