"""Scalar functions and predicates on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog import raw
from midyear.catalog.registry import derived, query, table
from midyear.functions import dates, numbers, recode, text
from midyear.operators.cohort import place_code
from midyear.operators.events import repaired_year
from midyear.operators.shape import derive
from midyear.plans.layouts import fill_blank_place

# --- SQL counterparts of the functions ------------------------------------------


def sql_title(x: str) -> str:
    letters = f"'{text.LOWER}', '{text.UPPER}'"
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda w: translate(left(w, 1), {letters}) || substr(w, 2)), ' ')"
    )


def sql_ascii(x: str) -> str:
    out = f"translate({x}, '{text.ACCENTED}', '{text.BASE}')"
    for letter, pair in text.DIGRAPHS.items():
        out = f"replace({out}, '{letter}', '{pair}')"
    return f"regexp_replace({out}, '[^\\x00-\\x7F]', '?', 'g')"


def sql_pad(x: str) -> str:
    return f"CASE WHEN length({x}) < 2 THEN lpad({x}, 2, '0') ELSE {x} END"


def sql_double(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{numbers.NUMERIC}') "
        f"THEN try_cast(trim({x}) AS DOUBLE) END"
    )


def sql_int(x: str) -> str:
    return f"try_cast(trunc({sql_double(x)}) AS INTEGER)"


def sql_year(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^[0-9][0-9]?$') THEN CASE "
        f"WHEN try_cast({x} AS INTEGER) <= 68 THEN 2000 ELSE 1900 END + try_cast({x} AS INTEGER) "
        f"WHEN regexp_matches({x}, '^[0-9][0-9][0-9][0-9]$') THEN try_cast({x} AS INTEGER) END"
    )


def sql_ymd(y: str, m: str, d: str) -> str:
    return (
        f"CASE WHEN regexp_matches({m}, '^[0-9][0-9]?$') AND "
        f"regexp_matches({d}, '^[0-9][0-9]?$') THEN try_cast(lpad(CAST({sql_year(y)} AS "
        f"VARCHAR), 4, '0') || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE) END"
    )


def sql_months_back(d: str, n: str) -> str:
    return f"CAST({d} - to_months({n}) AS DATE)"


def sql_shift(d: str, n: str, unit: str) -> str:
    def strict(months: str) -> str:
        moved = sql_months_back(d, months)
        return f"CASE WHEN day({moved}) = day({d}) THEN {moved} END"

    return (
        f"CASE {unit} WHEN 'days' THEN {d} - CAST({n} AS INTEGER) "
        f"WHEN 'months' THEN {strict(n)} WHEN 'years' THEN {strict(f'(12 * {n})')} END"
    )


def sql_case(x: str, mapping: dict, default: str | None = None) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else f"'{v}'"

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {x if default is None else default} END"


def sql_boundary(d: str) -> str:
    this = f"make_date(year({d}), 7, 1)"
    return f"CASE WHEN {d} < {this} THEN {this} ELSE make_date(year({d}) + 1, 7, 1) END"


# --- text ------------------------------------------------------------------------


@query("title_case", f"SELECT doc_id, {sql_title('text')} AS titled FROM documents")
def _title_case(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.title_case(F.col("text")).alias("titled"))


_STANDARD = sql_title(f"trim(lower({sql_ascii('text')}), ' ')")


@query("name_standardise", f"SELECT doc_id, {_STANDARD} AS name FROM documents")
def _name_standardise(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.standard_name(F.col("text")).alias("name"))


_HEADER = f"regexp_replace(lower({sql_ascii('text')}), ' +', '_', 'g')"


@query("header_keys", f"""
SELECT doc_id, {_HEADER} AS header,
  {sql_title(f"replace({_HEADER}, '_', ' ')")} AS place FROM documents""")
def _header_keys(spark, sf):
    docs = table(spark, sf, "documents")
    header = text.header_name(F.col("text"))
    return docs.select("doc_id", header.alias("header"),
                       text.key_to_place(header).alias("place"))


@query("pad_code", f"""
WITH c AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS dept,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'x'
       ELSE CAST(c_custkey % 2100 AS VARCHAR) END AS muni FROM customer)
SELECT c_custkey, {sql_pad('muni')} AS padded,
  CASE WHEN {sql_int('muni')} < 99 THEN ({sql_pad('dept')}) || ({sql_pad('muni')})
       WHEN {sql_int('muni')} >= 99 THEN muni END AS code
FROM c""")
def _pad_code(spark, sf):
    key = F.col("c_custkey")
    muni = F.when(key % 11 == 0, None).when(key % 13 == 0, "x").otherwise(
        (key % 2100).cast("string"))
    c = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("dept"), muni.alias("muni"))
    return c.select("c_custkey", text.pad_left(F.col("muni")).alias("padded"),
                    place_code(F.col("dept"), F.col("muni")).alias("code"))


@query("concat_null", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') || '-' || o_orderpriority AS joined
FROM orders""")
def _concat_null(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.concat(status, F.lit("-"), "o_orderpriority").alias("joined"))


@query("regex_strip", """
SELECT doc_id, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
  regexp_replace(text, '[ y\n]+', '_', 'g') AS joined FROM documents""")
def _regex_strip(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("bigint").alias("n_digits"),
        F.regexp_replace("text", "[ y\n]+", "_").alias("joined"))


# --- numbers -----------------------------------------------------------------------

_NUMBER_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 9
  WHEN 0 THEN concat(cast(o_custkey AS STRING), '+') WHEN 1 THEN NULL WHEN 2 THEN ''
  WHEN 3 THEN concat(' ', concat(cast(o_custkey AS STRING), ' '))
  WHEN 4 THEN concat(cast(o_custkey AS STRING), 'd') WHEN 5 THEN concat('-', concat(cast(o_custkey AS STRING), '.9'))
  WHEN 6 THEN '9999999999' WHEN 7 THEN concat(cast(o_custkey AS STRING), 'e1')
  ELSE cast(cast(o_totalprice AS DECIMAL(18, 2)) AS STRING) END AS t
FROM {orders}
"""


@query("safe_int", f"""
SELECT o_orderkey, {sql_int('t')} AS as_int, round({sql_double('t')}, 2) AS as_double
FROM ({_NUMBER_TEXT}) x""")
def _safe_int(spark, sf):
    t = derived(spark, sf, _NUMBER_TEXT)
    return t.select("o_orderkey", numbers.safe_int(F.col("t")).alias("as_int"),
                    F.round(numbers.safe_double(F.col("t")), 2).alias("as_double"))


_WEIGHTS = """
SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN '99' ELSE cast(p_size AS STRING) END AS lb,
  CASE WHEN p_partkey % 19 = 0 THEN '99' WHEN p_partkey % 23 = 0 THEN NULL
       ELSE cast(p_partkey % 16 AS STRING) END AS oz FROM {part}
"""


@query("unit_weight", f"""
SELECT p_partkey, CASE WHEN lb = '99' OR oz = '99' THEN NULL
  ELSE round((CAST(lb AS DOUBLE) + CAST(oz AS DOUBLE) / 16) / 2.20462, 6) END AS kg
FROM ({_WEIGHTS}) x""")
def _unit_weight(spark, sf):
    w = derived(spark, sf, _WEIGHTS)
    return w.select("p_partkey",
                    F.round(numbers.kilograms(F.col("lb"), F.col("oz")), 6).alias("kg"))


@query("arithmetic", """
SELECT l_orderkey, l_linenumber, l_quantity - l_linenumber AS alive,
  round(l_extendedprice * l_discount, 6) AS part,
  round(l_linenumber / 12.0 - l_tax, 6) AS deviation FROM lineitem""")
def _arithmetic(spark, sf):
    col = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (col("l_quantity") - col("l_linenumber")).alias("alive"),
        F.round(col("l_extendedprice") * col("l_discount"), 6).alias("part"),
        F.round(col("l_linenumber") / F.lit(12.0) - col("l_tax"), 6).alias("deviation"))


# --- dates ---------------------------------------------------------------------------


@query("parse_ymd", f"""
SELECT k, {sql_ymd(sql_pad('anoreg'), 'mesreg', "'01'")} AS record_date,
  {sql_ymd(sql_pad('coalesce(anoocu, file_year)'), 'mesocu', 'diaocu')} AS event_date
FROM ({raw.BIRTHS}) b""")
def _parse_ymd(spark, sf):
    col = F.col
    b = derived(spark, sf, raw.BIRTHS)
    return b.select(
        "k",
        dates.parse_ymd(col("anoreg"), col("mesreg"), F.lit("01"))
        .alias("record_date"),
        dates.parse_ymd(F.coalesce("anoocu", "file_year"), col("mesocu"),
                        col("diaocu")).alias("event_date"))


SQL_DEATH_YEAR = f"""CASE WHEN anoocu IS NULL AND anoreg IS NOT NULL THEN {sql_int('anoreg')}
  WHEN anoocu = '9' THEN 2009 WHEN anoocu = '10' THEN 2010 ELSE {sql_int('anoocu')} END"""


@query("year_repair", f"SELECT k, line, {SQL_DEATH_YEAR} AS death_year FROM ({raw.DEATHS}) d")
def _year_repair(spark, sf):
    return derived(spark, sf, raw.DEATHS).select(
        "k", "line", repaired_year(F.col("anoocu"), F.col("anoreg")).alias("death_year"))


@query("strict_month_shift", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS d,
  CASE l_returnflag WHEN 'A' THEN 'days' WHEN 'N' THEN 'months' ELSE 'years' END AS unit
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity,
  {sql_shift('d', 'l_linenumber', 'unit')} AS birth_date FROM l""")
def _strict_month_shift(spark, sf):
    unit = recode.recode(F.col("l_returnflag"), {"A": "days", "N": "months", "R": "years"})
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        dates.shift_back(F.col("l_shipdate").cast("date"), F.col("l_linenumber"), unit)
        .alias("birth_date"))


@query("year_part", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def _year_part(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))


@query("calendar_shift", f"""
WITH b AS (SELECT o_orderkey, {sql_boundary('CAST(o_orderdate AS DATE)')} AS b FROM orders)
SELECT o_orderkey, b AS mid_year, b - 28 AS days_28, {sql_months_back('b', '3')} AS months_3,
  {sql_months_back('b', '12')} AS months_12 FROM b""")
def _calendar_shift(spark, sf):
    b = table(spark, sf, "orders").select(
        "o_orderkey", dates.next_boundary(F.col("o_orderdate").cast("date")).alias("mid_year"))
    boundary = F.col("mid_year")
    return b.select("o_orderkey", "mid_year", F.date_sub(boundary, 28).alias("days_28"),
                    dates.months_before(boundary, 3).alias("months_3"),
                    dates.months_before(boundary, 12).alias("months_12"))


# --- value maps and conditions ----------------------------------------------------------

_STATUS = {"F": "final", "O": "open"}


@query("recode_map", f"""
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'O' END)
  AS s FROM orders)
SELECT o_orderkey, {sql_case('s', _STATUS)} AS status FROM o""")
def _recode_map(spark, sf):
    gone = F.when(F.col("o_orderkey") % 7 == 0, F.lit("O"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        recode.recode(F.nullif(F.col("o_orderstatus"), gone), _STATUS).alias("status"))


@query("recode_default", f"""
SELECT o_orderkey, {sql_case('o_orderstatus', _STATUS, 'NULL')} AS known,
  {sql_case('o_orderstatus', _STATUS, 'o_orderpriority')} AS filled FROM orders""")
def _recode_default(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey", recode.recode_known(status, _STATUS).alias("known"),
        recode.recode(status, _STATUS, default=F.col("o_orderpriority")).alias("filled"))


_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


@query("ordered_level", f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, {
    sql_case('o_orderpriority', {v: i for i, v in enumerate(_LEVELS, 1)}, 'NULL')} AS ordinal
  FROM orders)
SELECT o_orderkey, ordinal, CASE WHEN ordinal IS NOT NULL THEN o_orderpriority END AS label
FROM o WHERE ordinal < 4 OR ordinal IS NULL""")
def _ordered_level(spark, sf):
    priority = F.col("o_orderpriority")
    o = table(spark, sf, "orders").select(
        "o_orderkey", recode.ordinal(priority, _LEVELS).alias("ordinal"),
        recode.in_domain(priority, _LEVELS).alias("label"))
    return o.filter((F.col("ordinal") < 4) | F.col("ordinal").isNull())


@query("conditional", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 4
  WHEN o_orderstatus = 'F' THEN 5 ELSE 3 END AS skip FROM orders""")
def _conditional(spark, sf):
    final = F.col("o_orderstatus") == "F"
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(final & (F.col("o_totalprice") > 250000), 4).when(final, 5)
        .otherwise(3).alias("skip"))


@query("if_else_null", """
SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN NULL
  WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS answer FROM orders""")
def _if_else_null(spark, sf):
    test = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    return table(spark, sf, "orders").select(
        "o_orderkey", recode.if_else(test, F.lit("yes"), F.lit("no")).alias("answer"))


@query("null_default", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS v FROM orders""")
def _null_default(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(status, "o_orderpriority").alias("v"))


_SEGMENT = "nullif(c_mktsegment, 'MACHINERY')"


@query("blank_header_fix", f"""
SELECT c_custkey, CASE WHEN c_nationkey = 3 AND ({_SEGMENT} IS NULL OR {_SEGMENT} LIKE 'X%')
  THEN 'New Place' ELSE {_SEGMENT} END AS place FROM customer""")
def _blank_header_fix(spark, sf):
    place = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        fill_blank_place(F.col("c_nationkey"), place, {3: "New Place"}).alias("place"))


@query("derive_chain", """
SELECT c_custkey, bal, CASE WHEN bal < 0 THEN 'debt' ELSE 'credit' END AS side,
  round(bal * 2, 4) AS twice
FROM (SELECT c_custkey, round(c_acctbal - 1000, 4) AS bal FROM customer) c""")
def _derive_chain(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    bal = F.col("bal")
    return derive(c, bal=F.round(bal - 1000, 4),
                  side=F.when(bal < 0, "debt").otherwise("credit"),
                  twice=F.round(bal * 2, 4))


# --- predicates -----------------------------------------------------------------------


@query("filter_null", """
SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE nullif(l_tax, 0) IS NOT NULL""")
def _filter_null(spark, sf):
    return table(spark, sf, "lineitem").filter(
        F.nullif(F.col("l_tax"), F.lit(0.0)).isNotNull()
    ).select("l_orderkey", "l_linenumber", "l_tax")


@query("filter_range", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_linenumber BETWEEN 2 AND 5 AND l_quantity < 20""")
def _filter_range(spark, sf):
    return table(spark, sf, "lineitem").filter(
        F.col("l_linenumber").between(2, 5) & (F.col("l_quantity") < 20)
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_in", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def _filter_in(spark, sf):
    return table(spark, sf, "orders").filter(
        F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@query("filter_sentinel", f"""
SELECT k, line, edadif FROM ({raw.DEATHS}) d WHERE {sql_int('edadif')} < 999 AND perdif <> '9'
  AND perdif IN ('1', '2') AND depreg IN ('6', '9')""")
def _filter_sentinel(spark, sf):
    d = derived(spark, sf, raw.DEATHS)
    return d.filter(
        (numbers.safe_int(F.col("edadif")) < 999) & (F.col("perdif") != "9")
        & F.col("perdif").isin("1", "2") & F.col("depreg").isin("6", "9")
    ).select("k", "line", "edadif")


@query("filter_regex", """
SELECT p_partkey, p_type, p_name FROM part
WHERE regexp_matches(p_type, '^S') OR regexp_matches(lower(p_name), 'x_|red')""")
def _filter_regex(spark, sf):
    return table(spark, sf, "part").filter(
        F.col("p_type").rlike("^S") | F.col("p_name").rlike("(?i)x_|red")
    ).select("p_partkey", "p_type", "p_name")


@query("filter_both", """
SELECT o_orderkey FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def _filter_both(spark, sf):
    return table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") != "5-LOW")
    ).select("o_orderkey")


@query("filter_excess", """
SELECT l_orderkey, l_linenumber, round(l_discount - l_tax, 6) AS deviation FROM lineitem
WHERE round(l_discount - l_tax, 6) > 0.01""")
def _filter_excess(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(F.col("l_discount") - F.col("l_tax"), 6).alias("deviation"))
    return rows.filter(F.col("deviation") > 0.01)
