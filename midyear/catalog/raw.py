"""Inputs of the record and workbook operators, derived from the given tables.

The SQL uses only what Spark SQL and DuckDB share, so both sides of a check start from
the same rows.  Table names are written in braces.
"""

# Coded birth records: one per order, place of residence from the customer's nation.
BIRTHS = """
SELECT o_orderkey AS k,
  cast(year(o_orderdate) AS STRING) AS file_year,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(year(o_orderdate) AS STRING)
       ELSE cast(year(o_orderdate) % 100 AS STRING) END AS anoreg,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE cast(month(o_orderdate) AS STRING) END AS mesreg,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       WHEN o_orderkey % 2 = 0 THEN cast(year(o_orderdate) % 100 AS STRING)
       ELSE cast(year(o_orderdate) AS STRING) END AS anoocu,
  CASE WHEN o_orderkey % 101 = 0 THEN '2' ELSE cast(month(o_orderdate) AS STRING) END AS mesocu,
  CASE WHEN o_orderkey % 101 = 0 THEN '30' ELSE cast(day(o_orderdate) AS STRING) END AS diaocu,
  CASE WHEN o_orderkey % 13 = 0 THEN '99' ELSE cast(4 + o_orderkey % 6 AS STRING) END AS libras,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '99'
       ELSE cast(o_orderkey % 16 AS STRING) END AS onzas,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE cast(1 + o_orderkey % 3 AS STRING) END AS sexo,
  cast(1 + o_orderkey % 5 AS STRING) AS tipar,
  cast(1 + o_orderkey % 3 AS STRING) AS viapar,
  cast(1 + o_orderkey % 9 AS STRING) AS pueblopm,
  cast(1 + o_custkey % 9 AS STRING) AS pueblopp,
  cast(c_nationkey % 4 AS STRING) AS depocu,
  cast(c_nationkey AS STRING) AS mupocu,
  cast(c_nationkey % 5 AS STRING) AS depreg,
  cast(o_custkey % 40 AS STRING) AS mupreg,
  CASE c_nationkey % 3 WHEN 0 THEN '6' WHEN 1 THEN '9' ELSE '12' END AS deprem,
  CASE WHEN o_custkey % 23 = 0 THEN '901' WHEN o_custkey % 37 = 0 THEN NULL
       ELSE cast(c_nationkey AS STRING) END AS muprem,
  cast(15 + o_orderkey % 30 AS STRING) AS edadm
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Coded death records: one per line item, registration place from the supplier's nation.
# Half of the place codes are written with department, as the place lookup has them.
DEATHS = """
SELECT l_orderkey AS k, l_linenumber AS line,
  cast(year(l_shipdate) AS STRING) AS file_year,
  CASE WHEN l_orderkey % 43 = 0 THEN '9' ELSE cast(year(l_shipdate) AS STRING) END AS anoreg,
  cast(month(l_shipdate) AS STRING) AS mesreg,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL
       WHEN l_orderkey % 41 = 0 THEN '9' WHEN l_orderkey % 47 = 0 THEN '10'
       WHEN l_orderkey % 2 = 0 THEN cast(year(l_shipdate) % 100 AS STRING)
       ELSE cast(year(l_shipdate) AS STRING) END AS anoocu,
  cast(month(l_shipdate) AS STRING) AS mesocu,
  CASE WHEN l_orderkey % 61 = 0 THEN '31' ELSE cast(day(l_shipdate) AS STRING) END AS diaocu,
  cast(1 + l_linenumber % 7 AS STRING) AS asist,
  cast(1 + l_orderkey % 10 AS STRING) AS ocur,
  cast(1 + l_orderkey % 4 AS STRING) AS cerdef,
  cast(1 + l_linenumber % 2 AS STRING) AS sexo,
  cast(1 + l_orderkey % 9 AS STRING) AS puedif,
  CASE WHEN l_orderkey % 59 = 0 THEN NULL
       WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '2'
       WHEN l_linestatus = 'O' THEN '3' ELSE '9' END AS perdif,
  CASE WHEN l_orderkey % 31 = 0 THEN '999' WHEN l_orderkey % 73 = 0 THEN 'x'
       WHEN l_returnflag = 'A' THEN cast(4 * l_linenumber AS STRING)
       ELSE cast(l_linenumber AS STRING) END AS edadif,
  cast(l_suppkey % 4 AS STRING) AS dnadif,
  cast(l_suppkey % 9 AS STRING) AS mnadif,
  cast(l_partkey % 4 AS STRING) AS dredif,
  cast(l_partkey % 9 AS STRING) AS mredif,
  concat('J', cast(l_partkey % 100 AS STRING)) AS caudef,
  l_linestatus AS cause_text,
  CASE s_nationkey % 3 WHEN 0 THEN '6' WHEN 1 THEN '9' ELSE '12' END AS depreg,
  CASE WHEN l_orderkey % 2 = 0 THEN cast(s_nationkey AS STRING)
       ELSE concat(CASE s_nationkey % 3 WHEN 0 THEN '06' WHEN 1 THEN '09' ELSE '12' END,
                   lpad(cast(s_nationkey AS STRING), 2, '0')) END AS mupreg
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""

# Places: a nation is a place of the department its key falls into.
PLACES = """
SELECT concat(CASE n_nationkey % 3 WHEN 0 THEN '06' WHEN 1 THEN '09' ELSE '12' END,
              lpad(cast(n_nationkey AS STRING), 2, '0')) AS code,
       concat('san josé ', n_name) AS name
FROM {nation}
"""
