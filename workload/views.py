"""Input tables of the registered queries. The same text runs in Spark SQL and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.files import read_parquet

BASE = """
select o.o_orderkey as id, case when o.o_orderstatus = 'F' then 1 else 0 end as y, o.o_orderdate as d,
       o.o_totalprice as price, c.c_acctbal as bal, c.c_mktsegment as segment,
       o.o_orderpriority as priority, n.n_name as nation, o.o_custkey as cust
from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
"""

# Adds nulls, spelling variants, placeholders, entry errors and unreadable dates to the base table.
DIRTY = """
select id, y, d, price, nation,
 case id % 11 when 0 then upper(segment)||'!' when 1 then '  '||lower(segment)||' ' when 2 then '?'
              when 3 then 'Unknown' when 4 then null else segment end as segment_raw,
 case when priority = '4-NOT SPECIFIED' then null when id % 13 = 0 then replace(priority, '-', ' and ')
      else priority end as priority_raw,
 case when id % 5 = 0 then '3-MEDIUM' else priority end as priority_got,
 case when id % 6 = 0 then null else cast(cust % 40 as double) end as agent_id,
 case when id % 20 = 0 then cast(cust % 7 as double) else null end as company_id,
 case when id % 101 = 0 then null when id % 997 = 0 then cast(250000 as double) else bal end as cost,
 case when id % 499 = 0 then -5 when id % 503 = 0 then 10000 else id % 9 end as hours,
 case when id % 50 = 0 then 'not a date' when id % 51 = 0 then null
      else cast(cast(d as date) as string) end as date_raw
from {base}
"""

SPLIT_DAY = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "nation")
    return spark.sql(BASE, **{n: table(spark, sf_dir, n) for n in names})


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DIRTY, base=base(spark, sf_dir))


BASE_CTE = "base as (" + BASE.format(orders="orders", customer="customer", nation="nation") + ")"
DIRTY_CTE = BASE_CTE + ", dirty as (" + DIRTY.format(base="base") + ")"
