"""Type-1 merges, updates, quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import merge, quality
from wattloom.workload.base import READINGS, Tables, query

PART_SQL = """target AS (SELECT p_partkey, p_name, p_retailprice, p_size FROM part WHERE p_size <= 40),
src AS (SELECT p_partkey, p_name || ' II' AS p_name, CASE WHEN p_brand < 'Brand#2' THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice, p_size + 1 AS p_size
  FROM part WHERE p_size >= 10)"""


def _parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    part = t["part"]
    target = part.filter("p_size <= 40").select("p_partkey", "p_name", "p_retailprice", "p_size")
    price = F.when(F.col("p_brand") < "Brand#2", F.col("p_retailprice") * 2).otherwise(F.col("p_retailprice"))
    source = part.filter("p_size >= 10").select(
        "p_partkey", F.concat("p_name", F.lit(" II")).alias("p_name"), price.alias("p_retailprice"), (F.col("p_size") + 1).alias("p_size")
    )
    return target, source


@query("upsert_always", f"""WITH {PART_SQL}
SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey, CASE WHEN t.p_partkey IS NULL THEN s.p_name ELSE t.p_name END AS p_name,
  CASE WHEN s.p_partkey IS NULL THEN t.p_retailprice ELSE s.p_retailprice END AS p_retailprice,
  CASE WHEN s.p_partkey IS NULL THEN t.p_size ELSE s.p_size END AS p_size
FROM target t FULL JOIN src s ON t.p_partkey = s.p_partkey""")
def upsert_always(t: Tables) -> DataFrame:
    target, source = _parts(t)
    return merge.upsert(target, source, ["p_partkey"], ["p_retailprice", "p_size"])


@query("upsert_type1", f"""WITH {PART_SQL}
SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey, CASE WHEN t.p_partkey IS NULL THEN s.p_name ELSE t.p_name END AS p_name,
  CASE WHEN t.p_partkey IS NULL OR t.p_retailprice <> s.p_retailprice THEN s.p_retailprice ELSE t.p_retailprice END AS p_retailprice,
  CASE WHEN t.p_partkey IS NULL OR t.p_retailprice <> s.p_retailprice THEN s.p_size ELSE t.p_size END AS p_size
FROM target t FULL JOIN src s ON t.p_partkey = s.p_partkey""")
def upsert_type1(t: Tables) -> DataFrame:
    target, source = _parts(t)
    return merge.upsert(target, source, ["p_partkey"], ["p_retailprice", "p_size"], when_changed=["p_retailprice"])


@query("update_where", """SELECT s_suppkey, s_name, CASE WHEN s_nationkey = 3 THEN CAST(12 AS DOUBLE) ELSE s_acctbal END AS s_acctbal FROM supplier""")
def update_where(t: Tables) -> DataFrame:
    rows = merge.update_where(t["supplier"], F.col("s_nationkey") == 3, {"s_acctbal": F.lit(12)})
    return rows.select("s_suppkey", "s_name", "s_acctbal")


@query("replace_matching", """WITH late AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
base AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey)
SELECT b.l_orderkey, coalesce(x.qty, b.qty) AS qty FROM base b LEFT JOIN late x USING (l_orderkey)""")
def replace_matching(t: Tables) -> DataFrame:
    by_order = lambda df: df.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    late = by_order(t["lineitem"].filter(F.col("l_returnflag") == "R"))
    return merge.replace_matching(by_order(t["lineitem"]), late, ["l_orderkey"])


@query("quarantine_nulls", f"""WITH {READINGS}, t AS (SELECT event_id, CASE WHEN status <> 'error' THEN current_energy_wh END AS current_energy_wh,
  CASE WHEN capacity_kwh > 0 THEN capacity_kwh END AS capacity_kwh FROM readings)
SELECT event_id, current_energy_wh, capacity_kwh, concat_ws(',', CASE WHEN current_energy_wh IS NULL THEN 'current_energy_wh' END,
  CASE WHEN capacity_kwh IS NULL THEN 'capacity_kwh' END) AS missing FROM t WHERE current_energy_wh IS NULL OR capacity_kwh IS NULL""")
def quarantine_nulls(t: Tables) -> DataFrame:
    rows = t.readings().select(
        "event_id", F.when(F.col("status") != "error", F.col("current_energy_wh")).alias("current_energy_wh"),
        F.when(F.col("capacity_kwh") > 0, F.col("capacity_kwh")).alias("capacity_kwh"),
    )
    return quality.split_not_null(rows, ["current_energy_wh", "capacity_kwh"])[1]


@query("not_null_rows", f"WITH {READINGS} SELECT event_id, capacity_kwh FROM readings WHERE capacity_kwh > 0")
def not_null_rows(t: Tables) -> DataFrame:
    rows = t.readings().select("event_id", F.when(F.col("capacity_kwh") > 0, F.col("capacity_kwh")).alias("capacity_kwh"))
    return quality.split_not_null(rows, ["capacity_kwh"])[0]


@query("text_too_long", "SELECT p_partkey, 'p_type too long' AS reason FROM part WHERE length(p_type) > 5")
def text_too_long(t: Tables) -> DataFrame:
    reason = F.concat_ws(";", *quality.length_report({"p_name": 25, "p_type": 5})).alias("reason")
    return t["part"].select("p_partkey", reason).filter("reason <> ''")


@query("dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("unique_orders", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def unique_orders(t: Tables) -> DataFrame:
    return quality.require_unique(t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])


@query("orphan_keys", """SELECT o_custkey, count(*) AS n FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 20) GROUP BY o_custkey""")
def orphan_keys(t: Tables) -> DataFrame:
    return quality.orphan_keys(t["orders"], t["customer"].filter("c_nationkey < 20"), "o_custkey", "c_custkey")
