"""The ``census`` view: a records table with the roles the operators expect.

Built from lineitem, orders, customer and part: numeric columns (one zero-inflated), categorical
columns (two with missing values, one with more than ten levels) and a binary target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.spec import AnalysisSpec

SPEC = AnalysisSpec(
    numeric=("quantity", "price", "discount", "size", "gain"),
    categorical=("brand", "segment", "type", "priority", "flag", "returned"),
    target="income",
    positive=">50K",
    negative="<=50K",
    key=("h",),
    key_missing=("brand", "segment"),
    excluded=("price", "type"),
    group="returned",
    test_values=("quantity", "price", "size"),
    test_categories=("brand", "segment", "priority", "returned"),
    share_categories=("brand", "segment", "returned", "priority"),
    uncapped=("returned",),
    rate_categories=("brand", "priority"),
    histogram_by_target=("quantity",),
    histogram=("price", "size"),
    box_by_target=("quantity",),
    box_log=("gain", "price"),
    scatter=("quantity", "price", "brand", "segment", "type"),
)

KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _uniform(at: int) -> Column:
    """A number in [0, 1) from eight hex digits of ``h``."""
    return F.conv(F.substring("h", at, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def key_hash() -> Column:
    """``h``, which follows from the key columns."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in KEYS])).alias("h")


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a DataFrame; only the needed columns of each table are read.

    Orders meet their customers first: the rows of lineitem, by far the most, are moved once for orders and once for parts.
    """
    lineitem = read(spark, sf_dir, "lineitem").select(
        *KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    owned = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "c_mktsegment")
    joined = lineitem.join(owned, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    hashed = joined.withColumn("h", key_hash())
    quantity = F.col("l_quantity").cast("int")
    urgent = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(0.5)).otherwise(F.lit(0.0))
    return hashed.select(
        *KEYS,
        "h",
        quantity.alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_tax") == 0, F.col("l_extendedprice")).otherwise(F.lit(0.0)).alias("gain"),
        F.col("p_size").alias("size"),
        F.when(_uniform(9) >= 0.056, F.col("p_brand")).alias("brand"),
        F.when(_uniform(17) >= 0.018, F.col("c_mktsegment")).alias("segment"),
        F.col("p_type").alias("type"),
        F.col("o_orderpriority").alias("priority"),
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_returnflag") == "R", F.lit("R")).otherwise(F.lit("notR")).alias("returned"),
        F.when(quantity / 50.0 + urgent + _uniform(1) > 1.55, F.lit(">50K")).otherwise(F.lit("<=50K")).alias("income"),
    )


def _sql_uniform(at: int) -> str:
    return f"CAST(CAST(concat('0x', substr(h, {at}, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0E0"


# Common table expressions that define the same view in SQL.
CENSUS_SQL = f"""joined AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         CAST(l.l_quantity AS INT) AS quantity, l.l_extendedprice AS price, l.l_discount AS discount,
         CASE WHEN l.l_tax = 0 THEN l.l_extendedprice ELSE 0.0E0 END AS gain,
         p.p_size AS size, p.p_brand, p.p_type, c.c_mktsegment,
         o.o_orderpriority AS priority, l.l_returnflag AS flag,
         md5(concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_partkey AS VARCHAR),
                            CAST(l.l_suppkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR))) AS h
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey),
hashed AS (
  SELECT *, {_sql_uniform(1)} AS u1, {_sql_uniform(9)} AS u2, {_sql_uniform(17)} AS u3 FROM joined),
census AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, h, quantity, price, discount, gain, size,
         CASE WHEN u2 < 0.056E0 THEN NULL ELSE p_brand END AS brand,
         CASE WHEN u3 < 0.018E0 THEN NULL ELSE c_mktsegment END AS segment,
         p_type AS type, priority, flag,
         CASE WHEN flag = 'R' THEN 'R' ELSE 'notR' END AS returned,
         CASE WHEN quantity / 50.0E0
                   + CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 0.5E0 ELSE 0.0E0 END + u1 > 1.55E0
              THEN '>50K' ELSE '<=50K' END AS income
  FROM hashed)"""
