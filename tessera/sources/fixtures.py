"""Stand-in views with the reference's table shapes, derived from the base tables.

Each view exists twice: as a DataFrame builder (what the library runs) and as
DuckDB SQL (what the oracle runs).  Both follow FIXTURES.md, so the work of
every query grows with the base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import dealt, table, table_bytes, tasks_for


#: Order in which a repeated rating replaces an earlier one; unique within (user, item).
RATING_ORDER = ["rated_at", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "rating"]


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                                              "l_quantity", "l_extendedprice")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    n = tasks_for(spark, table_bytes(spark, sf, "lineitem"))
    li, o = dealt(li, n, "l_orderkey"), dealt(o, n, "o_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("int").alias("rating"),
        F.col("o_orderdate").alias("rated_at"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def items(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_partkey") % 97 == 0, F.col("p_name"))
         .when(F.col("p_partkey") % 89 == 0, F.concat("p_name", F.lit(" ("), year, F.lit(") (V)")))
         .otherwise(F.concat("p_name", F.lit(" ("), year, F.lit(")"))).alias("title"),
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type")).alias("genres"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 3 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("occupation"))


def txn(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                              "l_extendedprice", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    n = tasks_for(spark, table_bytes(spark, sf, "lineitem"))
    o = o.join(c, F.col("o_custkey") == c.c_custkey)  # a quarter of the rows; the planner splits hot customers
    li, o = dealt(li, n, "l_orderkey"), dealt(o, n, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, F.col("l_suppkey") == s.s_suppkey)
    pri = F.col("o_orderpriority")
    return j.select(
        F.col("l_orderkey").alias("txn_order"), F.col("l_linenumber").alias("txn_line"),
        F.col("l_partkey").alias("txn_part"), F.col("l_suppkey").alias("txn_supp"),
        (F.lit(1) + (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 744).cast("int").alias("step"),
        F.when(pri == "1-URGENT", "TRANSFER").when(pri == "2-HIGH", "CASH_OUT")
         .when(pri == "3-MEDIUM", "CASH_IN").when(pri == "4-NOT SPECIFIED", "PAYMENT")
         .otherwise("DEBIT").alias("type"),
        F.when(F.col("l_partkey") % 211 == 0, -F.col("l_extendedprice"))
         .when(F.col("l_partkey") % 199 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice")).alias("amount"),
        (F.col("c_acctbal") * 10).alias("oldbalanceOrg"),
        F.col("s_acctbal").alias("oldbalanceDest"),
        F.when(pri.isin("1-URGENT", "2-HIGH") & (F.col("l_quantity") >= 48), 1).otherwise(0).alias("isFraud"),
        (F.when(F.col("l_quantity") >= 48, 0.5).otherwise(0.0)
         + (F.col("l_partkey") % 50).cast("double") / 100).alias("score"))


def rides(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    month = F.month("l_shipdate")
    q = F.col("l_quantity")
    return li.select(
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
        F.when(F.col("l_suppkey") % 30 == 0, 0)
         .otherwise(F.floor(F.col("l_extendedprice") / 30).cast("int")).alias("bike_count"),
        (F.col("l_orderkey") % 24).cast("int").alias("hour"),
        (q * 1.2 - 20).alias("temperature"),
        (F.col("l_partkey") % 99).cast("int").alias("humidity"),
        (F.col("l_discount") * 50).alias("wind_speed"),
        (F.lit(100) + (F.col("l_partkey") * 13) % 1900).cast("int").alias("visibility"),
        (q * 1.2 - 20 - (F.lit(100) - F.col("l_partkey") % 99) / 5.0).alias("dew_point"),
        F.when(F.col("l_tax") < 0.01, q / 10).otherwise(F.lit(0.0)).alias("rainfall"),
        F.when((F.col("l_tax") >= 0.07) & (q < 10), 1.0).otherwise(0.0).alias("snowfall"),
        F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring")
         .when(month.isin(6, 7, 8), "Summer").otherwise("Autumn").alias("season"),
        F.when(F.col("l_partkey") % 20 == 0, "Holiday").otherwise("No Holiday").alias("holiday"),
        F.when(F.col("l_suppkey") % 30 == 0, "No").otherwise("Yes").alias("functioning_day"))


def passengers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    title = (F.when(k % 7 == 0, "Mr").when(k % 7 == 1, "Mrs").when(k % 7 == 2, "Miss")
              .when(k % 7 == 3, "Mlle").when(k % 7 == 4, "Dr").when(k % 7 == 5, "Ms").otherwise("Master"))
    return c.select(
        k.alias("PassengerId"),
        F.when(F.col("c_acctbal") > 6000, 1).otherwise(0).alias("Survived"),
        (F.lit(1) + k % 3).cast("int").alias("Pclass"),
        F.concat("c_name", F.lit(", "), title, F.lit(". X")).alias("Name"),
        F.when((k % 7).isin(1, 2, 3, 5), "female").otherwise("male").alias("Sex"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise((k % 80).cast("double")).alias("Age"),
        (k % 4).cast("int").alias("SibSp"), (k % 3).cast("int").alias("Parch"),
        F.concat(F.lit("T"), (k % 400).cast("string")).alias("Ticket"),
        F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal") / 20).alias("Fare"),
        F.when(k % 4 == 0, F.col("c_mktsegment")).alias("Cabin"),
        F.when(k % 50 == 0, F.lit(None).cast("string")).when(k % 3 == 0, "C").otherwise("S").alias("Embarked"))


def churn(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    o = (table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")))
    j = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(o, o.o_custkey == c.c_custkey, "left"))
    tenure = F.coalesce("n_orders", F.lit(0))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(None)).otherwise(F.col("c_mktsegment")).alias("offer"),
        F.when(F.col("n_regionkey") == 0, "Month-to-Month").when(F.col("n_regionkey") == 1, "One Year")
         .otherwise("Two Year").alias("contract"),
        F.col("c_acctbal").alias("monthly_charge"),
        F.lit("United States").alias("country"),
        tenure.alias("tenure"),
        F.when(tenure < 9, "Yes").otherwise("No").alias("churn_label"))


def houses(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    li = (table(spark, sf, "lineitem").groupBy("l_partkey")
          .agg(F.avg("l_quantity").alias("avg_quantity"), F.avg("l_discount").alias("avg_discount"),
               F.count(F.lit(1)).alias("rating_count")))
    j = p.join(li, p.p_partkey == li.l_partkey, "left")
    return j.select(
        F.col("p_partkey").alias("house_id"),
        F.col("p_size").cast("double").alias("size"),
        F.coalesce("avg_quantity", F.lit(0.0)).alias("avg_quantity"),
        F.coalesce("avg_discount", F.lit(0.0)).alias("avg_discount"),
        F.coalesce("rating_count", F.lit(0)).cast("double").alias("rating_count"),
        F.col("p_retailprice").alias("price"))


BUILDERS = {
    "ratings": ratings, "items": items, "users": users, "txn": txn, "rides": rides,
    "passengers": passengers, "churn": churn, "houses": houses,
}


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf)


# DuckDB text of the same views, used only by the oracle.
VIEW_SQL = {
    "ratings": """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(CAST(l_quantity AS INT) % 5 + 1 AS INT) AS rating,
       o_orderdate AS rated_at,
       l_orderkey, l_linenumber, l_suppkey, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
SELECT p_partkey AS item_id,
       CASE WHEN p_partkey % 97 = 0 THEN p_name
            WHEN p_partkey % 89 = 0 THEN concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ') (V)')
            ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
       concat(replace(p_name, ' ', '|'), '|', p_type) AS genres
FROM part""",
    "users": """
SELECT c_custkey AS user_id, CAST(18 + c_custkey % 60 AS INT) AS age,
       CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS occupation
FROM customer""",
    "txn": """
SELECT l_orderkey AS txn_order, l_linenumber AS txn_line, l_partkey AS txn_part, l_suppkey AS txn_supp,
       CAST(1 + (l_orderkey * 7 + l_partkey) % 744 AS INT) AS step,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
            WHEN '3-MEDIUM' THEN 'CASH_IN' WHEN '4-NOT SPECIFIED' THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
       CASE WHEN l_partkey % 211 = 0 THEN -l_extendedprice
            WHEN l_partkey % 199 = 0 THEN NULL ELSE l_extendedprice END AS amount,
       c_acctbal * 10 AS oldbalanceOrg, s_acctbal AS oldbalanceDest,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND l_quantity >= 48 THEN 1 ELSE 0 END AS isFraud,
       CASE WHEN l_quantity >= 48 THEN 0.5 ELSE 0.0 END + CAST(l_partkey % 50 AS DOUBLE) / 100 AS score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "rides": """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
       CASE WHEN l_suppkey % 30 = 0 THEN 0 ELSE CAST(floor(l_extendedprice / 30) AS INT) END AS bike_count,
       CAST(l_orderkey % 24 AS INT) AS hour, l_quantity * 1.2 - 20 AS temperature,
       CAST(l_partkey % 99 AS INT) AS humidity, l_discount * 50 AS wind_speed,
       CAST(100 + (l_partkey * 13) % 1900 AS INT) AS visibility,
       l_quantity * 1.2 - 20 - (100 - l_partkey % 99) / 5.0 AS dew_point,
       CASE WHEN l_tax < 0.01 THEN l_quantity / 10 ELSE CAST(0 AS DOUBLE) END AS rainfall,
       CAST(CASE WHEN l_tax >= 0.07 AND l_quantity < 10 THEN 1 ELSE 0 END AS DOUBLE) AS snowfall,
       CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter' WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Spring'
            WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
       CASE WHEN l_partkey % 20 = 0 THEN 'Holiday' ELSE 'No Holiday' END AS holiday,
       CASE WHEN l_suppkey % 30 = 0 THEN 'No' ELSE 'Yes' END AS functioning_day
FROM lineitem""",
    "passengers": """
SELECT c_custkey AS PassengerId, CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END AS Survived,
       CAST(1 + c_custkey % 3 AS INT) AS Pclass,
       concat(c_name, ', ', CASE c_custkey % 7 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Mrs' WHEN 2 THEN 'Miss'
              WHEN 3 THEN 'Mlle' WHEN 4 THEN 'Dr' WHEN 5 THEN 'Ms' ELSE 'Master' END, '. X') AS Name,
       CASE WHEN c_custkey % 7 IN (1, 2, 3, 5) THEN 'female' ELSE 'male' END AS Sex,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 80 AS DOUBLE) END AS Age,
       CAST(c_custkey % 4 AS INT) AS SibSp, CAST(c_custkey % 3 AS INT) AS Parch,
       concat('T', CAST(c_custkey % 400 AS VARCHAR)) AS Ticket,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal / 20 END AS Fare,
       CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE NULL END AS Cabin,
       CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'C' ELSE 'S' END AS Embarked
FROM customer""",
    "churn": """
SELECT c_custkey AS customer_id, CAST(18 + c_custkey % 60 AS INT) AS age,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END AS offer,
       CASE n_regionkey WHEN 0 THEN 'Month-to-Month' WHEN 1 THEN 'One Year' ELSE 'Two Year' END AS contract,
       c_acctbal AS monthly_charge, 'United States' AS country, coalesce(n_orders, 0) AS tenure,
       CASE WHEN coalesce(n_orders, 0) < 9 THEN 'Yes' ELSE 'No' END AS churn_label
FROM customer JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "houses": """
SELECT p_partkey AS house_id, CAST(p_size AS DOUBLE) AS size,
       coalesce(avg_quantity, 0.0) AS avg_quantity, coalesce(avg_discount, 0.0) AS avg_discount,
       CAST(coalesce(rating_count, 0) AS DOUBLE) AS rating_count, p_retailprice AS price
FROM part LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS avg_quantity, avg(l_discount) AS avg_discount,
                            count(*) AS rating_count FROM lineitem GROUP BY l_partkey) l
     ON p_partkey = l_partkey""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the stand-in views it references, as CTEs."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in used)
    body = sql.strip()
    if re.match(r"(?is)^with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
