"""Stand-in inputs built from the driver tables.

The reference works on a keyed table of people with a rare positive class,
text-valued cells and the sentinel string ``"NaN"`` for missing values, plus a
sum row called ``TOTAL``.  ``person_records`` rebuilds that shape from
``customer`` ⟕ ``orders`` so that every operator runs over whole tables and its
work grows with them:

* key ``id`` = customer name, class ``poi`` = 'True' when the customer placed
  15 or more orders (the count itself is *not* a feature);
* missing values are planted by data-driven rules (negative balance, fewer than
  6 orders, no high-priority order, no finished order, segment BUILDING has
  no address);
* ``avg_price`` averages finished orders only (a plain average would make
  total/avg the order count and leak the class);
* a ``TOTAL`` row holds the column sums, as in the reference's spreadsheet.

Each builder has a SQL twin (DuckDB dialect) used by ``oracle_sql()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raremine.functions.numeric import det_round
from raremine.sources.tables import read_table

KEY = "id"
TARGET = "poi"
EMAIL = "email_address"
# numeric columns of the stand-in person table, in column order
NUMERIC = ["acctbal", "total_price", "max_price", "avg_price", "min_price", "n_urgent", "n_high"]
POSITIVE_MIN_ORDERS = 15


def person_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed person values, missing = null (no TOTAL row, no sentinels)."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        det_round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.max("o_totalprice").alias("max_price"),
        # average over finished orders only: a plain average would make
        # total/avg equal the order count and leak the class exactly
        det_round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2).alias("avg_price"),
        F.min("o_totalprice").alias("min_price"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("n_high"),
    )
    joined = customer.join(per_customer, customer.c_custkey == per_customer.o_custkey, "left")
    n_orders = F.coalesce(F.col("n_orders"), F.lit(0))
    return joined.select(
        F.col("c_name").alias(KEY),
        (n_orders >= POSITIVE_MIN_ORDERS).alias(TARGET),
        F.when(F.col("c_mktsegment") != "BUILDING",
               F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))).alias(EMAIL),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
        F.col("total_price"),
        F.col("max_price"),
        F.col("avg_price"),
        F.when(n_orders >= 6, F.col("min_price")).alias("min_price"),
        F.coalesce(F.col("n_urgent"), F.lit(0)).cast("double").alias("n_urgent"),
        F.when(F.col("n_high") > 0, F.col("n_high")).cast("double").alias("n_high"),
    )


def person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw record set: every cell a string, 'NaN' for missing, plus TOTAL."""
    vals = person_values(spark, sf_dir)
    total = vals.agg(
        F.lit("TOTAL").alias(KEY), F.lit(False).alias(TARGET), F.lit(None).cast("string").alias(EMAIL),
        *[det_round(F.sum(c), 2).alias(c) for c in NUMERIC])
    both = vals.unionByName(total)

    def as_text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("NaN")).alias(c)

    return both.select(
        F.col(KEY),
        F.when(F.col(TARGET), F.lit("True")).otherwise(F.lit("False")).alias(TARGET),
        F.coalesce(F.col(EMAIL), F.lit("NaN")).alias(EMAIL),
        *[as_text(c) for c in NUMERIC])


# ---------------------------------------------------------------- SQL twins --

PERSON_VALUES_SQL = f"""
o_agg AS (
  SELECT o_custkey, count(*) AS n_orders,
         round(sum(o_totalprice), 2) AS total_price, max(o_totalprice) AS max_price,
         round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS avg_price, min(o_totalprice) AS min_price,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS n_high
  FROM orders GROUP BY o_custkey),
person_values AS (
  SELECT c.c_name AS id,
         coalesce(n_orders, 0) >= {POSITIVE_MIN_ORDERS} AS poi,
         CASE WHEN c.c_mktsegment <> 'BUILDING'
              THEN lower(replace(c.c_name, '#', '.')) || '@example.com' END AS email_address,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS acctbal,
         total_price, max_price, avg_price,
         CASE WHEN coalesce(n_orders, 0) >= 6 THEN min_price END AS min_price,
         CAST(coalesce(n_urgent, 0) AS DOUBLE) AS n_urgent,
         CAST(CASE WHEN n_high > 0 THEN n_high END AS DOUBLE) AS n_high
  FROM customer c LEFT JOIN o_agg ON c.c_custkey = o_agg.o_custkey)"""

# cleaned form of person_records (sentinel -> null, target -> 0/1), TOTAL included
PERSON_CLEAN_SQL = PERSON_VALUES_SQL + """,
person_clean AS (
  SELECT id, CAST(poi AS INTEGER) AS poi, email_address, acctbal, total_price, max_price,
         avg_price, min_price, n_urgent, n_high FROM person_values
  UNION ALL
  SELECT 'TOTAL', 0, NULL, round(sum(acctbal), 2), round(sum(total_price), 2),
         round(sum(max_price), 2), round(sum(avg_price), 2), round(sum(min_price), 2),
         round(sum(n_urgent), 2), round(sum(n_high), 2) FROM person_values)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)

# train frame of the reference flow: email filled with '-1' and label-encoded
# (codes over all rows, TOTAL included), TOTAL dropped, every other null -> -1
TRAIN_SQL = PERSON_CLEAN_SQL + """,
codes AS (SELECT e, CAST(dense_rank() OVER (ORDER BY e) - 1 AS INTEGER) AS email_address_code
          FROM (SELECT DISTINCT coalesce(email_address, '-1') AS e FROM person_clean)),
train AS (SELECT p.id, p.poi, coalesce(acctbal, -1) AS acctbal, coalesce(total_price, -1) AS total_price,
                 coalesce(max_price, -1) AS max_price, coalesce(avg_price, -1) AS avg_price,
                 coalesce(min_price, -1) AS min_price, coalesce(n_urgent, -1) AS n_urgent,
                 coalesce(n_high, -1) AS n_high, c.email_address_code
          FROM person_clean p JOIN codes c ON coalesce(p.email_address, '-1') = c.e
          WHERE p.id <> 'TOTAL')"""


def train_frame(spark: SparkSession, sf_dir: str, code: bool = False) -> DataFrame:
    """Spark twin of TRAIN_SQL built from the operators.  The label code of the
    address needs a global rank of its values, so it is made on request."""
    from raremine.operators.clean import clean_records, drop_row_by_key, encode_label, impute_constant

    clean = clean_records(person_records(spark, sf_dir), TARGET)
    coded = encode_label(clean, EMAIL, EMAIL + "_code") if code else clean
    kept = drop_row_by_key(coded, "TOTAL")
    return impute_constant(kept, -1, NUMERIC).drop(EMAIL)
