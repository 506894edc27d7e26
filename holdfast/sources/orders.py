"""Account view over an order table: one order is one account.

The text means the same in Spark (ANSI on) and in other ANSI engines; money is
kept in whole cents until the last projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ACCOUNT_VIEW_SQL = """
WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         CAST((2001 - year(o_orderdate)) * 12 + (8 - month(o_orderdate)) AS int) AS tenure,
         CAST(floor(CAST(round(o_totalprice * 100) AS bigint) / CAST(5000 AS double)) AS bigint) AS mc_cents
  FROM orders
), c AS (
  SELECT *,
         CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'Month-to-month'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'One year'
              ELSE 'Two year' END AS contract_,
         CAST(floor(mc_cents * tenure * (80 + o_custkey % 41) / CAST(100 AS double)) AS bigint) AS tc_cents
  FROM b
)
SELECT
  concat('ACC-', CAST(o_orderkey AS string)) AS customerID,
  CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN o_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
  CASE WHEN o_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN o_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
  tenure,
  CASE WHEN o_orderkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
  CASE WHEN o_orderkey % 10 = 0 THEN 'No phone service' WHEN (o_custkey*3 + o_orderkey*5) % 7 < 3 THEN 'Yes' ELSE 'No' END AS MultipleLines,
  CASE WHEN o_custkey % 5 = 0 THEN 'No' WHEN o_custkey % 5 < 3 THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*5 + o_orderkey*3) % 7 < 2 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*2 + o_orderkey*9) % 7 < 3 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*9 + o_orderkey*11) % 7 < 3 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*11 + o_orderkey*13) % 7 < 2 THEN 'Yes' ELSE 'No' END AS TechSupport,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*13 + o_orderkey*15) % 7 < 4 THEN 'Yes' ELSE 'No' END AS StreamingTV,
  CASE WHEN o_custkey % 5 = 0 THEN 'No internet service' WHEN (o_custkey*15 + o_orderkey*17) % 7 < 4 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
  contract_ AS Contract,
  CASE WHEN o_custkey % 2 = 1 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
  CASE o_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
  mc_cents / CAST(100 AS double) AS MonthlyCharges,
  CASE WHEN tenure = 0 OR o_orderkey % 101 = 0 THEN ' '
       ELSE concat(CAST(CAST(floor(tc_cents / CAST(100 AS double)) AS bigint) AS string), '.', lpad(CAST(tc_cents % 100 AS string), 2, '0')) END AS TotalCharges,
  CASE WHEN (o_custkey*7 + o_orderkey*13) % 100
            < (CASE contract_ WHEN 'Month-to-month' THEN 43 WHEN 'One year' THEN 12 ELSE 4 END)
              + (CASE WHEN tenure < 12 THEN 20 ELSE 0 END)
       THEN 'Yes' ELSE 'No' END AS Churn,
  ((CASE contract_ WHEN 'Month-to-month' THEN 300 WHEN 'One year' THEN 100 ELSE 0 END)
    + (CASE WHEN tenure < 12 THEN 150 ELSE 0 END)
    + (o_custkey*17 + o_orderkey*29) % 500) / CAST(1000 AS double) AS churn_probability
FROM c
"""


def accounts_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 account columns plus ``churn_probability``, a stand-in score."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(ACCOUNT_VIEW_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)
