"""The five raw tables as views over the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.sources.tables import Tables, project

INSTALMENTS_END = "2001-03-01"
CARD_END = "2024-01-30"
BUREAU_END = "2001-12-01"


def _days_to(column: str, end: str) -> F.Column:
    return F.datediff(F.col(column).cast("date"), F.lit(end).cast("date"))


def application(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("SK_ID_CURR"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("TARGET"),
        F.when(key % 20 != 0, 10000 + 10 * F.abs("c_acctbal")).alias("AMT_CREDIT"),
        F.lit(None).cast("double").alias("AMT_ANNUITY"),
        F.lit(None).cast("double").alias("AMT_INCOME_TOTAL"),
        F.lit(None).cast("int").alias("DAYS_BIRTH"),
        F.lit(None).cast("int").alias("DAYS_EMPLOYED"),
        F.lit(None).cast("string").alias("CODE_GENDER"),
        F.col("c_mktsegment").alias("NAME_CONTRACT_TYPE"),
    )


def installments(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    due = _days_to("o_orderdate", INSTALMENTS_END).cast("double")
    status = F.concat("l_returnflag", "l_linestatus")
    unpaid = status == "NO"
    price = F.col("l_extendedprice")
    paid = price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return lineitem.join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    ).select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        due.alias("DAYS_INSTALMENT"),
        F.when(~unpaid, due + F.col("l_quantity").cast("int") - 20).alias("DAYS_ENTRY_PAYMENT"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0)).otherwise(price).alias("AMT_INSTALMENT"),
        F.when(status == "RF", F.lit(0.0)).when(~unpaid, paid).alias("AMT_PAYMENT"),
    )


def card_balance(events: DataFrame) -> DataFrame:
    def of_type(kind: str, value: F.Column, default: F.Column | None = None) -> F.Column:
        chosen = F.when(F.col("event_type") == kind, value)
        return chosen if default is None else chosen.otherwise(default)

    value = F.col("value")
    user = F.col("SK_ID_CURR")
    monthly = events.groupBy(
        F.col("user_id").alias("SK_ID_CURR"), _days_to("ts", CARD_END).alias("MONTHS_BALANCE")
    ).agg(
        F.sum(value).alias("AMT_BALANCE"),
        F.sum(of_type("purchase", value)).alias("AMT_PAYMENT_CURRENT"),
        F.sum(of_type("view", value / 10, F.lit(0.0))).alias("AMT_INST_MIN_REGULARITY"),
        F.sum(of_type("click", value, F.lit(0.0))).alias("AMT_DRAWINGS_CURRENT"),
        F.count(of_type("error", F.lit(1))).alias("SK_DPD"),
    )
    limit = F.when(user % 11 == 0, F.lit(0.0)).otherwise(F.lit(200.0) + 100 * (user % 5))
    return project(monthly.withColumn("AMT_CREDIT_LIMIT_ACTUAL", limit), "card_balance")


def bureau(orders: DataFrame) -> DataFrame:
    price = F.col("o_totalprice")
    status = F.col("o_orderstatus")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.when(status == "O", "Active").when(status == "F", "Closed").otherwise("Sold").alias("CREDIT_ACTIVE"),
        F.when(urgent, (F.col("o_orderkey") % 30).cast("int")).otherwise(0).alias("CREDIT_DAY_OVERDUE"),
        F.when(urgent, price * 0.1).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(status == "F", F.lit(0.0)).when(status != "P", price * 0.4).alias("AMT_CREDIT_SUM_DEBT"),
        _days_to("o_orderdate", BUREAU_END).alias("DAYS_CREDIT"),
    )


def bureau_balance(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        ((F.year("l_shipdate") - 2001) * 12 + F.month("l_shipdate") - 11).alias("MONTHS_BALANCE"),
        F.when(flag == "R", (1 + F.col("l_linenumber") % 5).cast("string"))
        .when(flag == "A", "0")
        .when(F.col("l_linestatus") == "O", "X")
        .otherwise("C")
        .alias("STATUS"),
    )


VIEWS = {
    "application": (application, ["customer"]),
    "installments": (installments, ["lineitem", "orders"]),
    "card_balance": (card_balance, ["events"]),
    "bureau": (bureau, ["orders"]),
    "bureau_balance": (bureau_balance, ["lineitem"]),
}


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(VIEWS)) -> Tables:
    """The wanted raw tables over the test tables in ``sf_dir``, each file opened once."""
    files: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in files:
            files[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        return files[name]

    views = {name: VIEWS[name] for name in names}
    return {name: view(*[read(f) for f in needed]) for name, (view, needed) in views.items()}
