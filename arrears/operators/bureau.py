"""Credit bureau features: accounts at all lenders and their monthly status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.operators.installments import DAYS_PER_MONTH

# Status codes of a month (0-5 arrears bucket, C closed, X unknown).
ARREARS_CODES = ("0", "1", "2", "3", "4", "5")
CLOSED = "C"


def bucketed_months(bureau_balance: DataFrame, as_of: int) -> DataFrame:
    """Past account months with their numeric arrears bucket."""
    status = F.col("STATUS")
    bucket = F.when(status.isin(*ARREARS_CODES), status.try_cast("int")).when(status == CLOSED, 0)
    return bureau_balance.where(F.col("MONTHS_BALANCE") < -as_of).select(
        "SK_ID_BUREAU",
        (F.col("MONTHS_BALANCE") + as_of).alias("MONTHS_BALANCE"),
        "STATUS",
        bucket.alias("dpd_bucket"),
    )


def bureau_months(bureau: DataFrame, bureau_balance: DataFrame, as_of: int = 0) -> DataFrame:
    """Past account months of known accounts with their numeric arrears bucket."""
    owners = bureau.select("SK_ID_BUREAU", "SK_ID_CURR")
    return bucketed_months(bureau_balance, as_of).join(owners, "SK_ID_BUREAU")


def bureau_status(bureau: DataFrame, bureau_balance: DataFrame, as_of: int = 0) -> DataFrame:
    """Delinquency rates, worst bucket and bucket slope per customer.

    Months shrink to one row of counts and sums per account before they meet the account
    owners, so the join moves accounts, not months, and no account is large in it. All
    summands are integers, which keeps the slope from sums exact.
    """
    month, bucket = F.col("MONTHS_BALANCE").cast("bigint"), F.col("dpd_bucket")
    known, delinquent, last_year = bucket.isNotNull(), bucket >= 1, F.col("MONTHS_BALANCE") >= -12
    per_account = (
        bucketed_months(bureau_balance, as_of)
        .groupBy("SK_ID_BUREAU")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.count(F.when(delinquent, 1)).alias("bad_months"),
            F.count(F.when(last_year & known, 1)).alias("months_12m"),
            F.count(F.when(last_year & delinquent, 1)).alias("bad_months_12m"),
            F.max(bucket).alias("worst"),
            F.count(bucket).alias("n"),
            F.min(F.when(known, month)).alias("first_month"),
            F.max(F.when(known, month)).alias("last_month"),
            F.sum(F.when(known, month)).alias("sx"),
            F.sum(bucket).alias("sy"),
            F.sum(F.when(known, month * month)).alias("sxx"),
            F.sum(month * bucket).alias("sxy"),
        )
    )
    owners = bureau.select("SK_ID_BUREAU", "SK_ID_CURR")
    summed = ["months", "bad_months", "months_12m", "bad_months_12m", "n", "sx", "sy", "sxx", "sxy"]
    per_customer = (
        per_account.join(owners, "SK_ID_BUREAU")
        .groupBy("SK_ID_CURR")
        .agg(
            *[F.sum(c).alias(c) for c in summed],
            F.max("worst").alias("bur_worst_status_ever"),
            F.min("first_month").alias("first_month"),
            F.max("last_month").alias("last_month"),
        )
    )
    n, sx, sy = (F.col(c).cast("double") for c in ("n", "sx", "sy"))
    slope = F.try_divide(n * F.col("sxy") - sx * sy, n * F.col("sxx") - sx * sx)
    return per_customer.select(
        "SK_ID_CURR",
        F.try_divide("bad_months", "months").alias("bur_delinq_rate"),
        F.try_divide("bad_months_12m", "months_12m").alias("bur_delinq_rate_12m"),
        "bur_worst_status_ever",
        F.when(F.col("first_month") < F.col("last_month"), slope).alias("bur_status_trend"),
    )


def bureau_accounts(bureau: DataFrame, as_of: int = 0) -> DataFrame:
    """Account counts, overdue days and amounts, leverage and age of credit per customer.

    Accounts carry today's state only. As of an earlier month, what hangs on it (status,
    overdue days and amounts, debt) is unknown and null.
    """
    shift = as_of * DAYS_PER_MONTH
    opened = F.col("DAYS_CREDIT") + shift
    known = bureau.where(F.col("DAYS_CREDIT") <= -shift) if as_of else bureau
    credit = F.sum("AMT_CREDIT_SUM")
    active = F.sum(F.when(F.col("CREDIT_ACTIVE") == "Active", 1).otherwise(0))
    today = {
        "bur_active_accounts": (active, "bigint"),
        "bur_days_overdue_mean": (F.avg("CREDIT_DAY_OVERDUE"), "double"),
        "bur_days_overdue_max": (F.max("CREDIT_DAY_OVERDUE"), "int"),
        "bur_amt_overdue_sum": (F.sum("AMT_CREDIT_SUM_OVERDUE"), "double"),
        "bur_debt_credit_ratio": (
            F.when(credit > 0, F.try_divide(F.sum("AMT_CREDIT_SUM_DEBT"), credit)),
            "double",
        ),
    }
    return known.groupBy("SK_ID_CURR").agg(
        F.count(F.lit(1)).alias("bur_total_accounts"),
        *[
            (F.lit(None) if as_of else value).cast(kind).alias(name)
            for name, (value, kind) in today.items()
        ],
        F.min(opened).alias("bur_days_credit_min"),
        F.avg(opened).alias("bur_days_credit_mean"),
    )


def bureau_features(bureau: DataFrame, bureau_balance: DataFrame, as_of: int = 0) -> DataFrame:
    """12 features per customer that has a bureau account."""
    return bureau_accounts(bureau, as_of).join(
        bureau_status(bureau, bureau_balance, as_of), "SK_ID_CURR", "left"
    )
