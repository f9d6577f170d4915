"""The feature store: one row per labelled customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.operators.bureau import bureau_features
from arrears.operators.card import card_features
from arrears.operators.installments import DAYS_PER_MONTH, installment_features
from arrears.sources.tables import Tables

# Application columns and their names in the store.
APPLICATION_NAMES = {
    "AMT_CREDIT": "app_loan_amount",
    "AMT_ANNUITY": "app_emi",
    "AMT_INCOME_TOTAL": "app_income",
    "DAYS_BIRTH": "app_age_days",
    "DAYS_EMPLOYED": "app_days_employed",
    "CODE_GENDER": "CODE_GENDER",
    "NAME_CONTRACT_TYPE": "NAME_CONTRACT_TYPE",
}
# The feature columns of the store by family.
INSTALLMENT_COLUMNS = [
    "ins_days_late_mean",
    "ins_days_late_max",
    "ins_underpay_ratio_mean",
    "ins_pct_missed",
    "ins_pct_late",
    "ins_late_trend",
    "ins_days_late_l3m",
    "ins_underpay_ratio_l3m",
    "ins_missed_count_l3m",
    "ins_days_late_l6m",
    "ins_underpay_ratio_l6m",
    "ins_late_momentum",
]
CARD_COLUMNS = [
    "cc_util_mean",
    "cc_util_max",
    "cc_util_l3m",
    "cc_util_trend",
    "cc_balance_mean",
    "cc_balance_l3m",
    "cc_balance_trend",
    "cc_dpd_mean",
    "cc_dpd_max",
    "cc_dpd_l3m",
    "cc_min_pay_ratio_mean",
    "cc_min_pay_ratio_l3m",
    "cc_drawings_trend",
]
BUREAU_COLUMNS = [
    "bur_total_accounts",
    "bur_active_accounts",
    "bur_days_overdue_mean",
    "bur_days_overdue_max",
    "bur_amt_overdue_sum",
    "bur_debt_credit_ratio",
    "bur_days_credit_min",
    "bur_delinq_rate",
    "bur_delinq_rate_12m",
    "bur_worst_status_ever",
    "bur_status_trend",
]
CROSS_COLUMNS = ["stress_composite", "n_products_delinquent"]

STORE_FAMILY_COLUMNS = [
    *INSTALLMENT_COLUMNS,
    *CARD_COLUMNS,
    # Counts that the families know and the store leaves out.
    "ins_total_obs",
    "ins_obs_l3m",
    "ins_obs_l6m",
    "cc_total_obs",
    "cc_obs_l3m",
]

MODEL_FEATURES = INSTALLMENT_COLUMNS + CARD_COLUMNS + BUREAU_COLUMNS + CROSS_COLUMNS


def available(columns: list[str], df: DataFrame) -> list[str]:
    """The wanted columns that ``df`` has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def application_spine(
    application: DataFrame, days: int | Column = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """Labelled applications under their names in the store, as of so many days back.

    Ages count days back from the moment of the store.
    """
    return application.where(F.col("TARGET").isNotNull()).select(
        "SK_ID_CURR",
        "TARGET",
        *keep,
        *[
            (F.col(c) + days if c.startswith("DAYS_") else F.col(c)).alias(n)
            for c, n in APPLICATION_NAMES.items()
        ],
    )


def with_families(
    spine: DataFrame, families: Sequence[DataFrame], on: Sequence[str], beside: Sequence[str] = ()
) -> DataFrame:
    """The columns of the store from the spine and its families, which share the key ``on``.

    Each family arrives grouped by the key, so its join needs no second shuffle.
    """
    joined = spine
    for family in families:
        joined = joined.join(family, list(on), "left")

    def signal(column: str) -> F.Column:
        return F.coalesce(F.col(column), F.lit(0.0))

    def flag(column: str) -> F.Column:
        return F.when(signal(column) > 0, 1).otherwise(0)

    return joined.select(
        *on,
        "TARGET",
        *APPLICATION_NAMES.values(),
        *INSTALLMENT_COLUMNS,
        *CARD_COLUMNS,
        *BUREAU_COLUMNS,
        (signal("ins_underpay_ratio_l3m") * signal("cc_util_l3m") * signal("bur_delinq_rate_12m")).alias(
            "stress_composite"
        ),
        (flag("ins_days_late_l3m") + flag("cc_dpd_l3m") + flag("bur_delinq_rate_12m")).alias(
            "n_products_delinquent"
        ),
        F.col("bur_status_trend").alias("bur_momentum"),
        *beside,
    )


def feature_store(
    tables: Tables, as_of: int = 0, beside: Mapping[str, Sequence[Column]] | None = None
) -> DataFrame:
    """Labelled applications with the features of all families, as of months back.

    ``beside`` are further aggregates of the installments or the card balance by customer;
    they come from the same pass and stand behind the columns of the store.
    """
    beside = beside or {}
    families = [
        installment_features(tables["installments"], as_of, beside.get("installments", ())),
        card_features(tables["card_balance"], as_of, beside.get("card_balance", ())),
        bureau_features(tables["bureau"], tables["bureau_balance"], as_of),
    ]
    further = [
        c for f in families[:2] for c in f.columns if c not in (*STORE_FAMILY_COLUMNS, "SK_ID_CURR")
    ]
    spine = application_spine(tables["application"], as_of * DAYS_PER_MONTH)
    return with_families(spine, families, ["SK_ID_CURR"], further)
