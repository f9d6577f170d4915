"""The five raw tables: schemas, reading, the input check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the raw tables (the columns the operators use).
SCHEMAS = {
    "application": {
        "SK_ID_CURR": "bigint",
        "TARGET": "int",
        "AMT_CREDIT": "double",
        "AMT_ANNUITY": "double",
        "AMT_INCOME_TOTAL": "double",
        "DAYS_BIRTH": "int",
        "DAYS_EMPLOYED": "int",
        "CODE_GENDER": "string",
        "NAME_CONTRACT_TYPE": "string",
    },
    "installments": {
        "SK_ID_CURR": "bigint",
        "SK_ID_PREV": "bigint",
        "NUM_INSTALMENT_NUMBER": "int",
        "DAYS_INSTALMENT": "double",
        "DAYS_ENTRY_PAYMENT": "double",
        "AMT_INSTALMENT": "double",
        "AMT_PAYMENT": "double",
    },
    "card_balance": {
        "SK_ID_CURR": "bigint",
        "MONTHS_BALANCE": "int",
        "AMT_BALANCE": "double",
        "AMT_CREDIT_LIMIT_ACTUAL": "double",
        "AMT_PAYMENT_CURRENT": "double",
        "AMT_INST_MIN_REGULARITY": "double",
        "AMT_DRAWINGS_CURRENT": "double",
        "SK_DPD": "int",
    },
    "bureau": {
        "SK_ID_CURR": "bigint",
        "SK_ID_BUREAU": "bigint",
        "CREDIT_ACTIVE": "string",
        "CREDIT_DAY_OVERDUE": "int",
        "AMT_CREDIT_SUM_OVERDUE": "double",
        "AMT_CREDIT_SUM": "double",
        "AMT_CREDIT_SUM_DEBT": "double",
        "DAYS_CREDIT": "int",
    },
    "bureau_balance": {
        "SK_ID_BUREAU": "bigint",
        "MONTHS_BALANCE": "int",
        "STATUS": "string",
    },
}

# File name and published row count of each table.
FILES = {
    "application": "application_train",
    "installments": "installments_payments",
    "card_balance": "credit_card_balance",
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
}
PUBLISHED_ROWS = {
    "application": 307511,
    "installments": 13605401,
    "card_balance": 3840312,
    "bureau": 1716428,
    "bureau_balance": 27299925,
}
KEYS = {
    "application": ["SK_ID_CURR"],
    "installments": ["SK_ID_CURR"],
    "card_balance": ["SK_ID_CURR"],
    "bureau": ["SK_ID_BUREAU"],
    "bureau_balance": ["SK_ID_BUREAU"],
}

Tables = dict[str, DataFrame]


def project(df: DataFrame, table: str) -> DataFrame:
    """Keep the columns of ``table`` that the operators use, in their types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in SCHEMAS[table].items()])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make null the only marker of a missing number."""
    floats = (T.DoubleType, T.FloatType)
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, floats)
    }
    return df.withColumns(fixed) if fixed else df


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one table from CSV, matching columns by the header and inferring nothing.

    A CSV schema is applied by position, so the header names every column first; every
    file must have that header, and a cell that its type cannot hold is an error. Columns
    that are not used stay strings and are never parsed.
    """
    types = SCHEMAS[table]
    header = spark.read.option("header", True).csv(path).columns
    missing = sorted(set(types) - set(header))
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header)
    strict = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}
    return nan_to_null(spark.read.schema(schema).options(**strict).csv(path).select(*types))


def read_parquet(spark: SparkSession, path: str, table: str, nan_marks: bool = False) -> DataFrame:
    """Read one table from Parquet; ``nan_marks`` if its writer used NaN for missing."""
    df = project(spark.read.parquet(path), table)
    return nan_to_null(df) if nan_marks else df


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> Tables:
    """Read all five tables from ``folder`` and register each as a temporary view."""
    reader = {"csv": read_csv, "parquet": read_parquet}[fmt]
    tables = {
        name: reader(spark, f"{folder.rstrip('/')}/{stem}.{fmt}", name)
        for name, stem in FILES.items()
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def input_contract(tables: Tables, expected_rows: dict[str, int] | None = None) -> DataFrame:
    """One row per required table: its rows, its distinct keys and whether it is usable.

    A table is usable when it holds rows, and as many as expected where a count is given.
    """
    absent = sorted(set(SCHEMAS) - set(tables))
    if absent:
        raise ValueError(f"missing tables: {', '.join(absent)}")
    expected = expected_rows or {}

    def measure(name: str) -> DataFrame:
        counted = tables[name].agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*KEYS[name]).alias("distinct_keys")
        )
        want = expected.get(name)
        ok = F.col("n_rows") > 0 if want is None else F.col("n_rows") == want
        return counted.select(F.lit(name).alias("table_name"), "n_rows", "distinct_keys", ok.alias("ok"))

    return reduce(DataFrame.unionByName, [measure(n) for n in SCHEMAS])
