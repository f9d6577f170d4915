"""Raw tables kept in buckets of their join keys, so later runs do not shuffle them.

Every table is written once, dealt and sorted by the key that its features are grouped and
joined by. Parquet files do not tell about that, so the reader declares the tables again,
with the layout that stands beside them; the optimizer then groups and joins them bucket by
bucket without an exchange.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from arrears.sources.tables import Tables

# The keys by which the features group each table first.
KEYS = {
    "application": "SK_ID_CURR",
    "installments": "SK_ID_CURR",
    "card_balance": "SK_ID_CURR",
    "bureau": "SK_ID_BUREAU",
    "bureau_balance": "SK_ID_BUREAU",
}
LAYOUT = "_layout"


def write_bucketed(tables: Tables, folder: str, buckets: int | None = None) -> None:
    """Write each table as sorted buckets, by default as many as the session has partitions.

    With that number what still has to be shuffled meets the buckets as it is.
    One shuffle per table. A key with many rows makes one large bucket, as it would make one
    large partition in the shuffle that the layout saves. Existing tables are replaced.
    """
    for name, df in tables.items():
        spark = df.sparkSession
        number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path, key = f"{folder.rstrip('/')}/{name}", KEYS[name]
        table = f"bucketed_{uuid4().hex}"
        # Rows are dealt first, so that every bucket is one file.
        dealt = df.repartition(number, key)
        writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
        writer.bucketBy(number, key).sortBy(key).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the entry only; the files of a given path stay
        layout = spark.createDataFrame([(key, number, df.schema.json())], "key string, buckets int, fields string")
        layout.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{LAYOUT}/{name}")


def read_bucketed(spark: SparkSession, folder: str, names: list[str] | None = None) -> Tables:
    """The written tables with their buckets known to the optimizer."""
    return {name: _declared(spark, folder.rstrip("/"), name) for name in names or KEYS}


def _declared(spark: SparkSession, folder: str, name: str) -> DataFrame:
    layout = spark.read.parquet(f"{folder}/{LAYOUT}/{name}").first()
    schema = StructType.fromJson(json.loads(layout.fields))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    table = f"bucketed_{uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({layout.key}) "
        f"SORTED BY ({layout.key}) INTO {layout.buckets} BUCKETS LOCATION '{folder}/{name}'"
    )
    return spark.table(table)
