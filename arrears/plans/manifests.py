"""What the stages of a run have finished: one manifest per stage, published at its end.

A stage writes its tables beside the ones of its last run, each into a folder of its own
version. Its manifest names them, the versions of the tables it read, its settings and the
state of the raw files; it is written under another name and renamed, so it is there whole
or not at all. A stage that broke off has no manifest, and what it wrote is never read.
"""

from __future__ import annotations

import hashlib
import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.sources.tables import Tables


class Manifests:
    """The manifests in a run's folder, any file system that Spark can use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _of(self, stage: int) -> str:
        return f"{self.folder}/_manifests/{stage}"

    def current(self, stage: int) -> dict | None:
        """The last published manifest of a stage."""
        names = [n for n in self._listed(self._of(stage)) if n.endswith(".json")]
        if not names:
            return None
        stream = self._fs.open(self._path(f"{self._of(stage)}/{names[-1]}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def publish(self, stage: int, manifest: dict) -> None:
        """Make this the stage's manifest, and remove the versions it replaces."""
        folder = self._of(stage)
        number = len([n for n in self._listed(folder) if n.endswith(".json")])
        draft = self._path(f"{folder}/{uuid4().hex}.draft")
        stream = self._fs.create(draft)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        if not self._fs.rename(draft, self._path(f"{folder}/{number:08d}.json")):
            raise RuntimeError(f"the manifest of stage {stage} could not be published")
        for name, version in manifest["tables"].items():
            for other in self._listed(f"{self.folder}/{name}"):
                if other != version:
                    self._fs.delete(self._path(f"{self.folder}/{name}/{other}"), True)


def raw_state(tables: Tables) -> dict[str, str]:
    """A fingerprint of each raw table: of its files if it has any, else of its rows."""
    return {name: _files_state(df) or _rows_state(df) for name, df in tables.items()}


def _files_state(df: DataFrame) -> str:
    files = sorted(df.inputFiles())
    if not files:
        return ""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for file in files:
        at = path(file)
        status = at.getFileSystem(settings).getFileStatus(at)
        rows.append((file, status.getLen(), status.getModificationTime()))
    return f"{df.schema.simpleString()} of {len(rows)} files {_digest(rows)}"


def _rows_state(df: DataFrame) -> str:
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    n, state = df.agg(F.count(F.lit(1)), total).first()
    return f"{df.schema.simpleString()} of {n} rows {state}"


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value).encode()).hexdigest()
