"""Tables that grow by batches: each is written apart and then published at once, by a new version of the list of batches."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.sources.shared import move

LIST = "version int, batch string, name string, path string"


class Batches:
    """A folder of batches. Readers see what the newest list names; data that no list names was never published."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def listed(self) -> list:
        """version, batch, name, path of the newest list: a row for each table of each batch."""
        try:
            rows = self.spark.read.schema(LIST).json(f"{self.folder}/lists/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        newest = rows.agg(F.max("version")).first()[0]
        return rows.filter(F.col("version") == newest).collect()

    def append(self, batch: str, **tables: DataFrame) -> bool:
        """Write the tables of a batch and publish them together. Whether they were published now: a batch that is there already
        is left as it is, so a run that is repeated after a failure finds its own. An empty first table is an error, and nothing
        is published; of two writers at once, one fails."""
        known = self.listed()
        if any(r["batch"] == batch for r in known):
            return False
        new = []
        for name, df in tables.items():
            path = f"{self.folder}/data/{batch}-{name}-{uuid.uuid4().hex}"
            df.write.parquet(path)
            if not new and self.spark.read.schema(df.schema).parquet(path).isEmpty():
                raise ValueError(f"batch {batch} has no {name}")
            new.append((batch, name, path))
        self.publish([*((r["batch"], r["name"], r["path"]) for r in known), *new], 1 + max((r["version"] for r in known), default=0))
        return True

    def publish(self, rows: list[tuple], version: int) -> None:
        """The list under a temporary name first; the rename to the next version's name is what readers see."""
        temporary = f"{self.folder}/list-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(version, *r) for r in rows], LIST).coalesce(1).write.json(temporary)
        lists = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/lists")
        lists.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(lists)
        move(self.spark, temporary, f"{self.folder}/lists/{version:08d}")

    def read(self, name: str, schema: str) -> DataFrame:
        """A table of all published batches; without any, an empty one."""
        paths = [r["path"] for r in self.listed() if r["name"] == name]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
