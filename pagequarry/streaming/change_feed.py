"""A feed of source changes with monotone versions, from pairs of snapshots to a stream.

``ChangeFeed.publish(old, new, key, text)`` compares two snapshots of a
source by key and content hash (``capture_changes``: only keys and hashes are
shuffled), attaches the new text to inserts and updates, and writes the
changes as ``id, text, version, deleted`` into the next numbered folder
``publish=<n>``. Every publication's version is one above the highest one
written, so a later publication always wins over an earlier one, whatever
order the files are read in. Rows whose key is null cannot be told apart from
each other: they are left out of the feed. A publication without changes
writes an empty folder and still takes its number.

``stream(max_files)`` reads the feed as a file stream that takes at most
``max_files`` new files per micro-batch. Applied by :class:`IndexSync`, a
replayed file changes nothing: its versions are not newer than what the
index holds, and a text whose hash did not change is not embedded again.
One publisher at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.operators.index import capture_changes
from pagequarry.sources.tables import list_numbers

SCHEMA = "id {key}, text string, version bigint, deleted boolean"


class ChangeFeed:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def version(self) -> int:
        """The highest version published, 0 before the first."""
        return max(list_numbers(self.spark, self.folder, "publish="), default=0)

    def publish(self, old: DataFrame, new: DataFrame, key: str, text: str) -> int:
        """Write the changes from ``old`` to ``new``; returns their version."""
        version = self.version() + 1
        keyed_old, keyed_new = old.where(F.col(key).isNotNull()), new.where(F.col(key).isNotNull())
        changes = capture_changes(keyed_old, keyed_new, key, text)
        texts = keyed_new.select(F.col(key), F.col(text).alias("text"))
        rows = changes.join(texts, key, "left").select(
            F.col(key).alias("id"),
            F.when(F.col("change") != "delete", F.col("text")).alias("text"),
            F.lit(version).cast("bigint").alias("version"),
            (F.col("change") == "delete").alias("deleted"),
        )
        rows.write.parquet(f"{self.folder}/publish={version}")
        return version

    def schema(self, key_type: str) -> str:
        return SCHEMA.format(key=key_type) + ", publish bigint"

    def stream(self, key_type: str = "bigint", max_files: int = 1) -> DataFrame:
        """The feed as a stream of ``id, text, version, deleted``, ``max_files`` files per micro-batch."""
        return (
            self.spark.readStream.schema(self.schema(key_type))
            .option("maxFilesPerTrigger", max_files)
            .parquet(self.folder)
            .drop("publish")
        )
