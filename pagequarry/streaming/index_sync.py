"""Keeps a vector index in step with a stream of source changes.

Layout below the index folder, one generation per compaction::

    gen=3/snapshot/shard=../   state of every key when the generation began
    gen=3/log/batch_id=../     rows written by each micro-batch since then

The newest version of a key wins, so the order in which changes arrive does
not matter. A repeated micro-batch replaces its own log folder.

State is kept apart from vectors: every entry says in ``vector_at`` where its
vector lies (-1 for the generation's snapshot, else the micro-batch that wrote
it). A micro-batch reads only the state columns of the keys it touches, so no
vector is read, not even of the rows it changes; a new version of an
unchanged text writes no vector, only the place of the one it keeps. Vectors
are looked up by (id, vector_at) when the index is read, and written beside
their state again by :meth:`compact`.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.operators.index import content_hash, newest_per_key
from pagequarry.operators.models import Embedder, embed
from pagequarry.sources.tables import DONE, _file_system, list_numbers, path_exists

SHARDS = 64
# ``vector_at`` of a vector held by the generation's snapshot.
IN_SNAPSHOT = -1
# Micro-batches of one stream numbered below 2^STREAM_BITS; the stream's number is above.
STREAM_BITS = 40
STATE = ["id", "content_hash", "version", "deleted", "vector_at", "shard"]


class IndexSync:
    """Applies changes ``id, text, version, deleted`` to an index ``id, vector, content_hash, version``."""

    def __init__(self, spark: SparkSession, folder: str, embedder: Embedder, id_type: T.DataType, shards: int = SHARDS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.embedder = embedder
        self.shards = shards
        self.schema = T.StructType(
            [
                T.StructField("id", id_type),
                T.StructField("vector", T.ArrayType(T.FloatType())),
                T.StructField("content_hash", T.StringType()),
                T.StructField("version", T.LongType()),
                T.StructField("deleted", T.BooleanType()),
                T.StructField("vector_at", T.LongType()),
                T.StructField("shard", T.LongType()),
            ]
        )

    # ---- storage ----

    def generation(self) -> int:
        for number in reversed(list_numbers(self.spark, self.folder, "gen=")):
            if path_exists(self.spark, f"{self.folder}/gen={number}/snapshot/{DONE}"):
                return number
        return 0

    def _next_generation(self) -> int:
        """Above every generation begun, so one that broke off half-way is left aside."""
        return max(list_numbers(self.spark, self.folder, "gen="), default=0) + 1

    def _snapshot_path(self, generation: int) -> str:
        return f"{self.folder}/gen={generation}/snapshot"

    def _log_path(self, generation: int) -> str:
        return f"{self.folder}/gen={generation}/log"

    def _with_shard(self, df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(self.shards)))

    def _write_snapshot(self, rows: DataFrame, generation: int) -> None:
        columns = self.schema.names
        # Rebalancing keeps a shard in few files and divides one that is too large for a task.
        placed = self._with_shard(rows).select(*columns).hint("rebalance", F.col("shard"))
        placed.write.partitionBy("shard").parquet(self._snapshot_path(generation))

    def build(self, source: DataFrame, id: str, text: str, version: int = 0) -> None:
        """First generation: embed the whole source."""
        rows = source.select(
            F.col(id).alias("id"),
            embed(F.coalesce(text, F.lit("")), self.embedder).alias("vector"),
            content_hash(F.col(text)).alias("content_hash"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(False).alias("deleted"),
            F.lit(IN_SNAPSHOT).cast("bigint").alias("vector_at"),
        )
        self._write_snapshot(rows, self._next_generation())

    def _log(self, generation: int, but_batch: int | None = None) -> DataFrame | None:
        path = self._log_path(generation)
        if not list_numbers(self.spark, path, "batch_id="):
            return None
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        log = self.spark.read.schema(schema).parquet(path)
        return log if but_batch is None else log.filter(F.col("batch_id") != but_batch)

    def entries(self, shards: list[int] | None = None, but_batch: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """Newest entry of every key, deleted ones included; ``columns`` limits what is read."""
        generation = self.generation()
        snapshot = self.spark.read.schema(self.schema).parquet(self._snapshot_path(generation))
        log = self._log(generation, but_batch)
        if columns is not None:
            snapshot = snapshot.select(*columns)
            log = None if log is None else log.select(*columns, "batch_id")
        if shards is not None:
            snapshot = snapshot.filter(F.col("shard").isin(shards))
            log = None if log is None else log.filter(F.col("shard").isin(shards))
        if log is None:
            return snapshot
        newest = newest_per_key(log, "id", "version", "batch_id").drop("batch_id")
        return snapshot.join(newest.select("id"), "id", "left_anti").unionByName(newest)

    def _vectors(self) -> DataFrame:
        """``id, vector_at, vector`` of every row that holds a vector."""
        generation = self.generation()
        held = (
            self.spark.read.schema(self.schema)
            .parquet(self._snapshot_path(generation))
            .where(F.col("vector").isNotNull())
            .select("id", F.lit(IN_SNAPSHOT).cast("bigint").alias("vector_at"), "vector")
        )
        log = self._log(generation)
        if log is not None:
            held = held.unionByName(log.where(F.col("vector").isNotNull()).select("id", F.col("batch_id").alias("vector_at"), "vector"))
        return held

    def resolved(self) -> DataFrame:
        """Newest entry of every key with its vector looked up where it lies."""
        state = self.entries(columns=STATE)
        return state.join(self._vectors(), ["id", "vector_at"], "left").select(*self.schema.names)

    def read(self) -> DataFrame:
        """The index as searches see it."""
        return self.resolved().filter(~F.col("deleted")).select("id", "vector", "content_hash", "version")

    # ---- changes ----

    def apply_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Write the entries one micro-batch leads to; text that did not change is not embedded again.

        Of changes with the same key and version a deletion wins, then the greatest content hash.
        """
        changes = changes.select("id", "text", "version", "deleted").withColumn(
            "new_hash", F.when(~F.col("deleted"), content_hash(F.col("text")))
        )
        newest = self._with_shard(newest_per_key(changes, "id", "version", "deleted", "new_hash"))
        newest.persist()
        try:
            # At most ``self.shards`` numbers; they prune the folders to read.
            touched = [row.shard for row in newest.select("shard").distinct().collect()]
            # Only state is read; the semi join lets a small batch travel to the index instead of shuffling it.
            current = self.current_state(touched, batch_id).join(newest.select("id"), "id", "left_semi")
            known = current.select(
                "id",
                F.col("vector_at").alias("old_at"),
                F.col("content_hash").alias("old_hash"),
                F.col("version").alias("old_version"),
            )
            ahead = newest.join(known, "id", "left").filter(
                F.col("old_version").isNull() | (F.col("version") > F.col("old_version"))
            )
            same = F.coalesce(F.col("new_hash") == F.col("old_hash"), F.lit(False)) & F.col("old_at").isNotNull()
            # Null texts are not sent to the model; an unchanged text keeps the place of its vector.
            to_embed = F.when(~F.col("deleted") & ~same, F.coalesce("text", F.lit("")))
            at = F.when(F.col("deleted"), F.lit(None)).when(same, F.col("old_at")).otherwise(F.lit(batch_id))
            rows = ahead.select(
                "id",
                embed(to_embed, self.embedder).alias("vector"),
                F.col("new_hash").alias("content_hash"),
                "version",
                "deleted",
                at.cast("bigint").alias("vector_at"),
                "shard",
            )
            rows.write.mode("overwrite").parquet(f"{self._log_path(self.generation())}/batch_id={batch_id}")
        finally:
            newest.unpersist()

    def current_state(self, shards: list[int], but_batch: int | None = None) -> DataFrame:
        """State of the keys in ``shards``, read without any vector."""
        return self.entries(shards, but_batch=but_batch, columns=STATE)

    def stream_number(self, checkpoint: str) -> int:
        """A number of the stream that keeps ``checkpoint``, the same on every restart, another for each checkpoint."""
        files, jvm = _file_system(self.spark, self.folder)
        name = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
        streams = f"{self.folder}/streams"
        for number in list_numbers(self.spark, streams, "n="):
            if files.exists(jvm.org.apache.hadoop.fs.Path(f"{streams}/n={number}/{name}")):
                return number
        number = max(list_numbers(self.spark, streams, "n="), default=0) + 1
        files.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{streams}/n={number}/{name}"))
        return number

    def start(self, changes: DataFrame, checkpoint: str, available_now: bool = True, interval: str = "10 seconds"):
        """Run :meth:`apply_batch` over a streaming DataFrame.

        Log folders are numbered by stream and micro-batch: a retried batch
        replaces its own folder, and a stream on another checkpoint (a replay
        from the start, say) never touches the folders of an earlier one.
        """
        stream = self.stream_number(checkpoint)

        def apply(changes: DataFrame, batch_id: int) -> None:
            self.apply_batch(changes, (stream << STREAM_BITS) | batch_id)

        writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        return writer.trigger(**trigger).start()

    def compact(self) -> int:
        """Fold the log into a new generation; run it while no micro-batch is being applied.

        Deleted keys stay as markers, so a late older version cannot revive them.
        """
        generation = self._next_generation()
        resolved = self.resolved().withColumn(
            "vector_at", F.when(F.col("vector").isNotNull(), F.lit(IN_SNAPSHOT)).cast("bigint")
        )
        self._write_snapshot(resolved, generation)
        return generation
