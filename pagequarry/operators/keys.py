"""Dense row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.session import materialise, new_folder


def dense_ids(df: DataFrame, *order: str, name: str = "id", partitions: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 in the order of the unique columns ``order``.

    Rows are range-partitioned, sorted and written once; each partition's
    start is the sum of the sizes before it, a list of as many rows. Without
    ``partitions`` the session's shuffle settings decide their number.
    """
    placed = (
        df.repartitionByRange(*(() if partitions is None else (partitions,)), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    written = (
        materialise(placed, "dense-ids")
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        written.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    numbered = written.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_row") + 1).drop("_at", "_part", "_row", "_start")


def numbered_within(df: DataFrame, group: str, *order, name: str = "pos") -> DataFrame:
    """``df`` with ``name``: 0, 1, ... within each value of ``group`` in ``order``.

    Rows are range-partitioned on (group, order), so a group with a third of
    all rows is cut into many tasks; sorted, written once and counted per
    (partition, group). A group's start in a partition is the sum of its rows
    in the partitions before, from a table of at most partitions + groups rows.
    """
    keys = [F.col(group), *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    written = (
        materialise(placed, "numbered")
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    pieces = written.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("_part", group, "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    small = starts.count() <= 1_000_000
    return written.join(F.broadcast(starts) if small else starts, ["_part", group]).select(
        *df.columns, (F.col("_start") + F.col("_row") - F.col("_first")).alias(name)
    )


def _places(group: str, name: str) -> Callable:
    """Task function: rows sorted by ``group`` with their place within its run."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, met = None, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            column = batch.column(group)
            new = np.ones(size, dtype=bool)
            new[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            start = np.maximum.accumulate(np.where(new, np.arange(size), 0))
            place = np.arange(size) - start
            if column[0].as_py() == last:
                # The run of the batch before goes on.
                place[start == 0] += met
            last, met = column[size - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, name])

    return places


def numbered_runs(
    df: DataFrame, group: str, order: Sequence[Column], name: str = "pos", first: Sequence[Column] = ()
) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... within each value of ``group`` (none null) in ``order``.

    As :func:`numbered_within`, for many groups: rows are range-partitioned on
    (first, group, order), ``first`` being functions of the group; numbered
    within their partition as they are sorted, and written once. Only a group
    that is cut, whose later parts begin a partition, needs a start: a table
    of at most as many rows as partitions. The rows are not shuffled again; a
    file holds a range of groups.
    """
    keys = [*first, F.col(group), *order]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    runs = ordered.mapInArrow(_places(group, name), T.StructType([*df.schema, T.StructField(name, T.LongType())]))
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = runs.select("*", F.spark_partition_id().alias("_part"), (at == 0).alias("_first"))
    folder = new_folder(df.sparkSession, "numbered")
    placed.write.option("compression", "zstd").parquet(folder)
    written = df.sparkSession.read.schema(placed.schema).parquet(folder)
    # The first rows of the partitions; groups that do not begin one are whole.
    heads = materialise(written.where("_first").select(group).distinct(), "cut-groups")
    sizes = written.join(F.broadcast(heads), group).groupBy("_part", group).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", group, F.sum("_size").over(before).alias("_start")).where(F.col("_start") > 0)
    starts = F.broadcast(materialise(starts, "starts"))
    return written.join(starts, ["_part", group], "left").select(
        *df.columns, (F.col(name) + F.coalesce("_start", F.lit(0))).alias(name)
    )


class NumberedTable:
    """An append-only table whose rows are numbered 1, 2, ... across all appends, with no cap.

    Append ``v`` is written under ``append=<v>``; when it is complete, a marker
    ``_marks/append=<v>/last=<n>`` keeps the highest id given so far, the
    high-water mark. The next append starts above it. An append that broke off
    before its marker is taken up again under the same number and from the
    same mark, so a rerun gives its rows the same ids (for input in the same
    ``order``, which must make rows unique). Ids are dense numbers from
    :func:`dense_ids`: a long holds 2^63 of them, whatever the page ids or
    chunk counts are. One writer at a time is assumed.
    """

    def __init__(self, spark, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _marks(self) -> dict[int, int]:
        from pagequarry.sources.tables import _file_system, list_numbers

        files, jvm = _file_system(self.spark, self.folder)
        marks = {}
        for version in list_numbers(self.spark, f"{self.folder}/_marks", "append="):
            found = list_numbers(self.spark, f"{self.folder}/_marks/append={version}", "last=")
            if found:
                marks[version] = found[-1]
        return marks

    def version(self) -> int:
        """The last complete append, 0 before the first."""
        return max(self._marks(), default=0)

    def last_id(self) -> int:
        marks = self._marks()
        return marks[max(marks)] if marks else 0

    def append(self, df: DataFrame, *order: str, name: str = "id") -> int:
        """Write ``df`` numbered after every earlier row; returns the append's number."""
        from pagequarry.sources.tables import _file_system

        version, start = self.version() + 1, self.last_id()
        numbered = dense_ids(df, *order, name=name).withColumn(name, F.col(name) + F.lit(start))
        numbered.write.mode("overwrite").parquet(f"{self.folder}/append={version}")
        written = self.spark.read.parquet(f"{self.folder}/append={version}")
        last = written.agg(F.max(name)).first()[0] or start
        files, jvm = _file_system(self.spark, self.folder)
        files.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_marks/append={version}/last={last}"))
        return version

    def read(self) -> DataFrame:
        """Rows of complete appends, with the column ``append``."""
        complete = sorted(self._marks())
        table = self.spark.read.parquet(self.folder)
        return table.where(F.col("append").isin(complete))
