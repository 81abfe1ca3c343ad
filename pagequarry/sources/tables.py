"""Writers over plain Parquet folders: versions, appends, guards and previews.

A versioned table is a folder of complete versions ``v=1, v=2, ...``. Writing
never touches a version that is being read, and readers take the newest
version whose write has finished.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DONE = "_SUCCESS"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    files, jvm = _file_system(spark, path)
    return files.exists(jvm.org.apache.hadoop.fs.Path(path))


def list_numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Sorted numbers ``n`` of the subfolders ``<prefix>n`` of ``folder``."""
    files, jvm = _file_system(spark, folder)
    root = jvm.org.apache.hadoop.fs.Path(folder)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root)]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


class VersionedTable:
    """Overwrite that may read its own table, since each write is a new version."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def version(self) -> int:
        """Newest finished version, 0 when there is none."""
        for number in reversed(list_numbers(self.spark, self.folder, "v=")):
            if path_exists(self.spark, f"{self.folder}/v={number}/{DONE}"):
                return number
        return 0

    def exists(self) -> bool:
        return self.version() > 0

    def path(self, version: int | None = None) -> str:
        return f"{self.folder}/v={version or self.version()}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(version))

    def overwrite(self, df: DataFrame, *partition_by: str) -> int:
        started = list_numbers(self.spark, self.folder, "v=")
        number = (started[-1] if started else 0) + 1
        df.write.partitionBy(*partition_by).parquet(self.path(number))
        return number

    def delete(self, condition: Column) -> int:
        """New version without the rows where ``condition`` holds; unknown conditions keep the row."""
        return self.overwrite(self.read().filter(~F.coalesce(condition, F.lit(False))))

    def publish(self, name: str) -> None:
        """Point the catalog table ``name`` at the newest version; no data moves.

        A table of that name is only repointed when it already is an external
        one on a version of this folder; any other is refused.
        """
        if not self.spark.catalog.tableExists(name):
            self.spark.catalog.createTable(name, path=self.path(), source="parquet")
            return
        about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        _, jvm = _file_system(self.spark, self.folder)
        own = jvm.org.apache.hadoop.fs.Path(self.folder).toUri().getPath()
        there = jvm.org.apache.hadoop.fs.Path(about.get("Location") or "/").toUri().getPath()
        if about.get("Type") != "EXTERNAL" or not there.startswith(f"{own}/v="):
            raise ValueError(f"{name} is no table on {self.folder}")
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{self.path()}'")
        self.spark.catalog.refreshTable(name)

    def write_if_needed(self, df: DataFrame, min_rows: int, force: bool = False) -> bool:
        """Write unless a version with at least ``min_rows`` rows is there; tells whether it wrote."""
        if not force and self.exists() and has_at_least(self.read(), min_rows):
            return False
        self.overwrite(df)
        return True


# A limit gathers its rows in one task, so above this number a distributed
# count is used, which Parquet answers from its footers.
MAX_LIMITED_ROWS = 1_000_000


def has_at_least(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has ``rows`` rows, reading no more than that while they are few."""
    return (df.limit(rows).count() if rows <= MAX_LIMITED_ROWS else df.count()) >= rows


def row_check(df: DataFrame, name: str, rows: int = 1) -> DataFrame:
    """:func:`has_at_least` as one row ``name, enough``."""
    return df.limit(rows).agg((F.count("*") >= rows).alias("enough")).select(F.lit(name).alias("name"), "enough")


def append(df: DataFrame, folder: str) -> None:
    """Add rows whose columns may differ from those already there."""
    df.write.mode("append").parquet(folder)


def read_evolved(spark: SparkSession, folder: str) -> DataFrame:
    """All appended rows under the union of their columns, missing ones null."""
    return spark.read.option("mergeSchema", "true").parquet(folder)


def append_run(df: DataFrame, folder: str, run: int) -> None:
    """Rows of one run under ``run=<n>``; repeating the run replaces its rows."""
    df.write.mode("overwrite").parquet(f"{folder}/run={run}")


def preview(df: DataFrame, *order: str, rows: int = 2) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def page_of_rows(df: DataFrame, *order: str, offset: int, rows: int = 10) -> DataFrame:
    """One page of a preview; for work in batches use the pending rows instead."""
    return df.orderBy(*order).offset(offset).limit(rows)


def latest_for(df: DataFrame, name: str, name_column: str = "name", date: str = "date") -> DataFrame:
    """Most recent row of one name."""
    return df.filter(F.col(name_column) == name).orderBy(F.desc(date)).limit(1)


def latest_per_name(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Most recent row of every name, by the columns ``order``.

    An aggregate keeps one row per name before the shuffle, however many rows
    a name has.
    """
    rest = [column for column in df.columns if column != name]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(name).agg(newest).select(name, "_row.*")
