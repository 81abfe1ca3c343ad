"""Building, storing, comparing and updating vector indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions.vectors import checked_vector
from pagequarry.operators.models import Embedder, embed
from pagequarry.sources.tables import VersionedTable


def content_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def refuse_duplicates(df: DataFrame, key: str) -> DataFrame:
    """``df``, after failing when a key occurs twice."""
    if not df.groupBy(key).count().filter(F.col("count") > 1).isEmpty():
        raise ValueError(f"duplicate values of {key}")
    return df


def index_rows(
    source: DataFrame, key: str, text: str, embedder: Embedder, model_id: str, metadata: tuple[str, ...] = ()
) -> DataFrame:
    """``id, vector, content_hash, model_id`` and the metadata columns of each source row."""
    return source.select(
        F.col(key).alias("id"),
        embed(F.coalesce(text, F.lit("")), embedder).alias("vector"),
        *metadata,
        content_hash(F.col(text)).alias("content_hash"),
        F.lit(model_id).alias("model_id"),
    )


class IndexStore:
    """Index snapshots in a versioned folder, each made by one embedding model."""

    def __init__(self, spark: SparkSession, folder: str):
        self.table = VersionedTable(spark, folder)

    def build(
        self,
        source: DataFrame,
        key: str,
        text: str,
        embedder: Embedder,
        model_id: str,
        metadata: tuple[str, ...] = (),
        reset: bool = False,
    ) -> bool:
        """Embed and store the whole source unless a snapshot exists; tells whether it did."""
        if self.table.exists() and not reset:
            return False
        refuse_duplicates(source, key)
        self.table.overwrite(index_rows(source, key, text, embedder, model_id, metadata))
        return True

    def load(self, model_id: str) -> DataFrame:
        """The stored index; questions have to be embedded by the same model."""
        index = self.table.read()
        other = index.filter(~F.col("model_id").eqNullSafe(F.lit(model_id))).select("model_id").first()
        if other is not None:
            raise ValueError(f"index was built by {other.model_id}, not {model_id}")
        return index


def capture_changes(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """``key, change, old_hash, new_hash`` of every row inserted, updated or deleted.

    Only keys and hashes are shuffled. The text of rows to embed again comes
    from joining the result to ``new``.
    """
    before = old.select(F.col(key), content_hash(F.col(text)).alias("old_hash"))
    after = new.select(F.col(key), content_hash(F.col(text)).alias("new_hash"))
    change = (
        F.when(F.col("old_hash").isNull(), "insert")
        .when(F.col("new_hash").isNull(), "delete")
        .when(F.col("old_hash") != F.col("new_hash"), "update")
    )
    return (
        before.join(after, key, "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(key, "change", "old_hash", "new_hash")
    )


def newest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row with the greatest ``order`` of every key, reduced before the shuffle."""
    rest = [name for name in df.columns if name != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(key, "_row.*")


def upsert_vectors(
    index: DataFrame, rows: DataFrame, key: str, vector: str, dimension: int, order: str | None = None
) -> DataFrame:
    """``index`` with ``rows`` put in or replaced by key.

    Vectors of another length than ``dimension`` fail the job and columns have
    to agree. Among ``rows`` the greatest ``order`` of a key wins, of equal ones the greatest vector. The index
    itself is not regrouped: its replaced keys are taken out by an anti join.
    """
    declared = {field.name: field.dataType for field in index.schema}
    given = {field.name: field.dataType for field in rows.schema if field.name != order}
    if declared != given:
        raise ValueError(f"rows have columns {given}, the index has {declared}")
    checked = rows.withColumn(vector, checked_vector(F.col(vector), dimension))
    if order is None:
        newest = refuse_duplicates(checked, key)
    else:
        newest = newest_per_key(checked, key, order, vector).drop(order)
    kept = index.join(rows.select(key).distinct(), key, "left_anti")
    return kept.unionByName(newest)


def delete_keys(index: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return index.join(keys.select(key).distinct(), key, "left_anti")
