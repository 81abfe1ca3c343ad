"""Memo export to a stored vector index."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pagequarry.operators.index import IndexStore
from pagequarry.operators.memos import raw_memos, silver_memos
from pagequarry.operators.models import Embedder
from pagequarry.sources.readers import read_memo_export
from pagequarry.sources.tables import VersionedTable


def memos_to_index(
    spark: SparkSession, export: str, folder: str, embedder: Embedder, model_id: str, reset: bool = False
) -> IndexStore:
    """Clean an export, store the silver table and embed its texts, keyed by the memo's link."""
    silver = VersionedTable(spark, f"{folder}/silver")
    silver.overwrite(silver_memos(raw_memos(read_memo_export(spark, export))))
    store = IndexStore(spark, f"{folder}/index")
    texts = silver.read().dropna(subset=["Text"])
    store.build(texts, "Link_to_Memo", "Text", embedder, model_id, ("Text",), reset=reset)
    return store
