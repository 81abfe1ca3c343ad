"""From the memo export's columns to a clean table of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.text import clean_symbols

# Column titles of the export and the names used from then on.
HEADERS = {
    "Date of Memo": "Date_of_Memo",
    "TO (one per line)": "TO",
    "FROM (one per line)": "FROM",
    "Memo Subject": "Memo_Subject",
    "FOIP Exception(s) (one per line)": "FOIP_Exceptions",
    "Link to Memo (file upload)": "Link_to_Memo",
    "Memo Text Part 1": "Memo_Text_1",
    "Memo Text Part 2": "Memo_Text_2",
    "Is this Memo Related to a Meeting?": "Meeting_Related",
    "Meeting Date": "Meeting_Date",
    "Meeting Item Number(s) (one per line)": "Meeting_Item_Numbers",
    "Committee or Council Name(s) (one per line)": "Committee_or_Council_Names",
}
# One-letter day and hour accept one and two digits.
TIMESTAMP_FORMAT = "MMM d, yyyy h:mm a"
DATE_FORMAT = "MMM d, yyyy"


def raw_memos(export: DataFrame, collapse_whitespace: bool = False) -> DataFrame:
    """Renamed columns, both text parts cleaned of symbols."""
    return export.withColumnsRenamed(HEADERS).withColumns(
        {part: clean_symbols(F.col(part), collapse_whitespace) for part in ("Memo_Text_1", "Memo_Text_2")}
    )


def parse_timestamp(text: Column, pattern: str) -> Column:
    """Null instead of a failed job for text that does not match."""
    return F.try_to_timestamp(text, F.lit(pattern))


def silver_memos(raw: DataFrame, join_parts: bool = False) -> DataFrame:
    """Six columns with real timestamps; the second text part is dropped unless ``join_parts``."""
    text = F.concat_ws(" ", "Memo_Text_1", "Memo_Text_2") if join_parts else F.col("Memo_Text_1")
    return raw.select(
        parse_timestamp(F.col("Timestamp"), TIMESTAMP_FORMAT).alias("Timestamp"),
        parse_timestamp(F.col("Date_of_Memo"), DATE_FORMAT).alias("Date_of_Memo"),
        "Link_to_Memo",
        text.alias("Text"),
        "TO",
        "FROM",
    )


def document_records(df: DataFrame, text: str = "Text", source: str = "Link_to_Memo") -> DataFrame:
    """Rows as ``document`` structs of page content and metadata; rows without text are dropped."""
    return df.dropna(subset=[text]).select(
        F.struct(
            F.col(text).alias("page_content"), F.create_map(F.lit("source"), F.col(source)).alias("metadata")
        ).alias("document")
    )
