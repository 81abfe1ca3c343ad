"""A filter of bounded size that spares rows a shuffle when few keys are wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One bit for each of so many hash values: 4 KB blocks, 2 MB in all, however many keys there are.
BITS = 1 << 24
BLOCK_BITS = 1 << 15


def possible_keys(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``rows`` whose ``key`` may be in ``wanted`` (key), and no row that cannot be.

    The wanted keys' hashes become a bitmap of BITS bits, which is broadcast
    whatever their number; a later join on the key settles the rest. With far
    more than BITS keys all rows pass.
    """
    place = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(BITS))
    bits = (
        wanted.select(place.alias("_place"))
        .groupBy((F.col("_place") / BLOCK_BITS).cast("int").alias("_block"))
        .agg(F.expr(f"bitmap_construct_agg(_place % {BLOCK_BITS})").alias("_bits"))
    )
    # The byte of a bit, as a number, is read from the block's bytes.
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(_place % {BLOCK_BITS} as int) div 8 + 1, 1)")), 16, 10).cast("int")
    held = (byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 as int))"))) > 0
    return (
        rows.withColumn("_place", place)
        .withColumn("_block", (F.col("_place") / BLOCK_BITS).cast("int"))
        .join(F.broadcast(bits), "_block")
        .filter(held)
        .select(*rows.columns)
    )
