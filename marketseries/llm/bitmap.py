"""A broadcast bitmap of hashed ids that keeps most rows without a partner out of a join's shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_maybe(rows: DataFrame, key: str, ids: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """Adds ``maybe``: false only for rows whose ``key`` isn't in the column ``key`` of ``ids``.

    The bitmap has 16 bits for each id, up to 16 MB in all, which bounds what is broadcast; with more ids than that it
    lets more rows through, so an exact join must follow.
    """
    bits = min(most_bits, 1 << max(15, (16 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place).cast("int")
    marks = ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(2, bit % 8).cast("int")) != 0
    out = rows.join(F.broadcast(marks), bucket == F.col("_bucket"), "left")
    return out.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("_bucket", "_marks")
