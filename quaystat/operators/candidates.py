"""Runtime filter of stored rows by the keys of a batch (J-10).

The keys of a batch are hashed to one bit each of a bitmap of ``BITS`` bits. A stored row
whose bit isn't set has no equal in the batch, so it needs neither ranking nor
shuffling; a row that passes by chance finds no partner in the join that follows. The bitmap is
built by partial aggregates and comes to at most ``BITS / 8`` bytes whatever the batch, so it
can always be broadcast; a batch that fills it lets every row pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 16 MB at most.
BITS = 1 << 27


def _place(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITS)) + 1


def key_bits(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bitmap of the keys of ``rows``, in buckets: _bucket, _bits; at most ``BITS`` / 32768 rows of 4 kB."""
    place = _place(columns)
    keys = rows.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_position"))
    return keys.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))


def may_match(stored: DataFrame, bits: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``stored`` whose key may be among those of ``bits``; none that is gets lost."""
    place = _place(columns)
    position = F.bitmap_bit_position(place)
    byte = F.substr("_bits", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1
    return stored.join(F.broadcast(bits), (F.bitmap_bucket_number(place) == F.col("_bucket")) & hit, "left_semi")
