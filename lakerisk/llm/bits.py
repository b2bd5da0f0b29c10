"""Sets of keys as bits in pieces of 4 KB, small enough to broadcast, so that rows without a partner are dropped
before a join shuffles their texts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.sources.idindex import PIECE_SHIFT, _power

BITS_PER_KEY = 32
#: Bits of a sieve (32 MB); of more keys it lets more rows through, and the join after it decides.
MOST_BITS = 1 << 28


def piece(at: Column) -> Column:
    return F.shiftright(at, PIECE_SHIFT)


def gathered(at: Column) -> Column:
    """Aggregate of the bits of one piece; null sets none."""
    return F.bitmap_construct_agg(at.bitwiseAND((1 << PIECE_SHIFT) - 1).cast("int"))


def is_set(bits: str, at: Column) -> Column:
    """Whether the piece in column ``bits`` holds the bit of ``at``."""
    byte = F.substring(F.col(bits), F.shiftright(at.bitwiseAND((1 << PIECE_SHIFT) - 1), 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), at.bitwiseAND(7).cast("int")) == 1


def sieve(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``wanted`` (null like any other), and about one in 32 of the others.

    ``wanted`` is read twice: it should be stored. Its key has the type of that of ``rows``.
    """
    bits = min(MOST_BITS, max(1 << PIECE_SHIFT, _power(BITS_PER_KEY * wanted.count())))
    at = F.xxhash64(key).bitwiseAND(bits - 1)
    pieces = wanted.groupBy(piece(at).alias("_piece")).agg(gathered(at).alias("_bits"))
    return rows.join(F.broadcast(pieces), piece(at) == F.col("_piece")).filter(is_set("_bits", at)).select(*rows.columns)
