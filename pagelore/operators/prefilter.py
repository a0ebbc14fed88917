"""A filter of keys for the scan of a large table, so that rows without a partner never move.

It is a Bloom filter in blocks, kept as a table: a key's hash names its block, a second hash
four bits in it. The table is made by one aggregation. What is kept because of it may still
have no partner; what it leaves out has none, so a join behind it gives the same rows.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What bitmap_construct_agg holds.
BLOCK_BITS = 32_768
BITS_PER_KEY = 10
# Upper limit of the filter, which is broadcast. Beyond 50 million keys it lets more rows pass.
MOST_BYTES = 64 * 1024 * 1024
_PLACES = 4
_WORD_BITS = 32
# Words are stored as signed integers.
_MIDDLE = 2**31


@dataclass(frozen=True)
class KeyFilter:
    """``table`` has one row (filter_block, filter_words) for each block that has keys."""

    table: DataFrame
    blocks: int


def key_filter(keys: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> KeyFilter:
    """The filter for a column of keys, sized by their number: a pass over them counts first.

    Keys may repeat; null is no key. No keys at all give an empty filter.
    """
    known = keys.where(F.col(key).isNotNull())
    n = known.agg(F.approx_count_distinct(key)).first()[0]
    wanted = math.ceil(n * BITS_PER_KEY / BLOCK_BITS)
    blocks = max(1, min(wanted, most_bytes // (BLOCK_BITS // 8)))
    bits = known.select(
        _block(F.col(key), blocks).alias("filter_block"),
        F.explode(F.array(*_places(F.col(key)))).alias("place"),
    )
    maps = bits.groupBy("filter_block").agg(F.bitmap_construct_agg("place").alias("map"))
    word = lambda i: F.conv(F.hex(F.substring("map", i * 4 + 1, F.lit(4))), 16, 10)
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_BITS // _WORD_BITS - 1)),
        lambda i: (word(i).cast("long") - _MIDDLE).cast("int"),
    )
    return KeyFilter(maps.select("filter_block", words.alias("filter_words")), blocks)


def maybe_in(rows: DataFrame, key: str, known: KeyFilter) -> DataFrame:
    """The rows whose key is in the filter, and about one in a hundred of the others.

    Rows stay where they are: the filter is broadcast, at most 64 MB of it. Null is never in it.
    """
    block = _block(F.col(key), known.blocks) == F.col("filter_block")
    with_words = rows.join(F.broadcast(known.table), F.col(key).isNotNull() & block)
    there = [_has(F.col("filter_words"), place) for place in _places(F.col(key))]
    return with_words.where(there[0] & there[1] & there[2] & there[3]).select(*rows.columns)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _places(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit(1))
    return [
        F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1))
        for i in range(_PLACES)
    ]


def _has(words: Column, place: Column) -> Column:
    """A bitmap's bytes count from its front, the bits of a byte from its lowest."""
    word = words[(place / _WORD_BITS).cast("int")].cast("long") + _MIDDLE
    within = place % _WORD_BITS
    bit = F.lit(24) - F.floor(within / 8) * 8 + within % 8
    return F.getbit(word, bit.cast("int")) == 1
