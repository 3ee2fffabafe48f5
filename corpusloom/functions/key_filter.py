"""A Bloom filter of wanted keys, sized to their number: leaves out most rows a join can't want before they are shuffled.

Bits lie in blocks of 32,768 (:func:`bitmap_construct_agg`'s); a key has one block and a few bits in it, so a row meets one
block by a broadcast join. At ten bits a key about two in a hundred other rows pass, whatever the number of keys. The filter
is broadcast up to ``FILTER_BYTES`` (27 million keys); beyond, all rows may be wanted, nothing is left out, and the join that
follows shuffles them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS, BITS_A_KEY, HASHES = 32_768, 10, 5
FILTER_BYTES = 32 << 20


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def with_chance(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """Adds ``__maybe``: true for every row whose key is among the wanted ones, and for few others. ``wanted`` is read twice; null is a key like any other."""
    blocks = max(1, -(-wanted.count() * BITS_A_KEY // BLOCK_BITS))
    if blocks * BLOCK_BITS // 8 > most_bytes:
        return rows.withColumn("__maybe", F.lit(True))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    marks = wanted.select(block(wanted_key).alias("__block"), F.explode(F.array(*_bits(wanted_key))).alias("__bit"))
    marks = marks.groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__marks"))
    byte = lambda bit: F.conv(F.hex(F.substring("__marks", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = [F.getbit(byte(bit), (bit % 8).cast("int")) == 1 for bit in _bits(key)]
    met = rows.withColumn("__block", block(key)).join(F.broadcast(marks), "__block", "left")
    return met.withColumn("__maybe", F.coalesce(reduce(lambda a, b: a & b, held), F.lit(False))).drop("__block", "__marks")


def narrowed(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """All rows whose key is among the wanted ones, and few others."""
    return with_chance(rows, key, wanted, wanted_key, most_bytes).where("__maybe").drop("__maybe")
