"""Which pieces of a keyed table may hold a key, without opening them.

Of every piece the smallest and the largest key are kept, whether it has rows without
a key, and a Bloom filter: blocks of 4 KB, as many as its keys need, each key with
four bits in one block. A piece that fails the test does not hold the key; one in some
four hundred that pass does not either.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK_BITS = 1 << 15
_KEYS_PER_BLOCK = 1 << 11
_HASHES = 4
# Blocks one task fills: its keys are about 2,048 times as many.
_BLOCKS_PER_TASK = 1 << 9
# Keys looked up first. Where many keys are probed, these find nearly every piece.
_FIRST = 10_000


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(_BLOCK_BITS)) for i in range(1, _HASHES + 1)]


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def build(rows: DataFrame, key: str, piece: str) -> DataFrame:
    """(piece, low, high, keyless, blocks, block, bits) of the pieces of ``rows``.

    ``piece`` is the column that names a row's piece. A piece without any key has one
    row without block. Keys travel to their blocks: a filter made before the shuffle
    would be 4 KB for nearly every block from every task, a product of both. One row
    per piece reaches the driver.
    """
    sizes = rows.groupBy(F.col(piece).alias("piece")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.max(F.col(key).isNull()).alias("keyless"),
        F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.count(key) / _KEYS_PER_BLOCK, F.lit(1.0))))).cast("bigint").alias("blocks"))
    sizes = rows.sparkSession.createDataFrame(found := sizes.collect(), sizes.schema)
    parts = max(1, sum(r["blocks"] for r in found) // _BLOCKS_PER_TASK)
    keys = rows.where(F.col(key).isNotNull()).select(F.col(piece).alias("piece"), F.col(key).alias("_key"))
    blocked = keys.join(F.broadcast(sizes.select("piece", "blocks")), "piece").select(
        "piece", _block("_key", F.col("blocks")).alias("block"), F.array(*[b.cast("short") for b in _bits("_key")]).alias("_bits"))
    bits = blocked.repartition(parts, "piece", "block").select("piece", "block", F.explode("_bits").alias("bit"))
    filters = bits.groupBy("piece", "block").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("bits"))
    index = F.broadcast(sizes).join(filters, "piece")
    if all(r["low"] is not None for r in found):
        return index
    return index.unionByName(sizes.where(F.col("low").isNull()).withColumns(
        {"block": F.lit(None).cast("bigint"), "bits": F.lit(None).cast("binary")}))


def may_hold(index: DataFrame, keys: DataFrame, key: str) -> Collection[str]:
    """The pieces of ``index`` that may hold one of ``keys``, a column of distinct keys, NULL included.

    Pieces are first compared by their range of keys with that of all ``keys``; then
    keys meet only the blocks they fall into. One row per piece reaches the driver.
    """
    spread = keys.agg(F.min(key).alias("least"), F.max(key).alias("most"), F.max(F.col(key).isNull()).alias("without")).first()
    keyless = set()
    if spread["without"]:
        keyless = {r["piece"] for r in index.where("keyless").select("piece").distinct().collect()}
    if spread["least"] is None:
        return keyless
    near = index.where((F.col("low") <= F.lit(spread["most"])) & (F.col("high") >= F.lit(spread["least"])))
    # A piece needs one hit to be opened, so a few keys settle most pieces of a large
    # batch; all keys are looked up only in what is left.
    found = _hit(near, keys.limit(_FIRST), key)
    return keyless | found | _hit(near.where(~F.col("piece").isin(list(found))), keys, key)


def _hit(index: DataFrame, keys: DataFrame, key: str) -> set[str]:
    """The pieces of ``index`` in whose range and filter one of ``keys`` lies."""
    # Numbers of blocks are powers of two, so there are few.
    sizes = [r[0] for r in index.select("blocks").distinct().collect()]
    if not sizes:
        return set()
    probes = keys.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.explode(F.array(*[F.lit(s) for s in sizes])).alias("blocks")).withColumn(
        "block", _block("_key", F.col("blocks")))
    met = probes.join(index, ["blocks", "block"]).where(F.col("_key").between(F.col("low"), F.col("high")))
    for bit in _bits("_key"):
        byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        met = met.where(F.call_function("getbit", byte, (bit % 8).cast("int")) == 1)
    return {r["piece"] for r in met.select("piece").distinct().collect()}
