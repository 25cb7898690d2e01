"""Bitmaps of keys: a filter in front of a join that keeps most of the other rows where they are.

A bitmap tells surely which rows have none of the keys; a few others pass. It changes no result,
as a join follows, but rows that do not pass need not be shuffled. Its size follows the number of
keys up to a fixed bound; beyond it more rows pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the most bits of a bitmap (32 MB).
PER_KEY = 16
MOST = 1 << 28
#: Bits of the pieces that Spark builds.
PIECE = 1 << 15


def slot_of(names: list[str], bits: int):
    return F.pmod(F.xxhash64(*names), F.lit(bits))


def bitmap(keys: DataFrame, names: list[str]) -> np.ndarray:
    """The bytes of the bitmap of the keys' hashes, least significant bit first."""
    many = max(keys.count(), 1)
    bits = min(max(1 << (PER_KEY * many - 1).bit_length(), PIECE), MOST)
    piece = F.floor(F.col("slot") / PIECE).alias("piece")
    rows = keys.select(slot_of(names, bits).alias("slot")).groupBy(piece)
    out = np.zeros((bits // PIECE, PIECE // 8), np.uint8)
    for r in rows.agg(F.bitmap_construct_agg(F.col("slot") % PIECE).alias("own")).toLocalIterator():
        out[r.piece] = np.frombuffer(r.own, np.uint8)
    return out.ravel()


def passing(rows: DataFrame, bits: np.ndarray, names: list[str], wanted: bool = True) -> DataFrame:
    """The rows whose bit is set, or those whose bit is not."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("__slot").to_numpy(zero_copy_only=False)
            found = ((shared.value[at >> 3] >> (at & 7)) & 1).astype(bool)
            yield batch.filter(pa.array(found == wanted))

    rows = rows.withColumn("__slot", slot_of(names, 8 * len(bits)))
    return rows.mapInArrow(pick, rows.schema).drop("__slot")
