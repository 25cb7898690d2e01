"""Texts in Arrow batches: bounded pieces, words as integers, and sums over partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; a longer text is a piece by itself.
PIECE_BYTES = 3 << 20
#: Partial sums that one task adds up on the first of the two levels.
SUM_SLOTS = 64


def strings(column: pa.Array) -> pa.Array:
    """As large strings in one chunk, null as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of large strings, both starting at zero."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def pieces(
    batches: Iterable[pa.RecordBatch], text: str, most: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with about ``most`` bytes of text, and their texts as large strings."""
    for batch in batches:
        column = strings(batch.column(text))
        at, _ = buffers(column) if len(column) else (np.zeros(1, np.int64), None)
        begin = 0
        while begin < len(column):
            end = int(np.searchsorted(at, at[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), len(column))
            yield batch.slice(begin, end - begin), column.slice(begin, end - begin)
            begin = end
        # A worker lives on after its task; what it no longer uses goes back to the machine.
        pa.default_memory_pool().release_unused()


def word_table(keep: Iterable[int]) -> np.ndarray:
    """Byte map: A-Z to a-z, bytes in ``keep`` as they are, all others to a space."""
    out = np.full(256, 0x20, np.uint8)
    kept = np.fromiter(keep, np.uint8)
    out[kept] = kept
    for upper in range(0x41, 0x5B):
        if out[upper + 32] != 0x20:
            out[upper] = upper + 32
    return out


def words(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers of all texts in a row, the texts' offsets therein, and the vocabulary.

    Texts are mapped byte by byte and split at white space, all in Arrow.
    """
    at, raw = buffers(column)
    mapped = pa.LargeStringArray.from_buffers(
        len(column), pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(table[raw])
    )
    lists = pc.ascii_split_whitespace(mapped)
    flat = lists.values
    # The split leaves empty strings at the ends of a text.
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.asarray(lists.offsets, dtype=np.int64)
    running = np.concatenate([[0], np.cumsum(filled)])
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return (
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        running[ends],
        coded.dictionary,
    )


def partial_sums(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    """What one task has added up, as a batch for ``summed``."""
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(list(sums), pa.string()),
            "part": pa.array([part] * len(sums), pa.int64()),
            "vec": pa.array([v.astype("<f8").tobytes() for v in sums.values()], pa.binary()),
        }
    )


SUMS = "key string, part long, vec binary"


def added(rows: pa.Table) -> pa.Table:
    """The sum of the rows of one key, as such a row."""
    total = None
    for v in rows.column("vec").to_pylist():
        v = np.frombuffer(v, "<f8")
        total = v.copy() if total is None else total + v
    return pa.table(
        {
            "key": pa.array([rows.column("key")[0].as_py()], pa.string()),
            "part": pa.array([0], pa.int64()),
            "vec": pa.array([total.tobytes()], pa.binary()),
        }
    )


def sums_by_key(
    partials: DataFrame, finish: Callable[[pa.Table], pa.Table] = added, schema: str = SUMS
) -> DataFrame:
    """What ``finish`` makes of each key's rows. Tasks' sums are added on executors on two levels
    before, so that what one task gets does not grow with the partitions times the keys."""
    first = partials.groupBy("key", F.pmod("part", F.lit(SUM_SLOTS))).applyInArrow(added, SUMS)
    return first.groupBy("key").applyInArrow(finish, schema)


def summed(partials: DataFrame) -> dict[str, np.ndarray]:
    """The sum for each key, on the driver; for a fixed number of keys."""
    whole = sums_by_key(partials).select("key", "vec")
    return {r.key: np.frombuffer(r.vec, "<f8") for r in whole.collect()}
