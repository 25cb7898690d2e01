"""Prefix trie of conversations: sorted matrices of turn ids, shard by shard.

A turn is known by 128 bits of hash of its role and text. Conversations are dealt out by ranges of
their id sequences and sorted inside each task; conversations that follow one another fill padded
matrices of bounded size. In a matrix every row is compared with the one above, the change masks
are accumulated with "or" along the columns, and a set bit marks the first row of a trie node;
``reduceat`` sums up each depth, from the deepest to the root. Nodes that hold neither the first nor
the last row are complete and are given out. The nodes of those two rows may go on in another
matrix: they stay open, as two paths with what each depth has so far, and the paths of all matrices
are the rows of the next round, of which there are thousands of times fewer. The last round has few
enough rows for one matrix, where every node is complete.

The ids of the conversations that end in an open node are written as text in pieces; the pieces of
a node are hashed in order, one after the other, so that no task holds them all.

Defined results: rows without a conversation id belong to none and are left out; a null turn comes
first; turns of the same number, repeated rows among them, are all kept, in the order of their
ids; null roles and texts count as empty; an empty table gives no nodes; other columns are
not looked at. A task holds one conversation whole, but as 24 bytes a turn and without its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.common import salt_of, salted
from tristrata.scratch import staged

#: Cells of one matrix, and its fewest rows however long they are.
CELLS = 1 << 20
LEAST_ROWS = 64
#: Cells up to which open paths are put together at once.
LAST_CELLS = 1 << 22
SALTS = 16
PAD = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max

PATH = (
    "ids array<long>, conv long, words array<long>, n array<long>, kids array<long>, "
    "leaves array<long>, saved array<long>, low array<long>"
)
#: What a round gives: nodes (0), open paths (1) and pieces of ends (2).
FOUND = (
    "kind int, conv_id long, depth long, parent long, parent_key binary, key binary, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, sha string, piece string, "
    + PATH
)
FIELDS = [part.split() for part in FOUND.split(", ")]
ARROW = {
    "int": pa.int32(),
    "long": pa.int64(),
    "binary": pa.binary(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
}
SUMS = ("n", "kids", "leaves", "saved")
WORD = r"[^\x20\x09-\x0D]+"


def sequences(conversations: DataFrame, shared: int = 20, parts: int = 4) -> DataFrame:
    """``ids, conv, words`` of every rebuilt conversation.

    Conversation c begins with the first h turns of conversation ``c - c % shared``, and goes on
    with its own turns after its first h; h is the crc32 of its decimal id modulo ``parts``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn"),
        F.greatest(F.xxhash64(role, text), F.lit(PAD + 1)).alias("hi"),
        F.greatest(F.xxhash64(F.lit(1), text, role), F.lit(PAD + 1)).alias("lo"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    own = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv"), turn.alias("turn"))
        .groupBy("conv")
        .agg(F.array_sort(F.collect_list("turn")).alias("own"))
        .withColumn("base", F.expr(f"conv - conv % {shared}"))
    )
    head = F.slice("own", 1, max(parts - 1, 1)).alias("head")
    heads = own.where("conv = base").select("base", head)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % parts).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    seq = F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("own", h + 1, F.size("own"))
    )
    rebuilt = own.join(heads, "base", "left").select("conv", seq.alias("seq"))
    return rebuilt.select(
        F.flatten(F.transform("seq", lambda t: F.array(t["hi"], t["lo"]))).alias("ids"),
        "conv",
        F.transform("seq", lambda t: t["words"]).alias("words"),
    )


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and their values in a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.diff(np.asarray(column.offsets)), column.flatten().to_numpy(zero_copy_only=False)


def padded(lengths: np.ndarray, flat: np.ndarray, width: int, fill: int) -> np.ndarray:
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


@dataclass
class Matrix:
    """Rows of one matrix: paths with what is known at each depth."""

    length: np.ndarray
    ids: np.ndarray
    words: np.ndarray
    conv: np.ndarray
    #: ``n, kids, leaves, saved`` and ``low`` by depth, from 0.
    known: dict[str, np.ndarray]

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Matrix:
        twice, ids = ragged(batch.column("ids"))
        length = twice // 2
        width = int(length.max(initial=0))
        conv = batch.column("conv").to_numpy(zero_copy_only=False)
        known = {}
        if "n" in batch.schema.names:
            for name in (*SUMS, "low"):
                fill = NO_ID if name == "low" else 0
                known[name] = padded(length + 1, ragged(batch.column(name))[1], width + 1, fill)
        else:
            here = (np.arange(width + 1) <= length[:, None]).astype(np.int64)
            known = {name: np.zeros_like(here) for name in SUMS} | {"n": here}
            known["low"] = np.where(here > 0, conv[:, None], NO_ID)
        ids = padded(twice, ids, 2 * width, PAD)
        words = padded(length, ragged(batch.column("words"))[1], width, 0)
        order = np.lexsort((conv, *ids.T[::-1]))
        return cls(
            length[order],
            ids[order],
            words[order],
            conv[order],
            {name: values[order] for name, values in known.items()},
        )


def key_of(ids: np.ndarray, depth: int) -> bytes:
    """128 bits that name the node of the first ``depth`` turns."""
    return xxhash.xxh3_128_digest(depth.to_bytes(8, "little") + ids[: 2 * depth].tobytes())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


EMPTY = sha("")


def found(kind: int, count: int, columns: dict[str, object]) -> pa.RecordBatch:
    """Rows of ``FOUND``; columns that are not given are null."""
    arrays = []
    for name, spark_type in FIELDS:
        if name == "kind":
            arrays.append(pa.array(np.full(count, kind, np.int32)))
        elif name in columns:
            arrays.append(pa.array(columns[name], ARROW[spark_type]))
        else:
            arrays.append(pa.nulls(count, ARROW[spark_type]))
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in FIELDS])


def reduced(m: Matrix, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    """The complete nodes of a matrix, and the paths of its open ones. In the ``first`` round rows
    are conversations, whose ends are written; in the ``last`` every node is complete."""
    rows, width = m.words.shape
    starts = np.ones((rows, width), bool)
    if width:
        changed = (m.ids[1:] != m.ids[:-1]).reshape(rows - 1, width, 2).any(2)
        starts[1:] = np.logical_or.accumulate(changed, axis=1)
    # The turns that the last row has in common with the first.
    split = np.flatnonzero(starts[1:].any(0))
    common = int(split[0]) if len(split) else int(m.length[-1])
    below = None
    open_first = {name: np.zeros(m.length[0] + 1, np.int64) for name in (*SUMS, "low")}
    open_last = {name: np.zeros(m.length[-1] + 1, np.int64) for name in (*SUMS, "low")}
    open_last["low"][:] = NO_ID
    for depth in range(width, -1, -1):
        valid = np.flatnonzero(m.length >= depth)
        begins = starts[valid, depth - 1] if depth else np.arange(len(valid)) == 0
        cut = np.flatnonzero(begins)
        heads = valid[cut]
        total = {k: np.add.reduceat(m.known[k][valid, depth], cut) for k in SUMS}
        low = np.minimum.reduceat(m.known["low"][valid, depth], cut)
        # The last node may hold the last row; the first node, the first.
        closed = np.ones(len(cut), bool)
        if not last:
            closed[0] &= m.length[0] < depth
            closed[-1] &= m.length[-1] < depth
        if below is not None:
            above = np.searchsorted(heads, below["heads"], "right") - 1
            done = below["closed"]
            np.add.at(total["kids"], above[done], 1)
            np.add.at(total["leaves"], above[done], below["leaves"][done])
            np.add.at(total["saved"], above[done], below["saved"][done])
        if not last and m.length[0] >= depth:
            for k in SUMS:
                open_first[k][depth] = total[k][0]
            open_first["low"][depth] = low[0]
        if not last and depth > common and m.length[-1] >= depth:
            for k in SUMS:
                open_last[k][depth] = total[k][-1]
            open_last["low"][depth] = low[-1]
        words = m.words[heads, depth - 1] if depth else np.zeros(len(cut), np.int64)
        leaves = np.where(total["kids"] == 0, 1, total["leaves"])
        saved = (total["n"] - 1) * words + total["saved"]
        if below is not None:
            yield nodes(m, below, low[above], closed[above], first)
        below = {"depth": depth, "heads": heads, "closed": closed, "low": low, "n": total["n"]}
        below |= {"kids": total["kids"], "leaves": leaves, "saved": saved}
        if first:
            below["ends"] = ends(m, depth, valid, cut)
            if not last:
                yield pieces_of(m, below)
    yield nodes(m, below, None, None, first)
    if not last:
        picked = [0] if common == m.length[-1] else [0, rows - 1]
        open_ = [open_first, open_last]
        paths = {
            "ids": [m.ids[i, : 2 * m.length[i]] for i in picked],
            "conv": m.conv[picked],
            "words": [m.words[i, : m.length[i]] for i in picked],
        }
        paths |= {k: [open_[j][k] for j in range(len(picked))] for k in (*SUMS, "low")}
        yield found(1, len(picked), paths)


def ends(m: Matrix, depth: int, valid: np.ndarray, cut: np.ndarray) -> list[str]:
    """For each node the ids of the conversations that end there, in order."""
    stop = np.append(cut[1:], len(valid))
    ending = m.length[valid] == depth
    many = np.add.reduceat(ending.astype(np.int64), cut)
    # Shorter sequences come first, so the ending rows lead their node's.
    return [
        ",".join(map(str, m.conv[valid[a : a + k]].tolist())) if k else ""
        for a, k, _ in zip(cut.tolist(), many.tolist(), stop)
    ]


def pieces_of(m: Matrix, level: dict) -> pa.RecordBatch:
    """The ends of the open nodes of a depth."""
    depth = level["depth"]
    at = [i for i in np.flatnonzero(~level["closed"]).tolist() if level["ends"][i]]
    text = [level["ends"][i] for i in at]
    return found(
        2,
        len(at),
        {
            "key": [key_of(m.ids[level["heads"][i]], depth) for i in at],
            "conv_id": [int(t.split(",", 1)[0]) for t in text],
            "piece": text,
        },
    )


def nodes(
    m: Matrix, level: dict, parents: np.ndarray | None, known: np.ndarray | None, first: bool
) -> pa.RecordBatch:
    """The complete nodes of a depth. Where the parent is open its key stands for its number."""
    depth, at = level["depth"], np.flatnonzero(level["closed"])
    heads = level["heads"][at]
    columns = {
        "conv_id": level["low"][at],
        "depth": np.full(len(at), depth, np.int64),
        "n_convs": level["n"][at],
        "n_children": level["kids"][at],
        "n_leaves": level["leaves"][at],
        "saved_tokens": level["saved"][at],
    }
    if depth:
        closed = known[at]
        columns["parent"] = pa.array(parents[at], pa.int64(), mask=~closed)
        columns["parent_key"] = [
            None if c else key_of(m.ids[h], depth - 1) for c, h in zip(closed.tolist(), heads.tolist())
        ]
    if first:
        columns["sha"] = [sha(level["ends"][i]) if level["ends"][i] else EMPTY for i in at.tolist()]
    else:
        columns["key"] = [key_of(m.ids[h], depth) for h in heads.tolist()]
    return found(0, len(at), columns)


def matrices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that fill one matrix each."""
    for batch in batches:
        while batch.num_rows:
            length = np.diff(np.asarray(batch.column("ids").offsets)) + 2
            cells = np.maximum.accumulate(length) * np.arange(1, len(length) + 1)
            many = max(int(np.searchsorted(cells, most, "right")), LEAST_ROWS)
            yield batch.slice(0, many)
            batch = batch.slice(many)


def one_round(paths: DataFrame, first: bool, last: bool, shards: int, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if last:
            rows = [b for b in batches if b.num_rows]
            table = pa.Table.from_batches(rows).combine_chunks() if rows else None
            parts = iter(table.to_batches() if rows else [])
        else:
            parts = matrices(batches, most)
        for part in parts:
            # A deep matrix has a few rows for each depth; they leave as one batch.
            table = pa.Table.from_batches(list(reduced(Matrix.of(part), first, last)))
            yield from table.combine_chunks().to_batches()

    if last:
        paths = paths.coalesce(1)
    else:
        # Conversations with one sequence are told apart by their ids, so they spread too.
        ranges = ["ids", "conv"] if first else [shards, "ids", "conv"]
        paths = paths.repartitionByRange(*ranges).sortWithinPartitions("ids", "conv")
    return paths.mapInArrow(run, FOUND)


def hashed(pieces: DataFrame) -> DataFrame:
    """``key, sha`` of the pieces of each node, in the order of their first ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            keys, texts = batch.column("key").to_pylist(), batch.column("piece").to_pylist()
            for key, text in zip(keys, texts):
                if key != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield named(out)
        if now is not None:
            yield named([(now, state.hexdigest())])

    def named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.array([k for k, _ in rows], pa.binary()),
                "sha": pa.array([s for _, s in rows], pa.string()),
            }
        )

    ordered = pieces.select("key", "conv_id", "piece").repartition("key")
    return ordered.sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, sha string")


def trie(paths: DataFrame, most: int = CELLS, last_cells: int = LAST_CELLS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` of every node over rows ``ids, conv, words`` (two ids to a turn). A matrix has
    about ``most`` cells, the one of the last round ``last_cells``."""
    now = staged(paths, "conversations")
    rounds: list[DataFrame] = []
    while True:
        span = F.max(F.size("ids") + 2) * F.count(F.lit(1))
        many, cells = now.agg(F.count(F.lit(1)), span).first()
        last = bool(rounds) and (many <= LEAST_ROWS or cells <= last_cells)
        shards = (cells or 0) // (8 * most) + 1
        rounds.append(staged(one_round(now, not rounds, last, shards, most), "trie"))
        if last:
            break
        names = [part.split()[0] for part in PATH.split(", ")]
        now = rounds[-1].where("kind = 1").select(*names)
    names = [name for name, _ in FIELDS[: [n for n, _ in FIELDS].index("sha") + 1]]
    later = rounds[1]
    for more in rounds[2:]:
        later = later.unionByName(more)
    later = later.where("kind = 0").select(*names)
    shas = hashed(rounds[0].where("kind = 2"))
    later = later.drop("sha").join(shas, "key", "left").fillna({"sha": EMPTY})
    later = staged(later.select(*names), "open-nodes")
    whole = rounds[0].where("kind = 0").select(*names).unionByName(later)
    # A node whose parent was open when it was complete finds its parent's number by key.
    parents = later.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    under = whole.where("parent_key IS NOT NULL").withColumn("salt", salt_of(SALTS, F.col("conv_id")))
    under = under.join(salted(parents, SALTS), ["parent_key", "salt"], "left").drop("salt")
    under = under.withColumn("parent", F.col("found")).select(*names)
    return whole.where("parent_key IS NULL").unionByName(under).select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("sha").alias("ends_sha256"),
    )


def nodes_of(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return trie(sequences(conversations))
