"""Removal of repeated byte strings, with suffix arrays by Lyndon groups.

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a
document with a smaller id, or earlier in the same one. Texts are taken whole, as UTF-8; strings
never cross documents and are judged on the input.

All strings of ``LENGTH`` bytes (windows) of the corpus cannot be sorted in one place, so they are
dealt out by content. The anchor of a window is its lowest-hashed run of ``GRAM`` bytes; equal
windows have equal anchors at equal places. A stretch is a run of windows that share one anchor.

1. Each task cuts its texts into stretches. Of stretches with equal content the earliest stays, the
   others are repeats; first among a task's own stretches, then among all.
2. Stretches whose anchor has other stretches, too, may share some windows with them. Their bytes
   are brought together by anchor, and in blocks of about ``BLOCK`` bytes the suffix array is built;
   suffixes that agree in ``LENGTH`` bytes are neighbours in it, and all but the earliest are repeats.
   An anchor with over ``CROWD`` different stretches is split up by the content of its windows first.
3. Marks are gathered by document and applied to its text.

Only stretches whose anchor occurs again, and documents with marks or shared anchors, are moved;
bitmaps keep the rest in place (they may let some more through, which costs time but no result).

Defined results: null and empty texts have nothing to remove; a null id comes first; rows that
repeat an id and its text are one document and get equal results; documents of one id with
different texts are ordered by a hash; other columns are not looked at; an empty table gives an
empty result. A text must fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.arrowtext import buffers, pieces
from tristrata.llm.bits import bitmap, passing
from tristrata.llm.common import salt_of, salted
from tristrata.llm.lyndon import suffix_array
from tristrata.scratch import staged

LENGTH = 100
GRAM = 24
#: Bytes whose stretches are computed at once; a longer text is cut into sections of this size.
SECTION = 1 << 20
#: Stretches that a task compares with each other before they are dealt out.
FLUSH = 1 << 19
#: Bytes of one suffix array.
BLOCK = 1 << 16
#: Bytes of the stretches that one group of anchors has, about.
GROUP = 4 << 20
CROWD = 4096
SALTS = 4

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of all parts of a stretch of bytes, from sums over its beginnings."""

    def __init__(self):
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.power) < n:
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE))])
            self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, back))])

    def sums(self, raw: np.ndarray) -> np.ndarray:
        self.reach(len(raw))
        terms = (raw.astype(np.uint64) + np.uint64(1)) * self.power[: len(raw)]
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def parts(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from minima of runs cut at multiples of it."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(raw: np.ndarray, inside: np.ndarray | None, hashes: Hashes):
    """``start, windows, anchor, content`` of the stretches of ``raw``; ``inside`` tells which
    windows count."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    sums = hashes.sums(raw)
    at = np.arange(len(raw) - GRAM + 1)
    grams = hashes.parts(sums, at, at + GRAM)
    mask = np.uint64((1 << 22) - 1)
    # Of equal grams the first counts, so the place is the end of the key.
    keys = (grams & ~mask) | at.astype(np.uint64)
    anchor = (lowest(keys, LENGTH - GRAM + 1) & mask).astype(np.int64)
    inside = np.ones(n, bool) if inside is None else inside
    change = np.ones(n, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(change)
    windows = np.diff(np.append(start, n))
    start, windows = start[inside[start]], windows[inside[start]]
    content = hashes.parts(sums, start, start + windows + LENGTH - 1)
    return start, windows, grams[anchor[start]].astype(np.int64), content.astype(np.int64)


def cut(at: np.ndarray, raw: np.ndarray, hashes: Hashes):
    """Stretches of a piece of texts: text, start in the text, windows, anchor, content."""
    size = np.diff(at)
    if len(raw) <= SECTION + LENGTH:
        starts = np.arange(max(len(raw) - LENGTH + 1, 0))
        owner = np.searchsorted(at, starts, "right") - 1
        start, windows, anchor, content = stretches(raw, starts + LENGTH <= at[owner + 1], hashes)
        # Windows of two texts are kept apart, as between them windows cross texts.
        doc = owner[start] if len(start) else start
        yield doc, start - at[doc] if len(start) else start, windows, anchor, content
        return
    for doc in range(len(size)):
        own = raw[at[doc] : at[doc + 1]]
        for begin in range(0, len(own), SECTION):
            part = own[begin : begin + SECTION + LENGTH - 1]
            start, windows, anchor, content = stretches(part, None, hashes)
            yield np.full(len(start), doc), start + begin, windows, anchor, content


PLACE = "id long, tie long, pos long"
STRETCH = f"h long, c long, {PLACE}, n int, again boolean"
NAMES = ["h", "c", "id", "tie", "pos", "n", "again"]


def first_of(h, c, order) -> tuple[np.ndarray, np.ndarray]:
    """An order by key and place, and which of the sorted rows begin a key."""
    by = np.lexsort((*order[::-1], c, h))
    new = np.ones(len(by), bool)
    new[1:] = (h[by][1:] != h[by][:-1]) | (c[by][1:] != c[by][:-1])
    return by, new


def all_stretches(rows: DataFrame) -> DataFrame:
    """Stretches of every text; ``again`` marks those that their own task has seen earlier."""

    def compare(held: list[tuple]) -> pa.RecordBatch:
        ids, ties, pos, n, h, c = (np.concatenate(x) for x in zip(*held))
        by, new = first_of(h, c, (ids, ties, pos))
        first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        ids, ties, pos, n, h, c = (x[by] for x in (ids, ties, pos, n, h, c))
        # The same place of a repeated row is no repeat.
        twin = (ids == ids[first]) & (ties == ties[first]) & (pos == pos[first])
        keep = new | ~twin
        arrays = [pa.array(x[keep]) for x in (h, c, ids, ties, pos, n.astype(np.int32), ~new)]
        return pa.RecordBatch.from_arrays(arrays, names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, many = Hashes(), [], 0
        for batch, texts in pieces(batches, "text", SECTION):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            ties = batch.column("tie").to_numpy(zero_copy_only=False)
            at, raw = buffers(texts)
            for doc, pos, n, h, c in cut(at, raw, hashes):
                if len(doc):
                    held.append((ids[doc], ties[doc], pos, n, h, c))
                    many += len(doc)
                if many >= FLUSH:
                    yield compare(held)
                    held, many = [], 0
        if held:
            yield compare(held)

    return rows.mapInArrow(run, STRETCH)


def only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the documents in ``keys``, and few others."""
    return passing(rows, bitmap(keys, ["id", "tie"]), ["id", "tie"])


def repeated_windows(
    data: list[bytes], rank: np.ndarray, places: np.ndarray
) -> list[tuple[int, int]]:
    """``(stretch, window)`` of the windows that occur earlier; ``data`` holds the stretches'
    bytes, ``rank`` their documents' order and ``places`` where they start therein."""
    size = np.array([len(d) for d in data])
    text = b"".join(data)
    raw = np.frombuffer(text, np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(data)), size)
    # One symbol between stretches, and the smallest one at the end.
    symbols = np.zeros(len(raw) + len(data), np.int64)
    symbols[np.arange(len(raw)) + owner] = raw.astype(np.int64) + 2
    symbols[(begin + size + np.arange(len(data)))[:-1]] = 1
    order = np.array(suffix_array(symbols.tolist()))
    ends = np.cumsum(size + 1)
    doc = np.searchsorted(ends, order, "right")
    at = order - (ends - size - 1)[doc]
    valid = at + LENGTH <= size[doc]
    doc, at = doc[valid], at[valid]
    if not len(doc):
        return []
    where = begin[doc] + at
    view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)
    same = np.zeros(len(where), bool)
    for k in range(1, len(where), 1 << 16):
        stop = min(k + (1 << 16), len(where))
        same[k:stop] = (view[where[k:stop]] == view[where[k - 1 : stop - 1]]).all(1)
    run = np.cumsum(~same)
    # Within a run of equal windows the earliest place stays.
    # Stretches of one document may follow each other, so the place in the text counts.
    by = np.lexsort((places[doc] + at, rank[doc], run))
    rest = np.concatenate([[False], run[by][1:] == run[by][:-1]])
    return list(zip(doc[by][rest].tolist(), at[by][rest].tolist()))


def trimmed(data: list[bytes], hashes: Hashes) -> list[tuple[int, int, bytes]]:
    """``(stretch, start, bytes)`` from the first to the last window of each stretch whose hash
    another one has; stretches without such a window can share none."""
    size = np.array([len(d) for d in data])
    raw = np.frombuffer(b"".join(data), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    many = np.maximum(size - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(data)), many)
    place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    start = begin[owner] + place
    codes = hashes.parts(hashes.sums(raw), start, start + LENGTH)
    _, which, times = np.unique(codes, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    owner, place = owner[shared], place[shared]
    out = []
    for a, b in runs_of(owner):
        k, first, last = int(owner[a]), int(place[a]), int(place[b - 1])
        out.append((k, first, data[k][first : last + LENGTH]))
    return out


def shared_windows(cuts: DataFrame, total: int) -> DataFrame:
    """Marks ``id, tie, pos, n`` of windows that anchors' stretches share; ``cuts`` has ``h``, the
    place and the ``bytes``."""

    def compare(table: pa.Table) -> pa.Table:
        h, ids, ties, pos = (table.column(c).to_numpy() for c in ("h", "id", "tie", "pos"))
        own = table.column("bytes")
        by = np.lexsort((pos, ties, ids, h))
        new = np.ones(len(by), bool)
        for x in (h, ids, ties, pos):
            new[1:] &= x[by][1:] == x[by][:-1]
        # Rows of one place come from repeated documents.
        by = by[np.concatenate([[True], ~new[1:]])] if len(by) else by
        found: list[tuple[int, int]] = []

        def flush(held: list[int]) -> None:
            order = sorted(held, key=lambda k: (ids[k], ties[k], pos[k]))
            # The hashes only leave out what cannot match; the suffix array decides.
            kept = trimmed([own[k].as_py() for k in order], hashes)
            rows = np.array([order[k] for k, _, _ in kept], np.int64)
            change = (ids[rows][1:] != ids[rows][:-1]) | (ties[rows][1:] != ties[rows][:-1])
            rank = np.concatenate([[0], np.cumsum(change)])
            starts = np.array([at for _, at, _ in kept], np.int64)
            if len(kept) > 1:
                data = [x for _, _, x in kept]
                for d, at in repeated_windows(data, rank, pos[rows] + starts):
                    found.append((int(rows[d]), int(starts[d]) + at))

        hashes, held, size = Hashes(), [], 0
        for a, b in runs_of(h[by]):
            if size >= BLOCK:
                flush(held)
                held, size = [], 0
            if b - a > 1:
                held += by[a:b].tolist()
                size += sum(len(own[k].as_py()) for k in by[a:b].tolist())
        if held:
            flush(held)
        rows = np.array([k for k, _ in found], np.int64)
        at = np.array([x for _, x in found], np.int64)
        return pa.table(
            {
                "id": pa.array(ids[rows]),
                "tie": pa.array(ties[rows]),
                "pos": pa.array(pos[rows] + at),
                "n": pa.array(np.ones(len(rows), np.int32)),
            }
        )

    groups = max(total // GROUP, 0) + 1
    slot = F.pmod(F.xxhash64("h"), F.lit(groups))
    return cuts.withColumn("slot", slot).groupBy("slot").applyInArrow(compare, f"{PLACE}, n int")


def runs_of(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    if not len(sorted_keys):
        return []
    edge = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return list(zip([0, *edge.tolist()], [*edge.tolist(), len(sorted_keys)]))


def crowded_windows(cuts: DataFrame) -> DataFrame:
    """The same for anchors with very many stretches: their windows are keyed by content."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "tie", "pos", "bytes")))
            out = [
                (i, t, p + k, hashlib.blake2b(data[k : k + LENGTH], digest_size=16).digest())
                for i, t, p, data in rows
                for k in range(len(data) - LENGTH + 1)
            ]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "tie", "pos", "w"])

    windows = staged(cuts.mapInArrow(spread, f"{PLACE}, w binary"), "windows")
    first = windows.groupBy("w").agg(
        F.min(F.struct("id", "tie", "pos")).alias("f"), F.count("*").alias("many")
    ).where("many > 1")
    sides = windows.withColumn("salt", salt_of(SALTS, F.col("id"), F.col("pos")))
    return (
        sides.join(salted(first, SALTS), ["w", "salt"])
        .where("NOT (id = f.id AND tie = f.tie AND pos = f.pos)")
        .select("id", "tie", "pos", F.lit(1).alias("n"))
    )


def marks(rows: DataFrame) -> DataFrame:
    """``id, tie, pos, n``: runs of windows that occur earlier."""
    parts = staged(all_stretches(rows), "stretches")
    fresh = parts.where("NOT again").select("h", "c", "id", "tie", "pos", "n")
    busy = fresh.groupBy("h").agg(
        F.count("*").alias("many"), F.min("c").alias("low"), F.max("c").alias("high")
    ).where("many > 1").select("h", (F.col("low") != F.col("high")).alias("varied"))
    busy = staged(busy, "busy")
    salt = salt_of(SALTS, F.col("c"), F.col("id"))
    again = passing(fresh, bitmap(busy, ["h"]), ["h"])
    near = staged(
        again.withColumn("salt", salt).join(salted(busy, SALTS), ["h", "salt"]).drop("salt"), "near"
    )
    first = staged(
        near.groupBy("h", "c", "varied").agg(
            F.min(F.struct("id", "tie", "pos", "n")).alias("f"), F.count("*").alias("many")
        ),
        "first",
    )
    later = (
        near.withColumn("salt", salt)
        .join(salted(first.where("many > 1").select("h", "c", "f"), SALTS), ["h", "c", "salt"])
        .where("NOT (id = f.id AND tie = f.tie AND pos = f.pos)")
        .select("id", "tie", "pos", "n")
    )
    out = parts.where("again").select("id", "tie", "pos", "n").unionByName(later)

    varied = first.where("varied").select("h", "f.*")
    crowds = varied.groupBy("h").count().where(f"count > {CROWD}").select("h", F.lit(True).alias("crowd"))
    varied = varied.withColumn("salt", salt_of(SALTS, F.col("id"), F.col("pos")))
    varied = varied.join(salted(crowds, SALTS), ["h", "salt"], "left").withColumn(
        "crowd", F.coalesce("crowd", F.lit(False))
    )
    wanted = staged(
        varied.groupBy("id", "tie").agg(
            F.collect_list(F.struct("h", "crowd", "pos", "n")).alias("parts")
        ),
        "wanted",
    )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            places = zip(*(batch.column(c).to_pylist() for c in ("id", "tie", "parts")))
            out = []
            for text, (i, t, own) in zip(texts, places):
                raw = text.as_py().encode()
                for p in own:
                    part = raw[p["pos"] : p["pos"] + p["n"] + LENGTH - 1]
                    out.append((p["h"], p["crowd"], i, t, p["pos"], part))
            if out:
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                names = ["h", "crowd", "id", "tie", "pos", "bytes"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    cuts = staged(
        only(rows, wanted)
        .join(wanted, ["id", "tie"])
        .mapInArrow(take, f"h long, crowd boolean, {PLACE}, bytes binary"),
        "cuts",
    )
    total = cuts.where("NOT crowd").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    calm = shared_windows(cuts.where("NOT crowd").select("h", "id", "tie", "pos", "bytes"), total)
    return staged(
        out.unionByName(calm).unionByName(crowded_windows(cuts.where("crowd"))), "marks"
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, tie, text``: an order of documents; a null id is the smallest."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


CUT = "id long, tie long, n_removed long, n_spans long, kept binary"


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, tie, n_removed, n_spans, kept`` of the documents that lose bytes, once each."""
    rows = keyed(docs, id_col, text_col)
    found = marks(rows).groupBy("id", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("parts"))
    found = staged(found, "found")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            removed, spans, kept = [], [], []
            for text, parts in zip(texts, batch.column("parts")):
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                values = parts.values
                pos = values.field("pos").to_numpy()
                end = pos + values.field("n").to_numpy() + LENGTH - 1
                edge = np.bincount(pos, minlength=len(raw) + 1) - np.bincount(end, minlength=len(raw) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tie"),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["id", "tie", "n_removed", "n_spans", "kept"],
            )

    hit = only(rows, found).join(found, ["id", "tie"])
    return hit.mapInArrow(apply, CUT).dropDuplicates(["id", "tie"])


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    lost = removals(docs, id_col, text_col).select(
        "id", "tie", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(text).alias("tie"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("whole"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(lost, ["id", "tie"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts; a character that is cut in two by
    this becomes a replacement character."""
    lost = removals(docs, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("tie").alias("__tie"), F.col("kept").alias("__kept")
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    here = F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63)))
    same = (here == F.col("__id")) & (F.xxhash64(text) == F.col("__tie"))
    out = docs.join(lost, same, "left")
    cut = F.coalesce(F.expr("make_valid_utf8(CAST(__kept AS STRING))"), F.col(text_col))
    return out.withColumn(text_col, cut).select(docs.columns)
