"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact confirmation.

Documents with one set of shingles are a class; only classes are compared. Every class has a
signature of ``HASHES`` minima. Classes that agree on one band of ``ROWS`` minima meet in a bucket.
Instead of all pairs of a bucket:

1. every class is paired with the bucket's pivot, a member picked by hash, so that a class meets
   other pivots in its other buckets;
2. signatures are compared in batches of ``BATCH`` minima; after each batch a pair goes when, by
   the Beta posterior of its similarity, the chance of reaching the threshold is below ``MISS``;
3. for each class the likeliest surviving pair is confirmed on the full sets, and components are
   formed; then the other surviving pairs whose ends lie in different components;
4. in buckets that still have more than one component, members outside of the largest one meet the
   members of other components, block by block. The Bayesian test leaves the members that have
   a plausible partner; these meet again with their full sets, and only links that join two
   components come out. A pair is looked at in the first band that it shares, and no more.

So every pair that meets in a bucket is compared or already lies in one component; no pair is
left out by a cap, and none is written out for being in a bucket. With 40 bands of 6 a pair of similarity 0.8 meets nowhere with a chance of
0.000005, and the Bayesian test loses at most ``MISS`` of those that meet.

Defined results: a null or empty text has no shingles and stays alone; so does a null id's row
unless its set has others; the component of a class without any id is null; rows of equal sets
(repeated rows too) are one class; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.arrowtext import pieces, words
from tristrata.llm.bits import bitmap, passing
from tristrata.llm.common import apart, salt_of, salted, together
from tristrata.llm.components import components
from tristrata.scratch import staged

SHINGLE = 4
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
BATCH = 48
#: Chance at which the Bayesian test may lose a pair that is similar enough.
MISS = 1e-6
#: Members of a bucket that are compared with as many others at once.
CHUNK = 1024
#: Bytes of full sets in a block, and in what a task compares at once.
BLOCK_BYTES = 32 << 20
SALTS = 16
#: Bytes of text that a task works on at once, and pairs of sets that it holds.
PIECE = 2 << 20
PAIRS = 512

#: Bytes that separate words become spaces, all others stay.
NOT_SPACE = np.arange(256, dtype=np.uint8)
NOT_SPACE[0x09:0x0E] = 0x20
NOT_SPACE[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every text."""
    ids, at, vocabulary = words(texts, NOT_SPACE)
    code = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary)
    )
    word = code[ids]
    n = len(word)
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        # Places at the end of a text wrap into others; they are not used.
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(word, -k)
    hashes = mixed(hashes)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = whole * np.uint64(0x9E3779B97F4A7C15) + word[k]
            out.append(mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prints(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one, two = mixed(own).sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return (
        rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
        rng.integers(0, 1 << 32, HASHES, dtype=np.uint32),
    )


def signature(own: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest 16 bits of each hash function's minimum over the set."""
    x = (own >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(low, (x[k : k + 256, None] * a + b).min(0), out=low)
    return low.astype("<u2")


@lru_cache
def needed(threshold: float, miss: float) -> tuple[int, ...]:
    """For each number of compared minima, the fewest matches with which a pair stays: those for
    which the posterior chance of reaching the threshold, under a uniform prior, is over ``miss``."""
    out = []
    grid = np.linspace(0, 1, 4001)[1:-1]
    for n in range(BATCH, HASHES + 1, BATCH):
        least = 0
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            log += lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            mass = np.exp(log)
            if mass[grid >= threshold].sum() / mass.sum() >= miss:
                least = m
                break
        out.append(least)
    return tuple(out)


def plausible(one: np.ndarray, two: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Matching minima of each pair of rows, or -1 for pairs that the test prunes."""
    matches = np.zeros(len(one), np.int64)
    left = np.arange(len(one))
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[left] += (one[left, part] == two[left, part]).sum(1)
        lost = matches[left] < need
        matches[left[lost]] = -1
        left = left[~lost]
        if not len(left):
            break
    return matches


def matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), HASHES)


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tie, n, p, q, sig`` of every row: a hash of its text, then size, print and
    signature of its set."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = family()
        for batch, texts in pieces(batches, "text", PIECE):
            sets = shingles(texts)
            names = [prints(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tie"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p for p, _ in names], pa.int64()),
                    pa.array([q for _, q in names], pa.int64()),
                    pa.array(
                        [signature(s, a, b).tobytes() if len(s) else None for s in sets], pa.binary()
                    ),
                ],
                names=["doc_id", "tie", "n", "p", "q", "sig"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("tie"),
        F.col(text_col).alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(measure, f"doc_id {kind}, tie long, n long, p long, q long, sig binary")


def banded(classes: DataFrame) -> DataFrame:
    """``bucket, band, node, n``: a row for every band of every class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = matrix(batch.column("sig")).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sig), 1))
            for k in range(ROWS):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            size = np.repeat(batch.column("n").to_numpy(), BANDS)
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(sig))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().astype(np.int64)), pa.array(band), pa.array(node), pa.array(size)],
                names=["bucket", "band", "node", "n"],
            )

    return classes.select("sig", "node", "n").mapInArrow(
        cut, "bucket long, band int, node long, n long"
    )


def near_size(a: str, b: str, threshold: float) -> str:
    """Sets that differ more in size cannot be similar enough."""
    return f"least({a}, {b}) >= {threshold} * greatest({a}, {b})"


def tested(pairs: DataFrame, classes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """``a, b, matches`` of the pairs that the Bayesian test leaves."""
    least = needed(threshold, miss)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = plausible(matrix(batch.column("sig_a")), matrix(batch.column("sig_b")), least)
                batch = pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(m)], names=["a", "b", "matches"]
                )
                yield batch.filter(pa.array(m >= 0))

    for end in ("a", "b"):
        own = classes.selectExpr(f"node AS {end}", f"n AS n_{end}", f"sig AS sig_{end}")
        pairs = pairs.join(own, end)
    pairs = pairs.where(near_size("n_a", "n_b", threshold)).select("a", "b", "sig_a", "sig_b")
    return pairs.mapInArrow(test, "a long, b long, matches long")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, own``: the sorted hashes of the wanted classes' sets, from the whole text of one of
    their documents; ``wanted`` has ``node, doc_id, tie, p, q``."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", PIECE):
            sets = shingles(texts)
            asked = zip(batch.column("p").to_pylist(), batch.column("q").to_pylist())
            # An id may be repeated with another text; the print tells which row is meant.
            right = np.array([prints(s) == pq for s, pq in zip(sets, asked)], bool)
            own = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column("node"), own], names=["node", "own"])
            yield out.filter(pa.array(right))

    texts = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("tie"),
        F.col(text_col).alias("text"),
    )
    # Only texts that are asked for need to move to their class. Ids may be null or repeated, so
    # the text's hash is part of the key.
    wanted = wanted.withColumnRenamed("doc_id", "id")
    texts = passing(texts, bitmap(wanted, ["id", "tie"]), ["id", "tie"]).alias("t")
    same = F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.tie") == F.col("w.tie"))
    rows = texts.join(wanted.alias("w"), same).select("node", "p", "q", "text")
    return rows.mapInArrow(take, "node long, own binary")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar enough."""
    percent = round(100 * threshold)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, PAIRS) for b in batches for k in range(0, b.num_rows, PAIRS)):
            good = []
            for x, y in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield out.filter(pa.array(good, pa.bool_()))

    for end in ("a", "b"):
        pairs = pairs.join(sets.selectExpr(f"node AS {end}", f"own AS own_{end}"), end)
    return pairs.select("a", "b", "own_a", "own_b").mapInArrow(confirm, "a long, b long")


def unsettled(buckets: DataFrame) -> DataFrame:
    """Buckets with members of several components; ``buckets`` has ``bucket, node, n, label``. In a
    bucket of two, one is the pivot, so the two have met."""
    parts = buckets.groupBy("bucket", "label").agg(F.count("*").alias("count"), F.sum("n").alias("n"))

    def blocks(members, shingles):
        return F.ceil(F.greatest(members / CHUNK, shingles * 8 / BLOCK_BYTES))

    return (
        parts.groupBy("bucket")
        .agg(
            F.max(F.struct("count", "label", "n")).alias("top"),
            F.sum("count").alias("members"),
            F.sum("n").alias("n"),
            F.count("*").alias("labels"),
        )
        .where("labels > 1 AND members > 2")
        .select(
            "bucket",
            F.col("top.label").alias("major"),
            blocks(F.col("members") - F.col("top.count"), F.col("n") - F.col("top.n")).alias("lefts"),
            blocks(F.col("members"), F.col("n")).alias("rights"),
        )
    )


def met(buckets: DataFrame) -> DataFrame:
    """Members of unsettled buckets in blocks ``bucket, i, j``: on the left those outside of the
    bucket's largest component, on the right all; no block has much over ``CHUNK`` of either."""
    salt = salt_of(SALTS, F.col("node"))
    rows = buckets.withColumn("salt", salt).join(salted(unsettled(buckets), SALTS), ["bucket", "salt"])
    place = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30))
    names = ["bucket", "band", "node", "label", "n"]
    left = rows.where("label != major").select(
        *names,
        F.lit(True).alias("left"),
        F.pmod(place, F.col("lefts")).alias("i"),
        F.explode(F.expr("sequence(0L, rights - 1)")).alias("j"),
    )
    right = rows.select(
        *names,
        F.lit(False).alias("left"),
        F.explode(F.expr("sequence(0L, lefts - 1)")).alias("i"),
        F.pmod(place, F.col("rights")).alias("j"),
    )
    return left.unionByName(right)


BLOCK = "bucket long, band int, node long, label long, n long, left boolean, i long, j long"


def block_rows(table: pa.Table) -> list[np.ndarray]:
    """Row numbers of each block in a task's group."""
    keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
    order = np.lexsort(keys)
    keys = keys[:, order]
    return np.split(order, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1)


class Members:
    """Columns of a group of block members."""

    def __init__(self, table: pa.Table, threshold: float, miss: float):
        self.node, self.label, self.n, self.band = (
            table.column(c).to_numpy() for c in ("node", "label", "n", "band")
        )
        self.left = table.column("left").to_numpy()
        self.sig = matrix(table.column("sig"))
        self.threshold, self.least = threshold, needed(threshold, miss)

    def partners(self, x: int, two: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """Places in ``two`` of the plausible partners of ``x``, among those that are open, in
        the first band that the pair shares."""
        n = self.n[two]
        y = np.flatnonzero(
            open_ & (np.minimum(n, self.n[x]) >= self.threshold * np.maximum(n, self.n[x]))
        )
        mine = np.broadcast_to(self.sig[x], (len(y), HASHES))
        y = y[plausible(mine, self.sig[two[y]], self.least) >= 0]
        equal = (self.sig[two[y]] == self.sig[x]).reshape(-1, BANDS, ROWS).all(2)
        return y[equal.argmax(1) == self.band[x]] if len(y) else y


def grouped(rows: DataFrame) -> DataFrame:
    """Rows of blocks with ``slot``: a task's group is many small blocks or a large one, and is
    bounded by rows and by the bytes of their sets."""
    many, shingles = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(many // (4 * CHUNK), shingles * 8 // (2 * BLOCK_BYTES)) + 1
    return rows.withColumn("slot", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(groups)))


def hopeful(
    blocks: DataFrame, classes: DataFrame, threshold: float, miss: float
) -> DataFrame:
    """The members of blocks that have a plausible partner there, with size and signature."""

    def test(table: pa.Table) -> pa.Table:
        own = Members(table, threshold, miss)
        keep = np.zeros(table.num_rows, bool)
        for rows in block_rows(table):
            one, two = rows[own.left[rows]], rows[~own.left[rows]]
            for x in one.tolist():
                y = own.partners(x, two, own.label[two] != own.label[x])
                keep[two[y]] = True
                keep[x] |= len(y) > 0
        names = [c for c in table.column_names if c != "slot"]
        return table.select(names).filter(pa.array(keep))

    rows = grouped(blocks).join(classes.select("node", "sig"), "node")
    schema = f"{BLOCK}, sig binary"
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.select(*names, "slot").groupBy("slot").applyInArrow(test, schema)


def across(members: DataFrame, sets: DataFrame, threshold: float, miss: float) -> DataFrame:
    """``a, b``: confirmed links between components within blocks; one for two components."""
    percent = round(100 * threshold)

    def compare(table: pa.Table) -> pa.Table:
        own = Members(table, threshold, miss)
        node, n = own.node, own.n
        full = [np.frombuffer(x, "<u8") for x in table.column("own").to_pylist()]
        found = []
        for rows in block_rows(table):
            one, two = rows[own.left[rows]], rows[~own.left[rows]]
            now = own.label[two].copy()
            for x in one.tolist():
                mine = now[node[two] == node[x]]
                mine = mine[0] if len(mine) else own.label[x]
                y = own.partners(x, two, now != mine)
                if not len(y):
                    continue
                sizes = n[two[y]]
                flat = np.concatenate([full[k] for k in two[y].tolist()])
                at = np.minimum(np.searchsorted(full[x], flat), len(full[x]) - 1)
                ends = np.cumsum(sizes)
                both = np.concatenate([[0], np.cumsum(full[x][at] == flat)])
                both = both[ends] - both[ends - sizes]
                for k in y[100 * both >= percent * (n[x] + sizes - both)].tolist():
                    if now[k] != mine:
                        found.append((node[x], node[two[k]]))
                        now[now == now[k]] = mine
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
            }
        )

    rows = grouped(members).join(sets, "node")
    return rows.groupBy("slot").applyInArrow(compare, "a long, b long")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of ``node``, itself where it has none."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    miss: float = MISS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    return decided(docs, id_col, text_col, threshold, miss).drop("tie")


def decided(
    docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """``group`` with ``tie``, the hash of the row's text, which tells rows of one id apart."""
    rows = staged(measured(docs, id_col, text_col), "signatures")
    classes = staged(
        rows.where("n > 0")
        .groupBy("p", "q", "n")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct("doc_id", "tie")).alias("one"),
            F.first("sig").alias("sig"),
        )
        .select("p", "q", "n", "doc_id", F.col("one.doc_id").alias("id"), "one.tie", "sig")
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    pivots = (
        banded(classes)
        .groupBy("bucket")
        .agg(F.count("*").alias("members"), F.max(F.struct(F.xxhash64("bucket", "node"), "node")).alias("p"))
        .where("members > 1")
        .select("bucket", F.col("p.node").alias("pivot"))
    )
    buckets = staged(
        banded(classes)
        .withColumn("salt", salt_of(SALTS, F.col("node")))
        .join(salted(pivots, SALTS), ["bucket", "salt"])
        .drop("salt"),
        "buckets",
    )
    star = (
        buckets.where("node != pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    pairs = staged(tested(star, classes, threshold, miss), "pairs")
    # Each class's likeliest pair first; the others may lie within a component by then.
    ends = pairs.select("a", "b", "matches", F.explode(F.array("a", "b")).alias("node"))
    first = ends.groupBy("node").agg(F.max(F.struct("matches", "a", "b")).alias("top"))
    first = first.select("top.a", "top.b").distinct()

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        asked = classes.join(nodes.select("node").distinct(), "node", "left_semi")
        one = asked.select("node", F.col("id").alias("doc_id"), "tie", "p", "q")
        asked = staged(one, f"{name}-asked")
        own = full_sets(docs, asked, id_col, text_col).groupBy("node").agg(F.first("own").alias("own"))
        return staged(own, name)

    sets = sets_of(ends, "sets")
    links = staged(confirmed(first, sets, threshold), "links")
    labels = staged(components(links), "labels")
    of = {end: labels.selectExpr(f"node AS {end}", f"label AS label_{end}") for end in ("a", "b")}
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti")
    rest = rest.join(of["a"], "a", "left").join(of["b"], "b", "left")
    rest = rest.where("coalesce(label_a, a) != coalesce(label_b, b)").select("a", "b")
    links = staged(links.unionByName(confirmed(rest, sets, threshold)), "links")
    labels = staged(components(links), "labels")

    blocks = staged(met(labelled(buckets.select("bucket", "band", "node", "n"), labels)), "blocks")
    members = staged(hopeful(blocks, classes, threshold, miss), "members")
    more = sets_of(members.join(sets, "node", "left_anti"), "more-sets")
    last = across(members, sets.unionByName(more), threshold, miss)
    labels = components(links.unionByName(last))

    named = labelled(classes.select("node", "p", "q", "n", "doc_id"), labels)
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    spread = named.withColumn("salt", salt_of(SALTS, F.col("node")))
    named = spread.join(salted(smallest, SALTS), ["label", "salt"]).select("p", "q", "n", "component")
    out = (
        rows.select("doc_id", "tie", "n", "p", "q")
        .withColumn("salt", salt_of(SALTS, F.col("doc_id")))
        .join(salted(named, SALTS), ["p", "q", "n", "salt"], "left")
    )
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "tie",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id. Rows without an
    id stay where their component has no id; of an id repeated with another text only the rows
    go whose own component has a smaller id."""
    gone = decided(docs, id_col, text_col).where("NOT kept")
    gone = staged(gone.select("doc_id", "tie").distinct(), "gone")
    rows = apart(docs, text_col).withColumn("tie", F.xxhash64("text")).alias("r")
    # The texts stay in the JVM; where the keys are too many for a broadcast they are shuffled once.
    own = F.col("r.text") if id_col == text_col else F.col(f"r.rest.{id_col}")
    same = own.eqNullSafe(F.col("g.doc_id")) & (F.col("r.tie") == F.col("g.tie"))
    return together(rows.join(gone.alias("g"), same, "left_anti"), docs, text_col)
