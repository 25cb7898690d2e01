"""Mixing sources to target weights.

The words of a source's documents, laid end to end, are cut into blocks of ``BLOCK`` words. The
mix is a row of output shards of ``SHARD`` slots each. For every shard the number of slots of
each source is drawn from a multinomial; slots that a source has drawn beyond its target go to
the sources that have drawn too few. The q-th slot of a source takes block ``p(q mod n)`` of its
n blocks, with another pseudorandom permutation ``p`` for each source and pass, so that a block is
taken once in each pass. Blocks are joined by source and index.

Sources weigh 1, 2, 3, repeating, in the order of their code points, null last. Targets share all
words by weight, but none is above ``MOST`` times its source's size; what is cut off is shared
among the others again, until none is above.

A hot source is never one task's: documents are numbered in chunks, and running sums go over
chunks first. Seeds are fixed, so reruns agree. Defined results: a null text has size 0; a null
source is a source; a row of size 0 has taken 0; repeated rows are rows of their own; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristrata.llm.common import salt_of, salted
from tristrata.scratch import staged

BLOCK = 128
SHARD = 1024
MOST = 3
SEED = 7
#: Chunks that the documents of a source are numbered in.
CHUNKS = 1024
SALTS = 32
#: Sources whose probabilities are broadcast at once (half a megabyte).
SOURCES_AT_ONCE = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, out: str):
    """``df`` with the sum of ``value`` over the rows of ``keys`` ahead of each row, ordered by
    ``chunk`` and then ``order``; no task gets more than a chunk's rows."""
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__start", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)))
    inner = Window.partitionBy(*keys, chunk).orderBy(*order)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("__in", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .withColumn("__row", F.row_number().over(inner))
        .join(starts.drop("__sum"), [*keys, chunk])
        .withColumn(out, F.col("__start") + F.col("__in"))
        .drop("__start", "__in")
    )


def sources_of(sizes: DataFrame) -> DataFrame:
    """A row for each source: ``source, source_size, idx, weight``, numbered by code point."""
    ordered = staged(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last())
        .withColumn("at", F.monotonically_increasing_id()),
        "sources",
    )
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part")).count()
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("off"))
    return (
        ordered.withColumn("part", part)
        .join(offsets, "part")
        .withColumn("idx", F.col("off") + row)
        .withColumn("weight", F.col("idx") % 3 + 1)
        .select("source", "source_size", "idx", "weight")
    )


def with_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` with ``target``, the words that the mix should take of each.

    A source is full when its share is above its bound; shares only grow as sources fill up, so
    each pass is one sum over the sources and the passes end when no further one is full.
    """
    bound = F.col("source_size") * F.lit(float(most))
    total, weights, n = sources.agg(F.sum("source_size"), F.sum("weight"), F.count("*")).first()
    share, full = (total or 0) / (weights or 1), 0
    while n:
        over = bound < F.col("weight") * F.lit(share)
        taken, open_, now = sources.agg(
            F.sum(F.when(over, bound)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if now == full or not open_:
            break
        share, full = (total - taken) / open_, now
    return sources.withColumn("target", F.least(bound, F.col("weight") * F.lit(float(share))))


def measured(docs: DataFrame, text_col: str, source_col: str, carry: dict[str, Column]) -> DataFrame:
    return docs.select(
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        *[column.alias(name) for name, column in carry.items()],
    )


def numbered(sizes: DataFrame, sources: DataFrame, id_name: str) -> DataFrame:
    """Documents with their source's number and size and ``start``, their first word's place
    among the words of their source."""
    rows = sizes.withColumn("salt", salt_of(SALTS, F.col(id_name), F.col("text_hash")))
    few = salted(sources, SALTS).withColumnRenamed("source", "s").withColumnRenamed("salt", "t")
    rows = (
        rows.join(few, rows.source.eqNullSafe(few.s) & (rows.salt == few.t))
        .drop("s", "t", "salt")
        .withColumn("chunk", salt_of(CHUNKS, F.col(id_name)))
    )
    return running(rows, ["idx"], "chunk", [id_name, "size", "text_hash"], "size", "start")


def slots(spark: SparkSession, sources: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``shard, idx, q``: for every source its slots q = 0, 1, … in the output shards; ``sources``
    has ``idx`` and ``n_slots``."""
    n, total = sources.agg(F.count("*"), F.sum("n_slots")).first()
    total = total or 0
    shards = spark.range(-(-total // shard))
    groups = (
        sources.groupBy(F.expr(f"idx div {SOURCES_AT_ONCE}").alias("g"))
        .agg(F.sum("n_slots").alias("n"))
        .orderBy("g")
        .collect()
    )
    of_group = np.array([r.n for r in groups], float)
    drawn = None
    for number, group in enumerate(groups):
        part = sources.where(F.expr(f"idx div {SOURCES_AT_ONCE}") == group.g).orderBy("idx")
        own = np.array([tuple(r) for r in part.select("idx", "n_slots").collect()], np.int64)
        shared = spark.sparkContext.broadcast(own)

        def draw(batches: Iterator[pa.RecordBatch], shared=shared, number=number):
            own = shared.value
            p = own[:, 1] / max(own[:, 1].sum(), 1)
            for batch in batches:
                out = [[], [], []]
                for h in batch.column("id").to_pylist():
                    size = min(shard, total - h * shard)
                    # Every group draws the same split among groups for a shard.
                    split = np.random.default_rng([seed, h]).multinomial(size, of_group / total)
                    rng = np.random.default_rng([seed, h, number + 1])
                    counts = rng.multinomial(split[number], p) if split[number] else 0 * own[:, 1]
                    some = np.flatnonzero(counts)
                    for column, v in zip(out, (np.full(len(some), h), own[some, 0], counts[some])):
                        column.append(v)
                arrays = [pa.array(np.concatenate(c), pa.int64()) for c in out]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "idx", "n"])

        one = shards.mapInArrow(draw, "shard long, idx long, n long")
        drawn = one if drawn is None else drawn.unionByName(one)
    if drawn is None:
        return spark.createDataFrame([], "shard long, idx long, q long")
    drawn = staged(drawn.withColumn("chunk", F.expr(f"shard div {SHARD}")), "drawn")
    placed = running(drawn, ["idx"], "chunk", ["shard"], "n", "first").select(
        "shard", "idx", F.explode(F.expr("sequence(first, first + n - 1)")).alias("q")
    )
    totals = drawn.groupBy("idx").agg(F.sum("n").alias("n_drawn"))
    sums = sources.select("idx", "n_slots").join(totals, "idx", "left").na.fill(0, ["n_drawn"])
    sums = sums.withColumn("over", F.greatest(F.col("n_drawn") - F.col("n_slots"), F.lit(0)))
    sums = sums.withColumn("under", F.greatest(F.col("n_slots") - F.col("n_drawn"), F.lit(0)))
    sums = sums.withColumn("chunk", F.expr(f"idx div {SOURCES_AT_ONCE}"))
    # Surplus slots and missing ones are numbered alike and joined by number.
    sums = staged(sums.withColumn("all", F.lit(0)), "slots")
    over = running(sums, ["all"], "chunk", ["idx"], "over", "e0").select("idx", "n_slots", "e0")
    under = running(sums, ["all"], "chunk", ["idx"], "under", "e0").where("under > 0")
    missing = under.select(
        F.posexplode(F.expr("sequence(e0, e0 + under - 1)")).alias("i", "e"),
        F.col("idx").alias("to"),
        "n_drawn",
    ).select("e", "to", (F.col("n_drawn") + F.col("i")).alias("to_q"))
    placed = placed.join(over.hint("broadcast") if n <= SOURCES_AT_ONCE else over, "idx")
    fine = placed.where("q < n_slots").select("shard", "idx", "q")
    moved = (
        placed.where("q >= n_slots")
        .withColumn("e", F.col("e0") + F.col("q") - F.col("n_slots"))
        .join(missing, "e")
        .select("shard", F.col("to").alias("idx"), F.col("to_q").alias("q"))
    )
    return fine.unionByName(moved)


def mixed(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def permuted(at: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0 … n-1 takes ``at``; another one for each ``key``.

    A Feistel network of four rounds on an even number of bits; what falls beyond n goes
    through it again.
    """
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2), np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, left = at.astype(np.uint64), np.arange(len(at))
    while len(left):
        x, h, m, k = out[left], half[left], mask[left], key[left]
        a, b = x >> h, x & m
        for turn in range(4):
            a, b = b, a ^ (mixed(b, k + np.uint64(turn)) & m)
        out[left] = (a << h) | b
        left = left[out[left] >= n[left].astype(np.uint64)]
    return out.astype(np.int64)


def draws(spark: SparkSession, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """``shard, idx, q, block`` of the whole mix; ``sources`` has ``n_blocks``, ``n_slots``."""
    rows = slots(spark, sources, seed=seed)
    few = sources.select("idx", "n_blocks")
    rows = rows.join(few, "idx")

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, q, n = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("idx", "q", "n_blocks")
            )
            key = mixed((idx * 1_000_003 + q // n).astype(np.uint64), np.uint64(seed))
            block = permuted(q % n, n, key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("idx"), batch.column("q"), pa.array(block)],
                names=["shard", "idx", "q", "block"],
            )

    return rows.mapInArrow(through, "shard long, idx long, q long, block long")


def planned(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Targets in blocks: a source's slots are to its blocks as its target to its size."""
    some = with_targets(sources).withColumn(
        "n_blocks", F.ceil(F.col("source_size") / block).cast("long")
    )
    slots = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size"))
    return some.withColumn("n_slots", F.when(F.col("source_size") > 0, slots).otherwise(0).cast("long"))


def pieces_of(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each block that a document has words in, with ``words`` of them from ``first``;
    one row without a block for documents without words."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    spread = F.when(
        F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), last)
    ).otherwise(F.array(F.lit(None).cast("long")))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return (
        docs.withColumn("block", F.explode(spread))
        .withColumn("words", F.coalesce(high - low, F.lit(0).cast("long")))
        .withColumn("first", low - F.col("start"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``."""
    sizes = staged(measured(docs, text_col, source_col, {"doc_id": F.col(id_col)}), "sizes")
    sources = staged(planned(sources_of(sizes), block), "targets")
    many = (
        draws(docs.sparkSession, sources, seed).groupBy("idx", "block").agg(F.count("*").alias("times"))
    )
    parts = pieces_of(numbered(sizes, sources, "doc_id"), block)
    return (
        parts.join(many, ["idx", "block"], "left")
        .groupBy("idx", "chunk", "__row")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")],
            F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"),
        )
        .drop("idx", "chunk", "__row")
    )


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: ``shard, source, q, block, words`` with the words of every slot."""
    carry = {"doc_id": F.col(id_col), "text": F.col(text_col)}
    sizes = measured(docs, text_col, source_col, carry)
    sources = staged(planned(sources_of(sizes.drop("text")), block), "targets")
    cut = F.expr(f"regexp_extract_all(text, r'{WORD}', 0)")
    parts = pieces_of(numbered(sizes, sources, "doc_id"), block).where("words > 0")
    piece = F.slice(cut, (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    packed = (
        parts.select("idx", "source", "block", "start", piece.alias("piece"))
        .groupBy("idx", "block")
        .agg(
            F.first("source").alias("source"),
            F.flatten(
                F.expr("transform(array_sort(collect_list(struct(start, piece))), x -> x.piece)")
            ).alias("words"),
        )
    )
    return draws(docs.sparkSession, sources, seed).join(packed, ["idx", "block"]).select(
        "shard", "source", "q", "block", "words"
    )
