"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task cuts its partition into shards of bounded size and sorts all word suffixes of a shard.
Every suffix of every benchmark item is looked up by binary search, all at once; this yields the
longest verbatim match of each suffix with its place, and every place where a window occurs. The
benchmark is the stated query set: it is cut into blocks of bounded size, each shard meets one
block after another, and no text is shuffled.

Words are runs of digits, letters A-Z (lower-cased) and characters beyond ASCII. A window is
``WINDOW`` consecutive words of an item, or all words of an item that has fewer.

Defined results: a null text has no words and is never contaminated; items without words match
nothing; items without an id mark words but are not listed; repeated rows get equal results; an
empty benchmark leaves everything clean; an empty table gives an empty result. A text must fit
into a task; the depth of the sort is the longest item's number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.arrowtext import pieces, strings, word_table, words
from tristrata.llm.common import apart, together
from tristrata.scratch import staged

WINDOW = 13
#: Bytes of benchmark text that are broadcast and searched at once.
BLOCK_BYTES = 16 << 20
#: Words that one step of a comparison reads.
STRIDE = 16
#: Stands after the last word of a benchmark item.
END = -2

#: A word as an expression, and as bytes.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_BYTES = word_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


@dataclass
class Block:
    """Benchmark items as word numbers."""

    items: list[str | None]
    vocabulary: list[str]
    tokens: np.ndarray
    at: np.ndarray


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> list[Broadcast]:
    """The benchmark in broadcast blocks of about ``BLOCK_BYTES``.

    Repeated items count once. Spark deals them out to blocks, whatever they hold, so copies of a
    text under many ids spread as well; the driver holds one block at a time.
    """
    rows = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).dropDuplicates()
    size = F.octet_length("text").cast("long")
    rows = staged(rows.withColumn("nth", F.xxhash64(F.monotonically_increasing_id())), "benchmark")
    n = (rows.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES + 1
    out = []
    for k in range(n):
        block = rows.where(F.pmod("nth", F.lit(n)) == k).toArrow()
        texts = strings(block.column("text").combine_chunks())
        tokens, at, vocabulary = words(texts, WORD_BYTES)
        items = block.column("item_id").to_pylist()
        one = Block(items, vocabulary.to_pylist(), tokens, at)
        out.append(benchmark.sparkSession.sparkContext.broadcast(one))
    return out


def depth_of(benchmark: DataFrame, text_col: str = "text") -> int:
    """Words of the longest item."""
    return benchmark.agg(F.max(F.regexp_count(F.col(text_col), F.lit(WORDS)))).first()[0] or 0


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` tokens; ``tokens`` are positive, 0 separates.

    Three tokens are packed into the first key; after that only positions that are still tied
    are sorted by the ranks further on, at twice the distance each time.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    bits = 21
    if int(tokens.max()) >= 1 << bits:
        key, width = tokens.astype(np.int64), 1
    else:
        far = np.concatenate([tokens, [0, 0]]).astype(np.int64)
        key, width = (far[:-2] << 2 * bits) | (far[1:-1] << bits) | far[2:], 3
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    # A rank is the place of the first of its group, so it stays right when others split.
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while width < depth and len(tied):
        where = order[tied]
        key = rank[where] * (n + 2) + rank[np.minimum(where + width, n)] + 1
        by = np.argsort(key)
        where, key = where[by], key[by]
        order[tied] = where
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[where] = tied[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
    return order


class Shard:
    """Texts of one shard, their suffix array, and searches in it."""

    def __init__(self, texts: pa.Array, depth: int):
        ids, at, self.vocabulary = words(texts, WORD_BYTES)
        docs = len(texts)
        self.n_words = np.diff(at)
        #: Where each text begins among the tokens; a 0 stands after each text.
        self.begin = at[:-1] + np.arange(docs)
        self.tokens = np.zeros(len(ids) + docs + STRIDE, np.int64)
        owner = np.repeat(np.arange(docs), self.n_words)
        self.tokens[np.arange(len(ids)) + owner] = ids + 1
        order = suffix_array(self.tokens[: len(ids) + docs], depth)
        self.order = order[self.tokens[order] > 0]

    def numbered(self, block: Block) -> np.ndarray:
        """The block's words in this shard's numbers, -1 where it has no such word, each item
        followed by ``END``."""
        here = pc.index_in(pa.array(block.vocabulary, pa.large_string()), self.vocabulary)
        here = pc.fill_null(pc.add(here, 1), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        items = len(block.items)
        out = np.full(len(block.tokens) + items + STRIDE, END)
        if len(block.tokens):
            owner = np.repeat(np.arange(items), np.diff(block.at))
            out[np.arange(len(block.tokens)) + owner] = here[block.tokens]
        return out

    def compare(self, places: np.ndarray, test: np.ndarray, suffixes: np.ndarray, most: np.ndarray):
        """Common words of each place and suffix (``most`` at most), and whether the place sorts
        before the suffix."""
        n = len(places)
        common, before = np.zeros(n, np.int64), np.zeros(n, bool)
        left, off = np.arange(n), 0
        span = np.arange(STRIDE)
        while len(left):
            a = self.tokens[np.minimum(places[left, None] + off + span, len(self.tokens) - 1)]
            b = test[np.minimum(suffixes[left, None] + off + span, len(test) - 1)]
            differ = a != b
            some = differ.any(1)
            k = np.where(some, differ.argmax(1), STRIDE)
            common[left] = np.minimum(off + k, most[left])
            done = some | (off + STRIDE >= most[left])
            at = np.minimum(k, STRIDE - 1)
            rows = np.arange(len(left))
            real = some & (off + k < most[left])
            before[left] = real & (a[rows, at] < b[rows, at])
            left = left[~done]
            off += STRIDE
        return common, before

    def bound(self, test, suffixes, most, upper: bool) -> np.ndarray:
        """First place in the order whose suffix does not sort before the test suffix, cut to
        ``most`` words; with ``upper`` the first that sorts behind all that begin with it."""
        low = np.zeros(len(suffixes), np.int64)
        high = np.full(len(suffixes), len(self.order))
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            common, before = self.compare(self.order[mid], test, suffixes[open_], most[open_])
            right = before | (common >= most[open_]) if upper else before
            low[open_] = np.where(right, mid + 1, low[open_])
            high[open_] = np.where(right, high[open_], mid)
        return low

    def longest(self, test, suffixes, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of each test suffix, and one place of it."""
        if not len(self.order) or not len(suffixes):
            return np.zeros(len(suffixes), np.int64), np.zeros(len(suffixes), np.int64)
        at = self.bound(test, suffixes, lengths, False)
        after = self.order[np.minimum(at, len(self.order) - 1)]
        ahead = self.order[np.maximum(at - 1, 0)]
        one, _ = self.compare(after, test, suffixes, lengths)
        two, _ = self.compare(ahead, test, suffixes, lengths)
        return np.maximum(one, two), np.where(one >= two, after, ahead)

    def place(self, tokens_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and word number of places among the tokens."""
        doc = np.searchsorted(self.begin, tokens_at, "right") - 1
        return doc, tokens_at - self.begin[doc]


def suffixes_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, place and length of every suffix of the block's items."""
    sizes = np.diff(block.at)
    item = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.arange(len(block.tokens))
    return item, flat + item, block.at[1:][item] - flat


def each_block(known: list[Broadcast]) -> Iterator[Block]:
    """One block after another; only one is in memory at a time."""
    for b in known:
        yield b.value
        if len(known) > 1 and hasattr(b, "_value"):
            del b._value


MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"
MINE = {"n_words": "long", "n_hit": "long", "items": "array<string>", "matches": MATCHES}


def occurrences(shard: Shard, block: Block, window: int):
    """Every place where a window of the block occurs: item, item's word, place, words."""
    test = shard.numbered(block)
    item, place, length = suffixes_of(block)
    sizes = np.diff(block.at)[item]
    whole = (sizes < window) & (length == sizes)
    pick = np.flatnonzero(((length >= window) | whole) & (test[place] > 0))
    item, place, length = item[pick], place[pick], length[pick]
    need = np.minimum(length, window)
    found, _ = shard.longest(test, place, length)
    pick = np.flatnonzero(found >= need)
    item, place, length, need = item[pick], place[pick], length[pick], need[pick]
    low = shard.bound(test, place, need, False)
    high = shard.bound(test, place, need, True)
    many = high - low
    start = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    places = shard.order[start + np.arange(int(many.sum()))]
    word = np.diff(block.at)[item] - length
    return np.repeat(item, many), np.repeat(word, many), places, np.repeat(need, many)


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (ids with occurring windows, sorted as strings) and
    ``matches`` (longest runs of matching words). Columns of those names are replaced."""
    known, depth = blocks(benchmark), depth_of(benchmark)
    rest = docs.drop(*[c for c in MINE if c != text_col])
    names = [c for c in keep or rest.columns if c not in MINE]
    schema = T.StructType(
        [rest.schema[c] for c in names]
        + [T.StructField(c, T.DataType.fromDDL(k)) for c, k in MINE.items()]
    )
    fields = ["item_id", "item_word", "doc_word", "n_words"]
    match_type = pa.list_(
        pa.struct(list(zip(fields, [pa.string(), pa.int32(), pa.int32(), pa.int32()])))
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text_col):
            shard = Shard(texts, depth)
            n = len(texts)
            cover = np.zeros(len(shard.tokens) + 1, np.int64)
            items: list[set] = [set() for _ in range(n)]
            matches: list[list] = [[] for _ in range(n)]
            for block in each_block(known):
                item, word, places, need = occurrences(shard, block, window)
                if not len(places):
                    continue
                cover += np.bincount(places, minlength=len(cover))
                cover -= np.bincount(places + need, minlength=len(cover))
                # Windows one word apart on one diagonal are one longer match.
                by = np.lexsort((places, places - word, item))
                item, word, places, need = item[by], word[by], places[by], need[by]
                same = (np.diff(item) == 0) & (np.diff(places) == 1) & (np.diff(word) == 1)
                first = np.concatenate([[True], ~same])
                last = np.append(~same, True)
                run = (places[last] + need[last]) - places[first]
                doc, at = shard.place(places[first])
                for d, i, a, b, w in zip(
                    doc.tolist(), item[first].tolist(), word[first].tolist(), at.tolist(), run.tolist()
                ):
                    name = block.items[i]
                    if name is not None:
                        items[d].add(name)
                    matches[d].append((name, a, b, w))
            hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
            n_hit = hit[shard.begin + shard.n_words] - hit[shard.begin]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(shard.n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array([[dict(zip(fields, m)) for m in x] for x in matches], match_type),
                ],
                names=[*names, *MINE],
            )

    return rest.mapInArrow(find, schema)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """The rule: some word is hit, and hit words are a twentieth of all at least."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows."""
    found = search(apart(docs, text_col), benchmark, keep=["text", "rest"])
    return together(found.where(~contaminated()), docs, text_col)


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = WINDOW,
) -> DataFrame:
    """For every benchmark suffix the longest verbatim match in any shard and one place of it:
    ``item_id, item_word, n_words, doc_id, doc_word``; shorter ones than ``min_words`` are left
    out. Ties go to the largest document id, then the last word."""
    known, depth = blocks(benchmark), depth_of(benchmark)
    id_type = docs.schema[id_col].dataType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            shard = Shard(texts, depth)
            ids = batch.column("id")
            for block in each_block(known):
                test = shard.numbered(block)
                item, place, length = suffixes_of(block)
                pick = np.flatnonzero((length >= min_words) & (test[place] > 0))
                item, place, length = item[pick], place[pick], length[pick]
                found, where = shard.longest(test, place, length)
                pick = np.flatnonzero(found >= min_words)
                doc, word = shard.place(where[pick])
                names = pa.array([block.items[i] for i in item[pick].tolist()], pa.string())
                starts = np.diff(block.at)[item[pick]] - length[pick]
                yield pa.RecordBatch.from_arrays(
                    [
                        names,
                        pa.array(starts, pa.int32()),
                        pa.array(found[pick], pa.int32()),
                        ids.take(pa.array(doc)),
                        pa.array(word, pa.int32()),
                    ],
                    names=["item_id", "item_word", "n_words", "doc_id", "doc_word"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType.fromDDL("item_id string, item_word int, n_words int")
    schema = schema.add("doc_id", id_type).add("doc_word", "integer")
    return (
        rows.mapInArrow(find, schema)
        .groupBy("item_id", "item_word")
        .agg(F.max(F.struct("n_words", "doc_id", "doc_word")).alias("best"))
        .select("item_id", "item_word", "best.*")
    )
