"""Toxicity by class-conditional Kneser-Ney models of words, whose backoff counts are shared.

Both classes have a model of a word after the word before it, with absolute discounting and
interpolation on three levels:

    P(w | class, v) = (max(c(class, v, w) - D(class), 0) + D(class) N(class, v) P(w | class)) / c(class, v)
    P(w | class) = (1 - share) max(c(class, w) - E(class), 0) / S(class) + share P(w)
    P(w) = N(w) / sum of N

``c`` counts the labelled documents of a class in which w, or w right after v, stands; a document
that repeats them counts once. ``c(class, v)`` sums the pairs that begin with v and ``N(class, v)``
is the number of different ones; ``S`` sums the discounted counts. ``N(w)`` is the continuation
count: how many different words precede w in the whole corpus, the start of a text being one.

The continuation counts and their share are the same for both classes, and the discounts ``E`` remove
equal relative frequencies whichever class is larger. Words too rare to survive them, and words and
pairs whose class counts differ from what the shared count leads to expect by no more than chance does
among so many, are left to the level below in both classes: they say nothing of their own.

A text's raw score is the toxic less the ordinary log-likelihood, per word. A fifth of the labelled
rows is kept from the counts: on it a logistic curve over the raw score and the length gives the
probability. Short texts have noisier raw scores; hence the length.

The model is a table of words and pairs with weights that grows with the corpus; a pair's weight is what
it adds to that of its second word. The most frequent ones, at most ``HEAD``, are broadcast and settle
most of each text where it lies; all others are looked up by a join, so none is left out.

Pairs move packed, some bytes each: sorted, as differences, split up by a hash so that no word's
neighbours lie in one place. Words are 64-bit hashes; continuation counts tell preceding words apart
by 32 bits, which takes one in 10,000 from a word that a million words precede.

Defined results: null texts count as empty; texts without words get the share of toxic rows; rows
without a label or an id are scored, not learned from; several labels of one id are averaged and
toxic from one half on; with nothing to learn from every score is 0.5; an empty table gives an empty
result; repeated rows get equal scores; other columns are not looked at. Memory is bounded by pieces
of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.arrowtext import pieces, word_table, words
from tristrata.scratch import staged

#: Words and pairs whose weights are broadcast: 12 bytes each.
HEAD = 1 << 20
#: Words that a task adds up before it gives them out.
HELD = 1 << 20
#: Pairs of neighbouring words that a task adds up before it gives them out.
PAIRS = 1 << 21
#: Bytes of text for each group of pairs, and groups that the neighbours of one word are spread over.
GROUP = 16 << 20
SALTS = 8
#: Ids of labelled texts that are broadcast (12 bytes each); more are joined.
NEAR = 1 << 22
#: The word before the first.
START = 1
FOLDS = 5
SEED = 13
#: Share of the backoff distribution in both classes.
SHARE = 0.3
#: Steps of raw scores and lengths in the table that the curve is fitted on.
STEPS = 400
#: Weight of the squared parameters when the curve is fitted.
RIDGE = 1e-2

#: Letters, digits and the bytes of other scripts make words.
KEEP = word_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def codes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word."""
    hashes = (xxhash.xxh3_64_intdigest(w) for w in vocabulary.to_pylist())
    return np.fromiter(hashes, np.uint64, len(vocabulary)).astype(np.int64)


def merged(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their rows of values."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros((len(distinct), values[0].shape[1]), np.int64)
    np.add.at(total, at, np.concatenate(values))
    return distinct, total


COUNTS = "word long, toxic long, ordinary long, docs long"


def counted(rows: DataFrame) -> DataFrame:
    """``word, toxic, ordinary, docs`` with partial counts, of rows ``text, y``: in how many texts
    each word stands, by class, or, where y is null, in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, held = [], [], 0
        for batch, texts in pieces(batches, "text"):
            ids, at, vocabulary = words(texts, KEEP)
            if not len(ids):
                continue
            size = len(vocabulary)
            y = batch.column("y").cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(len(y)), np.diff(at))
            once = np.unique(text * size + ids)
            label, once = y[once // size], once % size
            own = [once[label >= 0.5], once[(label >= 0) & (label < 0.5)], once[label < 0]]
            keys.append(codes(vocabulary))
            values.append(np.stack([np.bincount(x, minlength=size) for x in own], 1))
            held += size
            if held > HELD:
                word, total = merged(keys, values)
                keys, values, held = [word], [total], len(word)
                if held > HELD // 2:
                    yield batch_of(word, total)
                    keys, values, held = [], [], 0
        if keys:
            yield batch_of(*merged(keys, values))

    def batch_of(word: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        names = [part.split()[0] for part in COUNTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (word, *total.T)], names=names)

    return rows.select("text", "y").mapInArrow(run, COUNTS)


def befores(ids: np.ndarray, at: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of the word before each word of texts that begin at ``at``."""
    out = np.full(len(ids), START, np.int64)
    out[1:] = code[ids[:-1]]
    out[at[:-1][np.diff(at) > 0]] = START
    return out


def pair_codes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two words' hashes."""
    return ((before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ word.view(np.uint64)).view(np.int64)


def planes(sorted_numbers: np.ndarray) -> bytes:
    """Differences of numbers, first all their lowest bytes; these compress well."""
    steps = np.diff(sorted_numbers, prepend=sorted_numbers.dtype.type(0))
    kind = sorted_numbers.dtype
    raw = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, kind.itemsize).T)
    return pa.compress(raw, "zstd", asbytes=True)


def numbers(packed: bytes, kind: str, many: int) -> np.ndarray:
    """What ``planes`` has packed."""
    kind = np.dtype(kind)
    raw = pa.decompress(packed, many * kind.itemsize, "zstd", asbytes=True)
    steps = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(kind).ravel(), dtype=kind)


def distinct(
    key: np.ndarray, other: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct pairs with the sums of their rows of values."""
    by = np.lexsort((other, key))
    key, other = key[by], other[by]
    new = np.ones(len(by), bool)
    new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(values[by], at, axis=0) if len(at) else values
    return key[at], other[at], total


PACKED = "slot int, many int, words int, key binary, size binary, other binary, value binary"


def paired(rows: DataFrame, slots: int, by_class: bool) -> DataFrame:
    """Packed pairs of neighbouring words of rows ``text, y``, each pair in one slot. Classes count
    texts with a pair; their key is the first word. Else the key is the second, and the first
    is known by 32 bits."""
    kind = np.dtype("<u8" if by_class else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch, texts in pieces(batches, "text"):
            ids, at, vocabulary = words(texts, KEEP)
            if not len(ids):
                continue
            code = codes(vocabulary)
            before, word = befores(ids, at, code).view(np.uint64), code[ids].view(np.uint64)
            if by_class:
                y = batch.column("y").cast(pa.float64()).to_numpy(zero_copy_only=False) >= 0.5
                text = np.repeat(np.arange(len(y)), np.diff(at))
                by = np.lexsort((word, before, text))
                once = np.ones(len(by), bool)
                for x in (text, before, word):
                    x = x[by]
                    once[1:] &= x[1:] == x[:-1]
                by = by[np.concatenate([[True], ~once[1:]])]
                toxic = y[text[by]]
                values = np.stack([toxic, ~toxic], 1).astype(np.int64)
                part = distinct(before[by], word[by], values)
            else:
                first = before & np.uint64(0xFFFFFFFF)
                part = distinct(word, first.astype(kind), np.zeros((len(word), 0), np.int64))
            held.append(part)
            many += len(part[0])
            if many >= PAIRS:
                held = [distinct(*map(np.concatenate, zip(*held)))]
                many = len(held[0][0])
                if many >= PAIRS // 2:
                    yield from batches_of(*held[0])
                    held, many = [], 0
        if held:
            yield from batches_of(*distinct(*map(np.concatenate, zip(*held))))

    def batches_of(key, other, values) -> Iterator[pa.RecordBatch]:
        salt = (other.astype(np.uint64) >> np.uint64(13)) % np.uint64(SALTS)
        slot = ((key >> np.uint64(16)) * np.uint64(SALTS) + salt) % np.uint64(slots)
        by = np.argsort(slot, kind="stable")
        edges = np.searchsorted(slot[by], np.arange(slots + 1))
        out = []
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            own, rest = key[by[a:b]], other[by[a:b]]
            new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            size = np.diff(np.append(new, b - a)).astype("<u4")
            value = values[by[a:b]].astype("<u8").T.ravel()
            packs = (planes(own[new]), planes(size), planes(rest), planes(value))
            out.append((k, b - a, len(new), *packs))
        kinds = [pa.int32()] * 3 + [pa.binary()] * 4
        names = [part.split()[0] for part in PACKED.split(", ")]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.select("text", "y").mapInArrow(run, PACKED)


def opened_pairs(table: pa.Table, kind: str, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of one slot: key, other, and counts by class."""
    parts = []
    for r in table.to_pylist():
        key = np.repeat(numbers(r["key"], "<u8", r["words"]), numbers(r["size"], "<u4", r["words"]))
        value = numbers(r["value"], "<u8", classes * r["many"]) if classes else np.zeros(0, np.uint64)
        value = value.astype(np.int64).reshape(classes, r["many"]).T
        parts.append((key, numbers(r["other"], kind, r["many"]), value))
    return distinct(*map(np.concatenate, zip(*parts)))


def slots_of(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return SALTS * (total // (GROUP * SALTS) + 1)


def continued(docs: DataFrame, slots: int) -> DataFrame:
    """Rows like those of ``counted``, with how many different words precede a word in ``docs``."""

    def count(table: pa.Table) -> pa.Table:
        key, _, _ = opened_pairs(table, "<u4", 0)
        word, many = np.unique(key, return_counts=True)
        none = pa.array(np.zeros(len(word), np.int64))
        return pa.table({"word": word.view(np.int64), "toxic": none, "ordinary": none, "docs": many})

    return paired(docs, slots, False).groupBy("slot").applyInArrow(count, COUNTS)


#: Of a context: sums of its pairs' counts by class, and how many of the pairs count at all, once, twice.
CONTEXT = [f"{what}_{c}" for what in ("kinds", "once", "twice") for c in ("toxic", "ordinary")]
CLASSED = "before long, word long, gram long, toxic long, ordinary long, " + ", ".join(
    f"{c} long" for c in CONTEXT
)


def class_pairs(learned: DataFrame, slots: int, part: float, most: float) -> DataFrame:
    """Pairs of words whose class counts differ by more than chance, as ``before, word, gram, toxic,
    ordinary``, and, where ``word`` is null, sums of all pairs of a context, in parts."""

    def count(table: pa.Table) -> pa.Table:
        before, word, value = opened_pairs(table, "<u8", 2)
        n = value.sum(1)
        apart = (value[:, 0] - n * part) ** 2 > most * n * part * (1 - part)
        at = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        each = np.concatenate([value, value > 0, value == 1, value == 2], 1).astype(np.int64)
        sums = np.add.reduceat(each, at, axis=0)
        own = before[apart].view(np.int64), word[apart].view(np.int64)
        none = np.zeros((len(own[0]), len(CONTEXT)), np.int64)
        numeric = np.concatenate([np.concatenate([value[apart], none], 1), sums])
        gone = pa.nulls(len(at), pa.int64())
        arrays = [
            pa.array(np.concatenate([own[0], before[at].view(np.int64)])),
            pa.concat_arrays([pa.array(own[1]), gone]),
            pa.concat_arrays([pa.array(pair_codes(*own)), gone]),
            *[pa.array(c) for c in numeric.T],
        ]
        return pa.table(arrays, names=[c.split()[0] for c in CLASSED.split(", ")])

    return paired(learned, slots, True).groupBy("slot").applyInArrow(count, CLASSED)


def discount(by_count: dict[int, int]) -> float:
    """The Kneser-Ney discount, from how many words occur once and twice."""
    one, two = by_count.get(1, 0), by_count.get(2, 0)
    return one / (one + 2 * two) if one else 0.5


def levels(counts: DataFrame, share: float = SHARE) -> DataFrame | None:
    """``word, n, toxic, ordinary, differs`` with the probabilities of every word by class; None
    without texts of both."""
    sums = counts.agg(
        *[F.sum(c).alias(c) for c in ("toxic", "ordinary", "docs")],
        F.count_if(F.col("toxic") + F.col("ordinary") > 0).alias("words"),
    ).first()
    n = F.col("toxic") + F.col("ordinary")
    if not (sums.toxic and sums.ordinary):
        return None
    # The discount comes from the smaller class; the other's removes the same frequency.
    lesser = "toxic" if sums.toxic <= sums.ordinary else "ordinary"
    rare = counts.where(F.col(lesser).isin(1, 2)).groupBy(lesser).count()
    d = discount({r[0]: r[1] for r in rare.collect()})
    off = {c: d * sums[c] / sums[lesser] for c in ("toxic", "ordinary")}
    left = {c: F.greatest(F.col(c) - off[c], F.lit(0.0)) for c in off}
    total = counts.agg(*[F.sum(left[c]).alias(c) for c in off]).first()
    common = F.greatest(F.col("docs"), F.lit(1)) / max(sums.docs or 0, 1)
    p = {c: (1 - share) * left[c] / max(total[c], 1.0) + share * common for c in off}
    # Deviations that the largest of so many words reaches by chance.
    part = sums.toxic / (sums.toxic + sums.ordinary)
    chance = 2 * math.log(max(sums.words, 2)) * n * part * (1 - part)
    apart = F.pow(F.col("toxic") - n * part, F.lit(2)) > chance
    differs = apart & ((left["toxic"] > 0) | (left["ordinary"] > 0))
    own = [F.when(differs, p[c]).otherwise(common).alias(c) for c in off]
    return counts.select("word", n.alias("n"), *own, differs.alias("differs"))


def weighted(counts: DataFrame, share: float = SHARE) -> DataFrame:
    """``word, n, weight`` of the words that the classes differ in: the log of their probability
    in toxic texts over that in ordinary ones."""
    known = levels(counts, share)
    if known is None:
        n = F.col("toxic") + F.col("ordinary")
        return counts.select("word", n.alias("n"), F.lit(0.0).alias("weight")).limit(0)
    weight = F.log(F.col("toxic") / F.col("ordinary")).alias("weight")
    return known.where("differs").select("word", "n", weight)


def weighted_pairs(learned: DataFrame, counts: DataFrame, slots: int) -> DataFrame:
    """Rows like those of ``weighted`` for pairs of neighbouring words: what they add to the weight
    of the second word."""
    known = levels(counts)
    if known is None:
        return weighted(counts)
    sums = counts.agg(
        F.sum("toxic").alias("toxic"),
        F.sum("ordinary").alias("ordinary"),
        F.count_if(F.col("toxic") + F.col("ordinary") > 0).alias("words"),
    ).first()
    # As for words, but among as many pairs as the words can make.
    most = 2 * math.log(max(sums.words, 2) ** 2)
    pairs = staged(
        class_pairs(learned, slots, sums.toxic / (sums.toxic + sums.ordinary), most), "pairs"
    )
    contexts = pairs.where("word IS NULL")
    rare = contexts.agg(*[F.sum(c).alias(c) for c in CONTEXT[2:]]).first()
    found = pairs.where("word IS NOT NULL").select("before", "word", "gram", "toxic", "ordinary")
    of = contexts.join(found.select("before").distinct(), "before", "left_semi").groupBy("before")
    of = of.agg(*[F.sum(c).alias(f"all_{c}") for c in ("toxic", "ordinary", *CONTEXT[:2])])
    base = known.select("word", *[F.col(c).alias(f"p_{c}") for c in ("toxic", "ordinary")])
    p = {}
    for c in ("toxic", "ordinary"):
        d = discount({1: rare[f"once_{c}"] or 0, 2: rare[f"twice_{c}"] or 0})
        left = F.greatest(F.col(c) - d, F.lit(0.0)) + d * F.col(f"all_kinds_{c}") * F.col(f"p_{c}")
        p[c] = F.when(F.col(f"all_{c}") > 0, left / F.col(f"all_{c}")).otherwise(F.col(f"p_{c}"))
    added = F.log(p["toxic"] / p["ordinary"]) - F.log(F.col("p_toxic") / F.col("p_ordinary"))
    return found.join(of, "before").join(base, "word").select(
        F.col("gram").alias("word"),
        (F.col("toxic") + F.col("ordinary")).alias("n"),
        added.alias("weight"),
    )


def split_at(model: DataFrame, most: int) -> int:
    """The least count with which a word belongs to the broadcast words, of which there are at
    most ``most``."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).alias("step")
    sizes = model.groupBy(step).agg(F.count("*").alias("many"), F.min("n").alias("least"))
    least, total = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r.step):
        total += row.many
        if total > most:
            break
        least = row.least
    return least


def looked_up(docs: DataFrame, head: tuple[np.ndarray, np.ndarray], tail: bool) -> DataFrame:
    """``row, n, head, rest`` with the columns of ``docs`` but the text: words of the text, the sum
    of the weights of its broadcast words and pairs of words, and, if there is a ``tail``, all others,
    as hashes and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(head)
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch, texts in pieces(batches, "text"):
            ids, at, vocabulary = words(texts, KEEP)
            code = codes(vocabulary)
            weight, known = np.zeros(len(code)), np.zeros(len(code), bool)
            if len(keys) and len(code):
                place = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
                known = keys[place] == code
                weight = np.where(known, weights[place], 0.0)
            weights_of, pair = weight[ids], pair_codes(befores(ids, at, code), code[ids])
            met = np.zeros(len(pair), bool)
            if len(keys) and len(pair):
                place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                met = keys[place] == pair
                weights_of = weights_of + np.where(met, weights[place], 0.0)
            run_up = np.concatenate([[0.0], np.cumsum(weights_of)])
            total = run_up[at[1:]] - run_up[at[:-1]]
            rest = [None] * len(texts)
            if tail:
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                    single = code[ids[a:b][~known[ids[a:b]]]]
                    other = np.concatenate([single, pair[a:b][~met[a:b]]])
                    other, many = np.unique(other, return_counts=True)
                    if len(other):
                        rest[i] = np.stack([other, many], 1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(np.arange(row, row + len(texts))),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(total, pa.float64()),
                    pa.array(rest, pa.binary()),
                ],
                names=[*names, "row", "n", "head", "rest"],
            )
            row += len(texts)

    schema = docs.select(names).schema
    for name, kind in (("row", "long"), ("n", "long"), ("head", "double"), ("rest", "binary")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, word, many`` of packed words."""
    for batch in batches:
        packed = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in batch.column("rest").to_pylist()]
        for k in range(0, len(packed), 1000):
            part = packed[k : k + 1000]
            row = batch.column("row").to_numpy()[k : k + 1000]
            flat = np.concatenate(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(row, [len(p) for p in part])), pa.array(flat[:, 0]), pa.array(flat[:, 1])],
                names=["row", "word", "many"],
            )


def log_ratios(docs: DataFrame, model: DataFrame, most: int = HEAD) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n`` words and ``raw``, the mean weight."""
    least = split_at(model, most)
    table = model.where(F.col("n") >= least).select("word", "weight").toArrow()
    key = table.column("word").to_numpy().astype(np.int64)
    order = np.argsort(key)
    head = key[order], table.column("weight").to_numpy().astype(np.float32)[order]
    tail = model.where(F.col("n") < least)
    some = not tail.isEmpty()
    rows = staged(looked_up(docs, head, some), "looked-up")
    total = F.col("head")
    if some:
        asked = rows.where("rest IS NOT NULL").select("row", "rest")
        asked = asked.mapInArrow(opened, "row long, word long, many long")
        sums = asked.join(tail.select("word", "weight"), "word").groupBy("row")
        rows = rows.join(sums.agg(F.sum(F.col("many") * F.col("weight")).alias("tail")), "row", "left")
        total = total + F.coalesce("tail", F.lit(0.0))
    raw = F.when(F.col("n") > 0, total / F.col("n")).otherwise(0.0).alias("raw")
    return rows.select(*[c for c in docs.columns if c != "text"], "n", raw)


def features(raw: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the curve sees: the raw score, its distance from noise, the length."""
    return np.stack([np.ones(len(raw)), 10 * raw, raw * np.sqrt(n), np.log1p(n) / 10], 1)


def curve(raw: np.ndarray, n: np.ndarray, count: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Parameters of the logistic curve nearest to shares ``good / count``, by Newton steps."""
    x = features(raw, n)
    beta = np.zeros(x.shape[1])
    ridge = RIDGE * np.array([1e-3, 1, 1, 1])
    loss = np.inf
    for _ in range(100):
        z = np.clip(x @ beta, -30, 30)
        p = 1 / (1 + np.exp(-z))
        slope = x.T @ (good - count * p) - ridge * beta
        curved = (x * (count * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curved, slope)
        beta = beta + step / max(1, np.abs(step).max() / 2)
        now = (count * np.logaddexp(0, z) - good * z).sum()
        if abs(loss - now) < 1e-9 * (1 + abs(now)):
            break
        loss = now
    return beta


def calibrated(rows: DataFrame) -> tuple[np.ndarray, float] | None:
    """The curve's parameters and the share of toxic rows, of rows ``raw, n, y``. The rows are added
    up in a table of bounded size first."""
    cell = [
        F.floor(F.greatest(F.least("raw", F.lit(2.0)), F.lit(-2.0)) * (STEPS / 4)).alias("score"),
        F.floor(F.log2(F.col("n") + F.lit(1.0)) * 4).alias("size"),
    ]
    found = rows.groupBy(*cell).agg(
        F.avg("raw"), F.avg("n"), F.count("*"), F.sum(F.col("y").cast("double"))
    )
    table = np.array([[float(v) for v in r[2:]] for r in sorted(found.collect())])
    if not len(table):
        return None
    raw, n, count, good = table.T
    full = n > 0
    return curve(raw[full], n[full], count[full], good[full]), good.sum() / count.sum()


def classify(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.7,
    head: int = HEAD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, learned from labelled rows that are
    not held out."""
    docs = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out")
    )
    known = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg((F.avg(F.col(label_col)) >= 0.5).cast("int").alias("y"))
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(FOLDS))
    # Held-out texts and those of the curve's fold do not move to the labels. Copies of a text
    # count once, or the words of a text with a thousand copies would look like marks of its class.
    open_ = docs.where(~F.col("held_out") & (fold != 0))
    single = (
        open_.select("doc_id", F.xxhash64("text").alias("same"))
        .join(known, "doc_id")
        .groupBy("same")
        .agg(F.min("doc_id").alias("doc_id"), (F.avg("y") >= 0.5).cast("int").alias("y"))
        .select("doc_id", "y")
    )
    single = staged(single, "labelled")
    single = F.broadcast(single) if single.count() <= NEAR else single
    learned = open_.join(single, "doc_id").select("text", "y")
    every = docs.select("text", F.lit(None).cast("int").alias("y"))
    slots = slots_of(docs)
    counts = counted(learned).unionByName(continued(every, slots)).groupBy("word")
    counts = staged(counts.agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "docs")]), "counts")
    model = weighted(counts).unionByName(weighted_pairs(learned, counts, slots))
    model = staged(model, "weights")
    rows = staged(log_ratios(docs, model, head), "ratios")
    kept = rows.where(~F.col("held_out") & (fold == 0)).join(known, "doc_id")
    fitted = calibrated(kept.select("raw", "n", "y"))
    if fitted is None:
        score = F.lit(0.5)
    else:
        beta, base = fitted
        n = F.col("n").cast("double")
        terms = [F.lit(1.0), 10 * F.col("raw"), F.col("raw") * F.sqrt(n), F.log1p(n) / 10]
        z = sum(float(b) * t for b, t in zip(beta, terms))
        score = F.when(n > 0, 1 / (1 + F.exp(-z))).otherwise(float(base))
    return rows.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
