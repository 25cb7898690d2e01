"""Language identification: scripts narrow the candidates, Viterbi labels spans of words.

A model is learned from labelled texts: for each language the counts of byte 3-grams, 4-grams
and whole words of lower-cased words, hashed into tables of fixed size and summed by partition,
and how often the language uses each script. A word's score for a language is its mean log
likelihood ratio; languages that do not use the word's script are no candidates. The best path
over all words of the whole text, where a change of language costs ``SWITCH``, labels each word;
runs of one label are the spans. The language with the most letters in its spans is predicted,
and its share of the letters is the score.

Defined results: a null text and one without a letter are ``und`` with score 0 and no spans; an
empty table gives an empty result; with nothing to learn from everything is ``und``; ties go to
the language that sorts first. Rows are handled one by one, so repeated rows get equal results.
Each text must fit into a task; memory is bounded by pieces of texts, not by partitions. The
number of languages is not limited: their tables are rows that executors make, and the driver and
the tasks hold a block of ``BLOCK`` languages at a time.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.arrowtext import (
    PIECE_BYTES,
    SUMS,
    added,
    partial_sums,
    pieces,
    sums_by_key,
    word_table,
    words,
)
from tristrata.llm.common import apart, together
from tristrata.scratch import staged

#: Slots of each of the three hashed tables.
SLOTS = 1 << 15
#: Cost of changing the language between two words, in nats.
SWITCH = 9.0
#: A word cannot weigh more than this many nats, so that one odd name is no switch.
WORD_LIMIT = 6.0
#: A language uses a script that makes up this share of its words at least.
SCRIPT_SHARE = 0.001
#: Languages whose tables are in memory at once (25 MB).
BLOCK = 64
#: Slots of a row of a language's tables.
CUT = 1 << 10

#: First code points of ranges and their script (Unicode blocks; fixed values).
SCRIPTS = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
]
SCRIPT_STARTS = [start for start, _ in SCRIPTS]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF_RANGE = [SCRIPT_NAMES.index(name) for _, name in SCRIPTS]
LATIN = SCRIPT_NAMES.index("latin")

LETTERS = word_table([*range(0x61, 0x7B), *range(0x80, 0x100)])
#: Counts of one language: three tables, then words by script.
WIDTH = 3 * SLOTS + len(SCRIPT_NAMES)


@dataclass
class Model:
    langs: list[str]
    #: For each ``BLOCK`` languages: languages x 3 tables of log likelihoods.
    logs: list[Broadcast]
    #: languages x scripts, whether the language uses the script
    scripts: np.ndarray
    prior: np.ndarray


def word_facts(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters and script of each word, then for every n-gram its slot and its word."""
    texts = [w.lower() for w in vocabulary.to_pylist()]
    letters = np.zeros(len(texts), np.int64)
    scripts = np.full(len(texts), LATIN, np.int64)
    for i, w in enumerate(texts):
        if w.isascii():
            letters[i] = len(w)
            continue
        alpha = [c for c in w if c.isalpha()]
        letters[i] = len(alpha)
        if alpha:
            # The first letter beyond ASCII decides, or Latin letters alone.
            odd = next((c for c in alpha if c > "\x7f"), "a")
            scripts[i] = SCRIPT_OF_RANGE[bisect.bisect_right(SCRIPT_STARTS, ord(odd)) - 1]
    raw = np.frombuffer((" " + " ".join(texts) + " ").encode(), np.uint8).astype(np.uint64)
    space = raw == 0x20
    if not texts:
        none = np.zeros(0, np.int64)
        return letters, scripts, none, none
    word_at = np.cumsum(space) - 1
    slots, owners = [], []
    for table, n in enumerate((3, 4)):
        if len(raw) < n:
            continue
        code = np.zeros(len(raw) - n + 1, np.uint64)
        for k in range(n):
            code = code * np.uint64(256) + raw[k : len(raw) - n + 1 + k]
        inner = np.zeros(len(code), bool)
        for k in range(1, n - 1):
            inner |= space[k : len(raw) - n + 1 + k]
        inner = ~inner
        slots.append(hashed(code[inner]) + table * SLOTS)
        owners.append(word_at[: len(code)][inner])
    # Whole words: a polynomial over their bytes.
    starts = np.flatnonzero(space)[:-1]
    powers = np.cumprod(np.full(len(raw), 0x100000001B3, np.uint64))
    rows = np.add.reduceat(raw * 0 + raw * powers[relative(starts, len(raw))], starts)
    slots.append(hashed(rows) + 2 * SLOTS)
    owners.append(np.arange(len(texts)))
    return letters, scripts, np.concatenate(slots), np.concatenate(owners)


def relative(starts: np.ndarray, n: int) -> np.ndarray:
    """Position of each of ``n`` places within its run."""
    ends = np.append(starts[1:], n)
    return np.arange(n) - np.repeat(starts, ends - starts) if n else np.zeros(0, np.int64)


def hashed(code: np.ndarray) -> np.ndarray:
    mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the rows' texts; rows without a language do not count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch, texts in pieces(batches, "text"):
            ids, at, vocabulary = words(texts, LETTERS)
            letters, scripts, slots, owners = word_facts(vocabulary)
            langs = np.array(batch.column("lang").to_pylist(), object)
            of_word = np.repeat(langs, np.diff(at))
            for lang in set(langs):
                seen = np.bincount(ids[of_word == lang], minlength=len(letters))
                seen = np.where(letters > 0, seen, 0)
                grams = np.bincount(slots, weights=seen[owners], minlength=3 * SLOTS)
                use = np.bincount(scripts, weights=seen, minlength=len(SCRIPT_NAMES))
                one = np.concatenate([grams, use])
                sums[lang] = sums[lang] + one if lang in sums else one
            if len(sums) >= BLOCK:
                yield partial_sums(sums)
                sums = {}
        yield partial_sums(sums)

    def likelihoods(sums: pa.Table) -> pa.Table:
        """The tables of one language in rows of ``CUT`` slots, and its words by script."""
        whole = added(sums)
        counts = np.frombuffer(whole.column("vec")[0].as_py(), "<f8")
        grams = counts[: 3 * SLOTS].reshape(3, SLOTS) + 0.2
        logs = np.log(grams / grams.sum(1, keepdims=True)).astype("<f4").reshape(-1, CUT)
        n = len(logs)
        use = [counts[3 * SLOTS :].tolist()] + [None] * (n - 1)
        return pa.table(
            {
                "lang": pa.array(whole.column("key").to_pylist() * n, pa.string()),
                "part": pa.array(range(n), pa.int32()),
                "logs": pa.array([row.tobytes() for row in logs], pa.binary()),
                "use": pa.array(use, pa.list_(pa.float64())),
            }
        )

    picked = rows.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("lang IS NOT NULL")
    table = "lang string, part int, logs binary, use array<double>"
    known = staged(sums_by_key(picked.mapInArrow(count, SUMS), likelihoods, table), "langs")
    uses = {r.lang: r.use for r in known.where("part = 0").select("lang", "use").collect()}
    langs = sorted(uses)
    logs = []
    for k in range(0, len(langs), BLOCK):
        own = langs[k : k + BLOCK]
        block = np.zeros((len(own), 3 * SLOTS), "<f4")
        for r in known.where(F.col("lang").isin(own)).drop("use").collect():
            block[own.index(r.lang), r.part * CUT : (r.part + 1) * CUT] = np.frombuffer(r.logs, "<f4")
        logs.append(rows.sparkSession.sparkContext.broadcast(block))
    use = np.array([uses[x] for x in langs]).reshape(len(langs), len(SCRIPT_NAMES))
    total = np.maximum(use.sum(1, keepdims=True), 1)
    prior = np.log((use.sum(1) + 1) / (use.sum() + len(langs))) if langs else np.zeros(0)
    return Model(langs, logs, use / total >= SCRIPT_SHARE, prior)


def word_scores(model: Model, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words x languages: nats by which the language is likelier than the mean; and letters."""
    letters, scripts, slots, owners = word_facts(vocabulary)
    n, k = len(letters), len(model.langs)
    out, j = np.zeros((n, k)), 0
    for block in model.logs:
        for logs in block.value:
            out[:, j] = np.bincount(owners, weights=logs[slots], minlength=n)
            j += 1
        if len(model.logs) > 1:
            # Read again for the next piece; one block is in memory at a time.
            del block._value
    # n-grams overlap, so their sum counts every letter several times.
    out = np.clip((out - out.mean(1, keepdims=True)) / 3, -WORD_LIMIT, WORD_LIMIT)
    fits = model.scripts[:, scripts].T
    out = np.where(fits | ~fits.any(1, keepdims=True), out, -4 * WORD_LIMIT)
    out[letters == 0] = 0
    return out, letters


def best_paths(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Label of every word on its text's best path, for all texts step by step together."""
    counts = np.diff(at)
    order = np.argsort(-counts, kind="stable")
    begins, lengths = at[:-1][order], counts[order]
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), "left")
    state, stays, tops = np.tile(prior, (len(order), 1)), [], []
    for t in range(longest):
        k = alive[t]
        now = state[:k]
        top = now.argmax(1)
        jump = now[np.arange(k), top][:, None] - SWITCH
        stay = now >= jump
        state[:k] = np.where(stay, now, jump) + scores[ids[begins[:k] + t]]
        stays.append(stay)
        tops.append(top)
    labels = np.zeros(len(ids), np.int64)
    label = state.argmax(1)
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        labels[begins[:k] + t] = label[:k]
        kept = stays[t][np.arange(k), label[:k]]
        label[:k] = np.where(kept, label[:k], tops[t])
    return labels


SPANS = "array<struct<lang:string,first_word:int,n_words:int,letters:long>>"


def identify(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    spans: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) and ``lang_pred``, ``score`` and, if asked for,
    ``spans``. Columns that have one of these names are replaced."""
    mine = ["lang_pred", "score", "spans"][: 3 if spans else 2]
    rest = docs.drop(*[c for c in mine if c != text_col])
    names = [c for c in keep or rest.columns if c not in mine]
    kinds = ["string", "double", SPANS]
    schema = T.StructType(
        [rest.schema[c] for c in names]
        + [T.StructField(c, T.DataType.fromDDL(k)) for c, k in zip(mine, kinds)]
    )
    span_type = pa.list_(
        pa.struct(
            [
                ("lang", pa.string()),
                ("first_word", pa.int32()),
                ("n_words", pa.int32()),
                ("letters", pa.int64()),
            ]
        )
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model
        k = len(m.langs)
        # Scores are words x languages, so pieces shrink where there are many languages.
        most = PIECE_BYTES * BLOCK // max(k, BLOCK)
        for batch, texts in pieces(batches, text_col, most):
            ids, at, vocabulary = words(texts, LETTERS)
            n = len(texts)
            share = np.zeros((n, max(k, 1)))
            found: list[list] = [[] for _ in range(n)]
            if k and len(ids):
                scores, letters = word_scores(m, vocabulary)
                labels = best_paths(scores, ids, at, m.prior)
                size = letters[ids]
                owner = np.repeat(np.arange(n), np.diff(at))
                flat = np.bincount(owner * k + labels, weights=size, minlength=n * k)
                share = flat.reshape(n, k)
                if spans:
                    cut = np.flatnonzero((np.diff(labels) != 0) | (np.diff(owner) != 0)) + 1
                    starts = np.concatenate([[0], cut])
                    ends = np.append(cut, len(ids))
                    totals = np.add.reduceat(size, starts)
                    for a, b, w in zip(starts.tolist(), ends.tolist(), totals.tolist()):
                        if w:
                            d = int(owner[a])
                            found[d].append((m.langs[labels[a]], a - int(at[d]), b - a, w))
            total = share.sum(1)
            best = share.argmax(1)
            pred = [m.langs[b] if t else "und" for b, t in zip(best.tolist(), total.tolist())]
            score = share[np.arange(n), best] / np.maximum(total, 1)
            columns = [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            if spans:
                fields = [f.name for f in span_type.value_type]
                rows = [[dict(zip(fields, s)) for s in one] for one in found]
                columns.append(pa.array(rows, span_type))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *columns], names=[*names, *mine]
            )

    return rest.mapInArrow(label, schema)


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """Whether a row is kept from training, by the CRC of its id; a null id counts as empty."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % mod == remainder


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no language."""
    found = identify(apart(docs, text_col), model, spans=False, keep=["text", "rest"])
    return together(found.where("lang_pred != 'und'"), docs, text_col)
