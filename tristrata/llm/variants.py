"""Spelling variants: words one edit apart, found on the frontier of a relational trie.

The words are the paths of a trie, kept as a table of edges ``node, label, child``; chains without a
branch or the end of a word are one edge. A state is a word, a position in it, a node and a number
of edits. At first every word stands, without edits, on the nodes of its own path. Joining
the states with the edges of their nodes gives, where an edge begins with another letter than
the word goes on with, the states after one replaced or inserted letter; joined with the edges
again and again, level by level, they follow the rest of their word, and the states that reach the
end of their word at the end of another are neighbours. Deleted letters are the other word's
inserted ones, so that no state is needed for them.

An edit is made where two words first differ. If that is in the first half of the word, the words
agree in the second half: a second trie, of the reversed words, finds these. So edits begin only
below half of a word, where nodes have few children, never at the root, where every word would branch
into all letters. The number of levels follows the branches below the longest common part, not
the length of words.

Defined results: null and empty texts have no words; a null document id is written as nothing;
repeated rows and equal ids count like any others; ties go to the smallest word in code-point order;
an empty table gives no words; other columns are not looked at; a word of any length is one.
Only the edges' nodes are hashes: neighbours are confirmed on their letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.common import lower_ascii
from tristrata.scratch import staged

#: A run of letters, once A-Z are lower-cased.
RUN = "[a-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_TIMES = 5, 3
#: Of so many runs one loses a letter, chosen by the crc32 of its document and itself.
SPOILT = 97
END = -1


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: int = LEAST_LETTERS,
    times: int = LEAST_TIMES,
) -> DataFrame:
    """``word, n`` of the words of at least so many letters and occurrences."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(
        F.concat(name, F.lit(":")).alias("of"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(RUN), F.lit(0))).alias("run"),
    )
    code = F.crc32(F.concat("of", "run").cast("binary"))
    runs = runs.select("run", code.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    spoilt = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % SPOILT == 0, spoilt).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= letters).groupBy("word")
    return words.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefixes(words: list[str], side: int) -> tuple[np.ndarray, ...]:
    """For each word and each length of a prefix from just below half of the word to all of it: the
    word's place, the length, the prefix's hash, and the letter that follows (or ``END``)."""
    size = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-size, kind="stable")
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    low = (size - 1) // 2
    node = np.full(len(words), 0x9E3779B97F4A7C15 + side, np.uint64)
    out = []
    for depth in range(int(size.max(initial=0)) + 1):
        live = order[: np.searchsorted(-size[order], -depth, "right")]
        going = live[size[live] > depth]
        letter = np.full(len(words), END, np.int64) if depth == 0 else letter
        letter[live] = END
        letter[going] = flat[begin[going] + depth]
        shown = live[low[live] <= depth]
        out.append((shown, np.full(len(shown), depth), node[shown], letter[shown]))
        node[going] = mixed(node[going] * np.uint64(0x9E3779B97F4A7C15) + letter[going].astype(np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out))


def paths(words: DataFrame) -> DataFrame:
    """``side, id, pos, node, letter`` of all prefixes, on both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A long word is worked on with few others.
            size = np.cumsum(np.maximum([len(w) for w in batch.column("word").to_pylist()], 64))
            cuts = [0, *(np.flatnonzero(np.diff(size // (1 << 17))) + 1).tolist(), batch.num_rows]
            for part in (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a):
                own = part.column("word").to_pylist()
                ids = part.column("id").to_numpy()
                for side in (0, 1):
                    found = prefixes(own if side == 0 else [w[::-1] for w in own], side)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(found[0]), side, np.int32)),
                            pa.array(ids[found[0]]),
                            pa.array(found[1].astype(np.int32)),
                            pa.array(found[2].astype(np.int64)),
                            pa.array(found[3].astype(np.int32)),
                        ],
                        names=["side", "id", "pos", "node", "letter"],
                    )

    return words.select("id", "word").mapInArrow(
        run, "side int, id long, pos int, node long, letter int"
    )


def routes(words: DataFrame) -> DataFrame:
    """``side, id, text, stops`` of every word: the nodes of its path where the trie branches or
    a word ends, with their positions; on side 1 the text is reversed."""
    steps = staged(paths(words), "prefixes")
    forks = steps.groupBy("node").agg(F.min("letter").alias("a"), F.max("letter").alias("b"))
    forks = forks.where("a != b").select("node")
    stops = steps.where(F.col("letter") == END).unionByName(
        steps.where(F.col("letter") != END).join(forks, "node", "left_semi").select(steps.columns)
    )
    stops = stops.groupBy("side", "id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("stops")
    )
    text = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    return stops.join(words.select("id", "word"), "id").select("side", "id", text.alias("text"), "stops")


def edge_table(routes: DataFrame) -> DataFrame:
    """``node, label, child, word``: the edges of both tries, with the word that ends at the child."""
    last = F.size("stops")
    hops = F.arrays_zip(
        F.slice("stops", F.lit(1), last - 1).alias("a"), F.slice("stops", F.lit(2), last - 1).alias("b")
    )
    hop = routes.where(last > 1).select("id", "text", F.char_length("text").alias("size"), F.explode(hops).alias("e"))
    edges = hop.select(
        F.col("e.a.node").alias("node"),
        F.substring("text", F.col("e.a.pos") + 1, F.col("e.b.pos") - F.col("e.a.pos")).alias("label"),
        F.col("e.b.node").alias("child"),
        F.when(F.col("e.b.pos") == F.col("size"), F.col("id")).alias("word"),
    )
    return edges.groupBy("node", "child").agg(F.first("label").alias("label"), F.max("word").alias("word"))


def first_states(routes: DataFrame) -> DataFrame:
    """``id, node, edits, rest``: every word on the nodes of its own path below its half."""
    size = F.char_length("text")
    half = F.floor((size + F.col("side")) / 2)
    stop = routes.select("id", "text", half.alias("half"), F.explode("stops").alias("s"))
    return stop.where("s.pos >= half").select(
        "id",
        F.col("s.node").alias("node"),
        F.lit(0).alias("edits"),
        F.substring("text", F.col("s.pos") + 1, F.char_length("text")).alias("rest"),
    )


def edited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one edit: the edge's first letter replaces the word's next one, or comes
    before it, and the edge's other letters follow the word. Of two words that a replaced letter
    tells apart, the one with the smaller letter finds the other."""
    tail = F.substring("label", F.lit(2), F.char_length("label"))
    more = F.char_length(tail)
    next_, first = F.substring("rest", F.lit(1), F.lit(1)), F.substring("label", F.lit(1), F.lit(1))
    replaced = (F.col("rest") != "") & (first > next_)
    replaced &= F.substring("rest", F.lit(2), more) == tail
    inserted = (first != next_) & (F.substring("rest", F.lit(1), more) == tail)
    rests = F.array(
        F.when(replaced, F.substring("rest", more + 2, F.char_length("rest"))),
        F.when(inserted, F.substring("rest", more + 1, F.char_length("rest"))),
    )
    moved = states.join(edges, "node").select(
        "id", F.col("child").alias("node"), "word", F.explode(rests).alias("rest")
    )
    return moved.where("rest IS NOT NULL").select("id", "node", F.lit(1).alias("edits"), "rest", "word")


def followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge further, where its label is what the word goes on with."""
    letter = F.substring("label", F.lit(1), F.lit(1))
    moved = states.withColumn("letter", F.substring("rest", F.lit(1), F.lit(1))).join(
        edges.withColumn("letter", letter), ["node", "letter"]
    )
    moved = moved.where(F.col("rest").startswith(F.col("label")))
    rest = F.substring("rest", F.char_length("label") + 1, F.char_length("rest"))
    return moved.select("id", F.col("child").alias("node"), "edits", rest.alias("rest"), "word")


def neighbours(words: DataFrame) -> DataFrame:
    """``a, b``: the ids of words (``id, word``) that are one edit apart, each pair once."""
    own = staged(routes(words), "routes")
    edges = staged(edge_table(own), "edges")
    now = staged(edited(first_states(own), edges), "states")
    found = []
    while True:
        found.append(now.where("rest = '' AND word IS NOT NULL").select("id", "word"))
        going = now.where("rest != ''").drop("word")
        if going.isEmpty():
            break
        now = staged(followed(going, edges), "states")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.select(F.least("id", "word").alias("a"), F.greatest("id", "word").alias("b")).distinct()


def roots(links: DataFrame) -> DataFrame:
    """``id, root``: where the links ``id, form`` lead to in the end, by doubling steps."""
    links = staged(links.select("id", "form"), "links")
    now = links.withColumnRenamed("form", "root")
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = now.join(step, "root", "left")
        moved = staged(
            further.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if moved.where("moved").isEmpty():
            return moved.select("id", "root")
        now = moved.select("id", "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    counts = word_counts(docs, id_col, text_col)
    words = staged(counts.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = neighbours(words)
    for end in ("a", "b"):
        of = words.select(F.col("id").alias(end), F.col("word").alias(f"word_{end}"), F.col("n").alias(f"n_{end}"))
        pairs = pairs.join(of, end)
    pairs = staged(pairs.where(F.levenshtein("word_a", "word_b", 1) == 1), "pairs")
    ways = [
        pairs.select(
            F.col(x).alias("id"),
            F.struct((-F.col(f"n_{y}")).alias("less"), F.col(f"word_{y}").alias("word"), F.col(y).alias("id")).alias("near"),
        )
        for x, y in (("a", "b"), ("b", "a"))
    ]
    near = ways[0].unionByName(ways[1]).groupBy("id")
    near = near.agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    formed = F.col("n_best") >= 2 * F.col("n")
    best = staged(
        words.join(near, "id", "left")
        .withColumn("n_best", -F.col("best.less"))
        .select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, F.col("best.word")).alias("form"),
            F.when(formed, F.col("n_best")).alias("form_n"),
            F.when(formed, F.col("best.id")).alias("form_id"),
        ),
        "forms",
    )
    ends = roots(best.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    ends = ends.join(names, "root").select("id", "root_word")
    return best.join(ends, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
