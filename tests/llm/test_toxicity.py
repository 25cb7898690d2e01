import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tristrata.llm import langid, toxicity
from tristrata.llm.queries import op13_toxicity

SCHEMA = "doc_id long, text string, lang string, score string, word int"


def corpus(seed=3, size=600):
    """Plain texts, and every third with a bad word now and then."""
    rng = random.Random(seed)
    plain = [f"word{k}" for k in range(60)]
    rows = []
    for k in range(size):
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        if k % 3 == 0:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(["Rotter", "swine!"])
        rows.append((k, " ".join(text), "x", "s", 1))
    return rows


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op13_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    bad = [r for r in rows if r.toxic]
    assert len(bad) > 50 and sum(r.predicted for r in bad) / len(bad) > 0.9
    assert sum(r.predicted for r in rows if not r.toxic) / len(rows) < 0.01
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    held = langid.held_out(F.col("doc_id"), 3, 1)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted(tuple(r) for r in toxicity.classify(docs, labels, held).collect())
    two = sorted(tuple(r) for r in toxicity.classify(docs, turned, held).collect())
    assert [r[0] for r in one] == [r[0] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two])
    right = [r for r in one if r[1] and bool(r[3]) == (r[0] % 3 == 0)]
    assert len(right) / sum(r[1] for r in one) > 0.95


def test_model_against_plain_python(spark):
    rows = corpus(size=150)
    docs = spark.createDataFrame([(r[1], int(r[0] % 3 == 0)) for r in rows], "text string, y int")
    both = toxicity.counted(docs).unionByName(toxicity.counted(docs.withColumn("y", F.lit(None).cast("int"))))
    counts = both.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "docs")])
    own = {0: Counter(), 1: Counter()}
    for k, text, *_ in rows:
        own[int(k % 3 == 0)].update(set(text.lower().replace("!", "").split()))
    words = sorted(own[0] | own[1])
    code = dict(zip(toxicity.codes(pa.array(words)).tolist(), words))
    got = {code[r.word]: r for r in counts.collect()}
    assert {w: (r.toxic, r.ordinary, r.docs) for w, r in got.items()} == {
        w: (own[1][w], own[0][w], own[0][w] + own[1][w]) for w in words
    }
    n = {c: sum(own[c].values()) for c in own}
    small = Counter(own[1].values())
    d = toxicity.discount(small)
    off = {1: d, 0: d * n[0] / n[1]}
    left = {c: {w: max(own[c][w] - off[c], 0) for w in words} for c in own}
    want = {}
    for w in words:
        total = own[0][w] + own[1][w]
        share = n[1] / (n[0] + n[1])
        if (own[1][w] - total * share) ** 2 <= 2 * math.log(len(words)) * total * share * (1 - share):
            continue
        back = toxicity.SHARE * total / (n[0] + n[1])
        p = {c: (1 - toxicity.SHARE) * left[c][w] / sum(left[c].values()) + back for c in own}
        want[w] = math.log(p[1] / p[0])
    found = {code[r.word]: r.weight for r in toxicity.weighted(counts).collect()}
    assert found.keys() == want.keys() and {"rotter", "swine"} <= found.keys()
    assert all(abs(found[w] - want[w]) < 1e-9 for w in want)


@pytest.mark.parametrize("head", [0, 3])
def test_words_beyond_the_broadcast_count_alike(spark, head):
    docs = spark.createDataFrame(corpus(size=90) + [(900, None, None, None, 1), (900, "", None, None, 1)], SCHEMA)
    words = [f"word{k}" for k in range(40)] + ["rotter"]
    codes = toxicity.codes(pa.array(words)).tolist()
    model = spark.createDataFrame([(c, 5 + k, k / 7 - 2) for k, c in enumerate(codes)], "word long, n long, weight double")
    docs = docs.select("doc_id", "text")
    whole = sorted(tuple(r) for r in toxicity.log_ratios(docs, model).collect())
    part = sorted(tuple(r) for r in toxicity.log_ratios(docs, model, head).collect())
    assert [r[:2] for r in whole] == [r[:2] for r in part]
    assert np.allclose([r[2] for r in whole], [r[2] for r in part], atol=1e-6)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "text"), (3, "é"), (3, "é"), (4, "a " * 200_000), (5, "\n\n")]
    docs = spark.createDataFrame([(a, b, None, "clash", 1) for a, b in rows], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels, F.lit(False)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert toxicity.classify(docs.limit(0), labels, F.lit(False)).count() == 0
    none = toxicity.classify(docs, labels.limit(0), F.lit(False)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}


def test_curve_follows_the_shares():
    raw, n = np.repeat([0.0, 0.2], 2), np.array([10.0, 100.0, 10.0, 100.0])
    beta = toxicity.curve(raw, n, np.full(4, 100.0), np.array([2.0, 1.0, 90.0, 99.0]))
    p = 1 / (1 + np.exp(-toxicity.features(raw, n) @ beta))
    assert np.abs(p - [0.02, 0.01, 0.9, 0.99]).max() < 0.05


def neighbours(rows):
    """Pairs of neighbouring words of every text, the start of a text as None."""
    for text, y in rows:
        words = (text or "").lower().replace("!", "").split()
        yield y, list(zip([None, *words], words))


@pytest.mark.parametrize("held, slots", [(1 << 21, 8), (50, 24)])
def test_continuation_and_pair_counts_against_plain_python(spark, monkeypatch, held, slots):
    monkeypatch.setattr(toxicity, "PAIRS", held)
    rows = [(r[1], int(r[0] % 3 == 0)) for r in corpus(size=90)] + [(None, 0), ("", 1), ("Word1 word1", 1)]
    docs = spark.createDataFrame(rows, "text string, y int").repartition(3)
    preceding, own, total = {}, Counter(), Counter()
    for y, pairs in neighbours(rows):
        for v, w in pairs:
            preceding.setdefault(w, set()).add(v)
        own.update((v, w, y) for v, w in set(pairs))
    names = sorted(preceding)
    code = dict(zip([None, *names], [toxicity.START, *toxicity.codes(pa.array(names)).tolist()]))
    got = toxicity.continued(docs, slots).groupBy("word").agg(F.sum("docs")).collect()
    assert {r[0]: r[1] for r in got} == {code[w]: len(v) for w, v in preceding.items()}

    # With nothing asked of chance all pairs come back, beside the sums of their contexts.
    got = toxicity.class_pairs(docs, slots, 1 / 3, -1.0).collect()
    pairs = [r for r in got if r.word is not None]
    assert len(pairs) == len({(v, w) for v, w, _ in own})
    assert {(r.before, r.word): (r.toxic, r.ordinary) for r in pairs} == {
        (code[v], code[w]): (own[v, w, 1], own[v, w, 0]) for v, w, _ in own
    }
    sums = Counter()
    for r in got:
        if r.word is None:
            for c in ("toxic", "ordinary", *toxicity.CONTEXT):
                sums[r.before, c] += r[c]
    for (v, _, y), n in own.items():
        c = "toxic" if y else "ordinary"
        total[code[v], c] += n
        total[code[v], f"kinds_{c}"] += 1
        total[code[v], f"once_{c}"] += n == 1
        total[code[v], f"twice_{c}"] += n == 2
    assert +sums == +total


def test_words_that_are_toxic_in_one_order_only(spark):
    rng = random.Random(8)
    rows = []
    for k in range(900):
        text = [f"word{rng.randrange(60)}" for _ in range(rng.randrange(30, 50))]
        for at in sorted(rng.sample(range(len(text)), 3), reverse=True):
            text[at:at] = ["Filthy", "beast"] if k % 3 == 0 else ["beast", "filthy"]
        rows.append((k, " ".join(text), "x", "s", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    held = langid.held_out(F.col("doc_id"), 3, 1)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    got = [r for r in toxicity.classify(docs, labels, held).collect() if r.held_out]
    assert sum(bool(r.predicted) == (r.doc_id % 3 == 0) for r in got) / len(got) > 0.95


def test_weights_of_pairs(spark):
    rows = [("a b " * 3 + f"c{k}", 1) for k in range(30)] + [(f"b a d{k % 7}", 0) for k in range(60)]
    docs = spark.createDataFrame(rows, "text string, y int")
    every = toxicity.continued(docs, 8)
    counts = toxicity.counted(docs).unionByName(every).groupBy("word")
    counts = counts.agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "docs")])
    a, b = toxicity.codes(pa.array(["a", "b"]))
    p = {r.word: (r.toxic, r.ordinary) for r in toxicity.levels(counts).collect()}
    own = {0: Counter(), 1: Counter()}
    for y, pairs in neighbours(rows):
        own[y].update(set(pairs))
    want = []
    for y, base in ((1, p[b][0]), (0, p[b][1])):
        by = Counter(own[y].values())
        d = toxicity.discount(by)
        after = [n for (v, _), n in own[y].items() if v == "a"]
        left = max(own[y]["a", "b"] - d, 0) + d * len(after) * base
        want.append(left / sum(after))
    found = toxicity.weighted_pairs(docs, counts, 8).collect()
    gram = int(toxicity.pair_codes(np.array([a]), np.array([b]))[0])
    weight = {r.word: r.weight for r in found}[gram]
    assert abs(weight - (math.log(want[0] / want[1]) - math.log(p[b][0] / p[b][1]))) < 1e-9
