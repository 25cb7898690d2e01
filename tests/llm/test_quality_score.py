import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tristrata.llm import langid, quality
from tristrata.llm.queries import op3_quality_score

SCHEMA = "doc_id long, text string, lang string, score string, stats int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op3_quality_score(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame([(k, ("good words. " if k % 3 else "BAD!! ") * (1 + k % 7), "x", "s", 1) for k in range(90)], SCHEMA)
    held = langid.held_out(F.col("doc_id"), 3, 1)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    turned = labels.join(docs.select("doc_id", held.alias("h")), "doc_id").select(
        "doc_id", F.when(F.col("h"), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality")
    )
    one = sorted(tuple(r) for r in quality.classify(docs, labels, held).collect())
    two = sorted(tuple(r) for r in quality.classify(docs, turned, held).collect())
    assert [r[:2] + r[3:] for r in one] == [r[:2] + r[3:] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two])
    assert all((r[2] >= 0.5) == bool(r[3]) and 0 <= r[2] <= 1 for r in one)
    assert sum(bool(r[3]) == (r[0] % 3 != 0) for r in one) / len(one) > 0.95


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "text"), (3, "é"), (3, "é"), (4, "a " * 200_000), (5, "\n\n")]
    docs = spark.createDataFrame([(a, b, None, "clash", 1) for a, b in rows], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels, F.lit(False)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(docs.limit(0), labels, F.lit(False)).count() == 0
    none = quality.classify(docs, labels.limit(0), F.lit(False)).collect()
    assert {round(r.score, 2) for r in none} <= {0.5, 0.49, 0.51}


@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_isotonic_curve_rises_and_keeps_the_mean(rows):
    y, w = np.array([a for a, _ in rows]), np.array([b for _, b in rows], float)
    x, level = quality.isotonic(np.arange(len(y), dtype=float), y, w)
    assert (np.diff(level) > 0).all() and (np.diff(x) > 0).all()
    assert level.min() >= y.min() - 1e-9 and level.max() <= y.max() + 1e-9


def test_fourier_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(quality, "FEATURES", 20_000)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 24))
    z = quality.fourier(x, np.zeros(24), np.ones(24))[:, :-1]
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    want = np.exp(-gap / (2 * (quality.WIDTH**2) * 24))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_statistics_of_known_texts():
    got = quality.statistics(pa.array(["", "Ab ab\nAb ab", "x!!"], pa.large_string()))
    at = {name: k for k, name in enumerate(quality.STATISTICS)}
    assert np.isfinite(got).all() and not got[0].any()
    assert got[1, at["distinct words"]] == 0.5 and got[1, at["repeated lines"]] == 0.5
    assert got[1, at["upper case"]] == 0.25 and got[2, at["symbols"]] > 0.6
