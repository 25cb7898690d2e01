import random
import uuid

import pytest
from pyspark.sql import functions as F

from tristrata.operators.merge import insert_if_absent, upsert
from tristrata.sinks import bucketed

SCHEMA = "k1 long, k2 string, at int, v string, note string"
KEYS = ["k1", "k2"]


def name():
    return f"b_{uuid.uuid4().hex}"


def change_rows(seed, size=300):
    rng = random.Random(seed)
    # A third of all changes has one key.
    pick = lambda: (0, "hot") if rng.random() < 0.33 else (rng.randrange(40), rng.choice("ab"))
    return [(*pick(), rng.choice([None, rng.randrange(9)]), rng.choice("xyz"), None) for _ in range(size)]


def once(data):
    return list({r[:2]: r for r in data}.values())


def above(plan_text, scan):
    """The operators above the scan of a table, from the plan's indentation."""
    lines = plan_text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    out, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            now = depth(line)
            out.append(line.strip(" :+-*"))
    return out


@pytest.mark.parametrize("stored", [None, 6, 24])
def test_the_stored_side_is_not_shuffled(spark, plan, stored):
    target, news = name(), name()
    bucketed.write_bucketed(spark.createDataFrame(once(change_rows(1)), SCHEMA), target, KEYS, 6)
    changes = spark.createDataFrame(change_rows(2), SCHEMA)
    if stored:
        bucketed.write_bucketed(changes, news, KEYS, stored)
        changes = spark.table(news)
    newest = bucketed.co_located(changes, KEYS, ["at"], 6)
    joined = bucketed.merged(spark.table(target), newest, KEYS, ["at"])
    joined.collect()
    path = above(plan(joined), target)
    assert any("Join" in line for line in path) and not any("Exchange" in line for line in path)


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_the_operator(spark, rows, seed):
    target = spark.createDataFrame(once(change_rows(seed)), SCHEMA)
    table = name()
    bucketed.write_bucketed(target, table, KEYS, 5)
    want = target
    for part in (1, 2):
        changes = spark.createDataFrame(change_rows(10 * seed + part), SCHEMA)
        order = ["at", "v"]
        want = upsert(want, changes, KEYS, order)
        bucketed.upsert_bucketed(spark, table, changes, KEYS, order)
    assert rows(spark.table(table)) == rows(want)
    assert bucketed.bucket_count(spark, table, KEYS) == 5


def test_insert_equals_the_operator(spark, rows):
    target = spark.createDataFrame(once(change_rows(4, 60)), SCHEMA)
    new = spark.createDataFrame(change_rows(5), SCHEMA)
    table = name()
    bucketed.write_bucketed(target, table, KEYS, 5)
    want = target.unionByName(insert_if_absent(target, new, KEYS))
    for _ in range(2):
        bucketed.insert_absent_bucketed(spark, table, new, KEYS)
        assert rows(spark.table(table)) == rows(want)


def test_a_merge_cut_short_between_renamings_is_made_good(spark, rows, monkeypatch):
    table = name()
    bucketed.write_bucketed(spark.createDataFrame([(1, "a", 1, "old", None)], SCHEMA), table, KEYS, 2)
    news = spark.createDataFrame([(1, "a", 2, "new", None), (2, "b", 1, "x", None)], SCHEMA)

    def fail(session, of):
        session.sql(f"DROP TABLE {of}")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(bucketed, "swap", fail)
        with pytest.raises(RuntimeError, match="lost"):
            bucketed.upsert_bucketed(spark, table, news, KEYS, ["at"])
    bucketed.upsert_bucketed(spark, table, news, KEYS, ["at"])
    assert rows(spark.table(table).select("k1", "v")) == [(1, "new"), (2, "x")]


def test_edges(spark, rows):
    table = name()
    bucketed.write_bucketed(spark.createDataFrame([], SCHEMA), table, KEYS, 3)
    bucketed.upsert_bucketed(spark, table, spark.createDataFrame([], SCHEMA), KEYS, ["at"])
    assert spark.table(table).count() == 0
    bucketed.upsert_bucketed(spark, table, spark.createDataFrame([(1, "a", None, None, None)], SCHEMA), KEYS, ["at"])
    assert rows(spark.table(table)) == [(1, "a", None, None, None)]
    with pytest.raises(Exception, match="null in key column k2"):
        bucketed.upsert_bucketed(spark, table, spark.createDataFrame([(1, None, 1, "v", None)], SCHEMA), KEYS, ["at"])
    assert spark.table(table).count() == 1
    with pytest.raises(ValueError, match="not bucketed by k2"):
        bucketed.upsert_bucketed(spark, table, spark.table(table), ["k2"], ["at"])
    # Without an order, and with a key as the order, the change wins.
    for order in ([], ["k1"]):
        bucketed.upsert_bucketed(spark, table, spark.table(table).withColumn("v", F.lit(str(order))), KEYS, order)
        assert spark.table(table).first().v == str(order)
