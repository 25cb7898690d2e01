import random

import pytest
from pyspark.sql import functions as F

from tristrata.operators.merge import insert_if_absent, newest_per_key, upsert
from tristrata.schemas import TOPIC_REGISTRY, TOPIC_SEEDS
from tristrata.sinks import merge as sink
from tristrata.sinks.merge import merge_partitions, write_target

SCHEMA = "k INT, at INT, v STRING"


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], SCHEMA)
    changes = spark.createDataFrame([(2, 1, "B"), (2, 2, "BB"), (3, 1, "C")], SCHEMA)
    assert rows(upsert(target, changes, ["k"], ["at"])) == [(1, 0, "a"), (2, 2, "BB"), (3, 1, "C")]


def test_upsert_twice_is_upsert_once(spark, rows):
    target = spark.createDataFrame([(1, 0, "a")], SCHEMA)
    changes = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], SCHEMA)
    once = upsert(target, changes, ["k"], ["at"])
    assert rows(upsert(once, changes, ["k"], ["at"])) == rows(once)


def test_null_key_stops_the_job(spark):
    target = spark.createDataFrame([(1, 0, "a")], SCHEMA)
    changes = spark.createDataFrame([(None, 1, "x")], SCHEMA)
    for out in (upsert(target, changes, ["k"], ["at"]), insert_if_absent(target, changes, ["k"])):
        with pytest.raises(Exception, match="null in key column k"):
            out.collect()


def test_against_a_dictionary(spark, rows):
    rng = random.Random(7)
    old = {(k, s): (0, f"old{k}{s}") for k in range(20) for s in "ab" if rng.random() < 0.6}
    changes = [(rng.randrange(25), rng.choice("ab"), i, f"new{i}") for i in range(200)]
    want = dict(old)
    for k, s, at, v in changes:
        want[k, s] = (at, v)
    schema = "k INT, s STRING, at INT, v STRING"
    rng.shuffle(changes)
    out = upsert(
        spark.createDataFrame([(*key, *val) for key, val in old.items()], schema),
        spark.createDataFrame(changes, schema).repartition(5),
        ["k", "s"],
        ["at"],
    )
    assert rows(out) == sorted(((*key, *val) for key, val in want.items()), key=repr)


def test_ties_are_settled_by_the_other_columns(spark, rows):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "c"), (1, 5, "a")], SCHEMA)
    for parts in (1, 3):
        assert rows(newest_per_key(df.repartition(parts), ["k"], ["at"])) == [(1, 5, "c")]


def test_hot_key_shrinks_before_the_shuffle(spark, plan):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("at"),
        F.lit("x").alias("v"),
    )
    out = newest_per_key(df, ["k"], ["at"])
    assert "WindowGroupLimit" in plan(out).split("Exchange")[1]
    assert out.filter("k = 0").first().at == n // 3 - 1
    assert out.count() == n - n // 3 + 1


def test_insert_if_absent(spark, rows):
    target = spark.createDataFrame([(1, 0, "a")], SCHEMA)
    new = spark.createDataFrame([(1, 9, "z"), (2, 1, "b"), (2, 1, "b"), (3, 1, "c")], SCHEMA)
    assert rows(insert_if_absent(target, new, ["k"])) == [(2, 1, "b"), (3, 1, "c")]


def test_topic_seeds_go_in_once(spark, rows):
    seeds = spark.createDataFrame(TOPIC_SEEDS, TOPIC_REGISTRY)
    registry = spark.createDataFrame([("events.user", "v9", "ours")], TOPIC_REGISTRY)
    added = insert_if_absent(registry, seeds, ["topic_name"])
    assert added.count() == 5
    full = registry.union(added)
    assert insert_if_absent(full, seeds, ["topic_name"]).count() == 0
    assert full.filter("topic_name = 'events.user'").first().schema_version == "v9"


PARTED = "p STRING, k INT, at INT, v STRING"


@pytest.fixture
def stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [("x", 1, 0, "a"), ("x", 2, 0, "b"), ("y", 1, 0, "c"), (None, 1, 0, "d")]
    write_target(spark.createDataFrame(rows, PARTED), path, "overwrite", ["p"])
    return path


def merged(spark, path, rows):
    return rows(spark.read.parquet(path), "p", "k", "at", "v")


WANT = [("x", 1, 0, "a"), ("x", 2, 1, "B"), ("y", 1, 0, "c"), ("z", 5, 1, "N"), (None, 1, 0, "d")]
CHANGES = [("x", 2, 1, "B"), ("z", 5, 1, "N")]


def test_merge_touches_its_own_directories(spark, stored, tmp_path, rows):
    before = {f.name for f in (tmp_path / "t" / "p=y").iterdir()}
    changes = spark.createDataFrame(CHANGES, PARTED)
    write_target(changes, stored, "merge", ["p"], ["p", "k"], ["at"])
    assert merged(spark, stored, rows) == sorted(WANT, key=repr)
    assert {f.name for f in (tmp_path / "t" / "p=y").iterdir()} == before


def test_merge_of_no_changes(spark, stored, rows):
    before = merged(spark, stored, rows)
    changes = spark.createDataFrame([], PARTED)
    merge_partitions(stored, changes, ["p", "k"], ["at"], ["p"])
    assert merged(spark, stored, rows) == before


def test_merge_cut_short_is_made_good(spark, stored, tmp_path, rows, monkeypatch):
    """The new rows are written, but the table has lost a directory when the move stops."""
    work = f"{tmp_path}/work"
    changes = spark.createDataFrame(CHANGES, PARTED)
    with monkeypatch.context() as broken:

        def stop(df, keys):
            for file in (tmp_path / "t" / "p=x").iterdir():
                file.unlink()
            raise OSError("driver lost")

        broken.setattr(sink, "gather", stop)
        with pytest.raises(OSError):
            merge_partitions(stored, changes, ["p", "k"], ["at"], ["p"], work)
    assert spark.read.parquet(stored).count() == 2
    merge_partitions(stored, changes, ["p", "k"], ["at"], ["p"], work)
    want = sorted(WANT, key=repr)
    assert merged(spark, stored, rows) == want
    assert not (tmp_path / "work").exists()
    merge_partitions(stored, changes, ["p", "k"], ["at"], ["p"], work)
    assert merged(spark, stored, rows) == want


def test_null_key_leaves_the_table_as_it_is(spark, stored, rows):
    before = merged(spark, stored, rows)
    changes = spark.createDataFrame([(None, 1, 1, "D")], PARTED)
    with pytest.raises(Exception, match="null in key column p"):
        merge_partitions(stored, changes, ["p", "k"], ["at"], ["p"])
    assert merged(spark, stored, rows) == before


def test_partition_must_be_part_of_the_key(spark, stored):
    with pytest.raises(ValueError, match="part of the key"):
        merge_partitions(stored, spark.createDataFrame(CHANGES, PARTED), ["k"], ["at"], ["p"])


def test_write_modes(spark, tmp_path):
    path = f"{tmp_path}/m"
    for mode, count in (("overwrite", 3), ("append", 6), ("Append", 9), ("OVERWRITE", 3)):
        write_target(spark.range(3), path, mode)
        assert spark.read.parquet(path).count() == count
    with pytest.raises(ValueError, match="Unsupported write mode"):
        write_target(spark.range(3), path, "replace")
    with pytest.raises(ValueError, match="merge needs"):
        write_target(spark.range(3), path, "merge")


def test_small_stored_changes_do_not_shuffle_the_target(spark, plan, tmp_path):
    """Spark knows the size of stored changes before it plans the join."""
    spark.createDataFrame([(1, 5)], "k BIGINT, v BIGINT").write.parquet(f"{tmp_path}/c")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        target = spark.range(1_000_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
        changes = spark.read.parquet(f"{tmp_path}/c")
        text = plan(upsert(target, changes, ["k"], ["v"]))
        assert "BroadcastHashJoin" in text
        assert "Range" in text.split("BroadcastExchange")[0]
        assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_changes_are_not_broadcast(spark, plan):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        target = spark.range(1000).selectExpr("id AS k", "id AS v")
        text = plan(upsert(target, target, ["k"], ["v"]))
        assert "BroadcastHashJoin" not in text and "Join" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_directory_names_keep_their_type(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    target = spark.createDataFrame([("007", 1, 0, "a"), ("1e1", 1, 0, "b")], PARTED)
    write_target(target, path, "overwrite", ["p"])
    changes = spark.createDataFrame([("007", 2, 1, "n")], PARTED)
    merge_partitions(path, changes, ["p", "k"], ["at"], ["p"])
    assert sorted(d.name for d in (tmp_path / "t").iterdir() if d.is_dir()) == ["p=007", "p=1e1"]
    back = spark.read.schema(PARTED).parquet(path)
    assert rows(back, "p", "k") == [("007", 1), ("007", 2), ("1e1", 1)]


def test_rows_with_maps(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS at, map('a', id) AS m FROM range(5)")
    for parts in (1, 4):
        assert newest_per_key(df.repartition(parts), ["k"], ["at"]).first().m == {"a": 4}


def test_key_held_many_times_is_reduced_before_the_shuffle(spark, plan):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(3000).select((F.col("id") % 3 * F.col("id")).alias("k"))
        new = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        out = insert_if_absent(target, new, ["k"])
        assert plan(out).count("Exchange hashpartitioning") == 2
        held = {i % 3 * i for i in range(3000)}
        assert {r.k for r in out.collect()} == set(range(100)) - held
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_new_rows_are_read_once(spark, plan, tmp_path):
    spark.range(100).selectExpr("id % 7 AS k", "id AS v").write.parquet(f"{tmp_path}/n")
    target = spark.range(0, 1000, 2).select(F.col("id").alias("k"))
    out = insert_if_absent(target, spark.read.parquet(f"{tmp_path}/n"), ["k"])
    assert sorted(r.k for r in out.collect()) == [1, 3, 5]
    final = plan(out).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and final.count("Range") == 1


def test_late_changes_undo_nothing(spark, rows):
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], SCHEMA)
    changes = spark.createDataFrame([(1, 3, "old"), (2, 5, "tie"), (3, 0, "C"), (4, 1, "new")], SCHEMA)
    want = [(1, 5, "a"), (2, 5, "tie"), (3, 0, "C"), (4, 1, "new")]
    assert rows(upsert(target, changes, ["k"], ["at"])) == want
    plain = [(1, 3, "old"), (2, 5, "tie"), (3, 0, "C"), (4, 1, "new")]
    assert rows(upsert(target, changes, ["k"], [])) == plain


def test_any_order_of_batches_gives_the_same(spark, rows, tmp_path):
    rng = random.Random(9)
    changes = [(rng.choice("xyz"), rng.randrange(4), at, f"v{at}") for at in range(40)]
    want = {}
    for p, k, at, v in changes:
        want[p, k] = (at, v)
    rng.shuffle(changes)
    path = f"{tmp_path}/t"
    for a in range(0, 40, 10):
        df = spark.createDataFrame(changes[a : a + 10], PARTED)
        merge_partitions(path, df, ["p", "k"], ["at"], ["p"])
    assert merged(spark, path, rows) == sorted(((*key, *val) for key, val in want.items()), key=repr)


def test_more_than_a_thousand_directories_are_named_and_no_others_read(spark, plan, tmp_path, rows):
    path, staged = f"{tmp_path}/t", f"{tmp_path}/staged"
    schema = "p INT, k INT, at INT, v STRING"
    many = spark.range(1300).selectExpr("CAST(id AS INT) AS p", "1 AS k", "0 AS at", "'a' AS v")
    many.coalesce(1).write.partitionBy("p").parquet(path)
    changes = many.filter("p < 1100").withColumn("at", F.lit(1))
    changes.coalesce(1).write.partitionBy("p").parquet(staged)
    stored = sink.stored_rows(path, changes, staged, ["p"])
    assert len(stored.inputFiles()) == 1100
    assert stored.schema.simpleString() == spark.createDataFrame([], schema).select("k", "at", "v", "p").schema.simpleString()
    few = sink.stored_rows(path, changes, f"{tmp_path}/none", ["p"])
    assert few.count() == 0
    assert stored.agg(F.min("p"), F.max("p")).first() == (0, 1099)


def test_write_target_is_made_good_with_its_own_folder(spark, stored, tmp_path, rows, monkeypatch):
    changes = spark.createDataFrame(CHANGES, PARTED)
    work = f"{tmp_path}/own"
    with monkeypatch.context() as broken:
        broken.setattr(sink, "discard", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            write_target(changes, stored, "merge", ["p"], ["p", "k"], ["at"], work)
    write_target(changes, stored, "merge", ["p"], ["p", "k"], ["at"], work)
    assert merged(spark, stored, rows) == sorted(WANT, key=repr)
    assert not (tmp_path / "own").exists()
