import random

import pytest
from pyspark.sql import functions as F

from tristrata.operators.quality import profile
from tristrata.sinks.profiles import (
    INCREMENT,
    add_profiles,
    compact_profiles,
    key_overlap,
    merge_states,
    profile_of,
    profile_states,
    read_profiles,
)

SCHEMA = "d int, k bigint, `x.y` double, t string, m map<string, int>"
EXACT = ["column_name", "data_type", "total_rows", "null_rows", "distinct_values", "min_value", "max_value", "avg_value"]


def data(seed, size=300):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, *range(5)]),
            rng.choice([None, rng.randrange(60)]),
            rng.choice([None, float(rng.randrange(-40, 40))]),
            rng.choice([None, "", "é" * rng.randrange(4)]),
            rng.choice([None, {"a": 1}]),
        )
        for _ in range(size)
    ]


@pytest.mark.parametrize("cuts", [(0, 300), (0, 1, 300), (0, 100, 100, 250, 300)])
def test_any_cut_gives_the_profile_of_all_rows(spark, rows, tmp_path, cuts):
    table = data(1)
    path = str(tmp_path / "p")
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        assert add_profiles(path, spark.createDataFrame(table[a:b], SCHEMA), f"i{n}", ["d"])
    got = profile_of(read_profiles(spark, path))
    want = profile(spark.createDataFrame(table, SCHEMA).drop("d"), exact=True)
    # Few distinct values, so the estimate of a HyperLogLog sketch in its sparse form is exact.
    assert rows(got, *EXACT) == rows(want, *EXACT)


def test_a_range_reads_its_own_states(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame(data(2), SCHEMA)
    add_profiles(path, df, "one", ["d"])
    for choice in (F.col("d").between(1, 3), F.col("d").isNull(), F.col("d") == 77):
        got = profile_of(read_profiles(spark, path).filter(choice))
        want = profile(df.filter(choice).drop("d"), exact=True)
        assert rows(got, *[c for c in EXACT if c != "data_type"]) == rows(
            want, *[c for c in EXACT if c != "data_type"]
        )


def test_an_increment_counts_once_and_one_cut_short_is_made_good(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame(data(3), SCHEMA)
    assert add_profiles(path, df, "one", ["d"]) and not add_profiles(path, df, "one", ["d"])
    (tmp_path / "p" / f"{INCREMENT}=one" / "_SUCCESS").unlink()
    assert add_profiles(path, df, "one", ["d"])
    assert profile_of(read_profiles(spark, path)).first().total_rows == 300


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "p")
    add_profiles(path, spark.createDataFrame([(1, 5)], "d int, k bigint"), "one", ["d"])
    add_profiles(path, spark.createDataFrame([(1, 7, "a")], "d int, k bigint, n string"), "two", ["d"])
    got = {r.column_name: r for r in profile_of(read_profiles(spark, path)).collect()}
    assert (got["k"].null_rows, got["k"].min_value, got["k"].max_value) == (0, "5", "7")
    assert (got["n"].total_rows, got["n"].null_rows, got["n"].distinct_values) == (2, 1, 1)


def test_an_empty_table(spark):
    lines = profile_of(profile_states(spark.createDataFrame([], SCHEMA), ["d"])).collect()
    assert [(r.total_rows, r.null_rows, r.distinct_values, r.quantiles) for r in lines] == [
        (0, 0, 0, None), (0, 0, 0, None), (0, 0, 0, None), (0, 0, None, None),
    ]


def test_sketches_of_many_values_are_within_their_bounds(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(50_000, numPartitions=6).select((F.col("id") % 10).alias("d"), "id")
    for n in range(4):
        add_profiles(path, df.filter(F.col("id") % 4 == n), str(n), ["d"], keys=["id"])
    compact_profiles(spark, path, f"{path}-small", ["d"])
    states = read_profiles(spark, f"{path}-small")
    assert states.count() == 10
    line = profile_of(states, (0.1, 0.5, 0.99)).first()
    assert abs(line.distinct_values - 50_000) < 0.04 * 50_000
    for got, q in zip(line.quantiles, (0.1, 0.5, 0.99)):
        assert abs(got / 50_000 - q) < 0.03
    over = key_overlap(states.filter("d < 6"), states.filter("d >= 4"), "id").first()
    assert abs(over.left_keys - 30_000) < 1200 and abs(over.shared_keys - 10_000) < 2000


def test_overlap_of_few_keys_is_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "b"), (2, "c"), (2, "c")], "d int, k string")
    states = profile_states(df, ["d"], keys=["k"])
    assert tuple(key_overlap(states.filter("d = 1"), states.filter("d = 2"), "k").first()) == (2, 2, 1)
    assert tuple(key_overlap(states.filter("d = 1"), states.filter("d = 9"), "k").first()) == (2, 0, 0)


def test_detail_rows_shuffle_as_states_only(spark, plan):
    df = spark.createDataFrame(data(4), SCHEMA)
    text = plan(merge_states(profile_states(df, ["d"])))
    assert "partial_kll_sketch_agg" in text and text.index("partial_kll_sketch_agg") > text.rindex("Exchange hashpartitioning")


def test_clashing_names(spark):
    with pytest.raises(ValueError, match="own"):
        profile_states(spark.createDataFrame([(1, 2)], f"d int, {INCREMENT} int"), ["d"])
