import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tristrata.operators.gold import period_rollup
from tristrata.plans import jobs
from tristrata.sinks import rollups
from tristrata.sinks.rollups import apply_increment, increment_states, read_rollup

SCHEMA = "created_at timestamp_ntz, amount bigint, customer_id bigint"


def sales(seed, days=5, size=200):
    rng = random.Random(seed)
    start = datetime(2024, 2, 27)
    return [
        (
            rng.choice([None, *[start + timedelta(days=rng.randrange(days), hours=rng.randrange(24))] * 9]),
            rng.choice([None, rng.randrange(-50, 1000)]),
            rng.choice([None, rng.randrange(5), -rng.randrange(9), 10**15 + rng.randrange(40_000)]),
        )
        for _ in range(size)
    ]


@pytest.mark.parametrize("kind", ["hourly", "daily", "monthly", "weekly"])
def test_any_cut_into_increments_gives_the_one_rollup(spark, rows, tmp_path, kind):
    data = sales(len(kind))
    path = str(tmp_path / "states")
    for number, part in enumerate((data[:90], data[90:91], data[91:])):
        assert apply_increment(path, spark.createDataFrame(part, SCHEMA), f"i{number}", kind)
    got = read_rollup(spark, path, kind).drop("generated_at")
    want = period_rollup(spark.createDataFrame(data, SCHEMA), kind).drop("generated_at")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_an_increment_counts_once(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    df = spark.createDataFrame(sales(7), SCHEMA)
    assert apply_increment(path, df, "one")
    once = rows(read_rollup(spark, path).drop("generated_at"))
    assert not apply_increment(path, df, "one")
    assert rows(read_rollup(spark, path).drop("generated_at")) == once
    assert apply_increment(path, df, "two")
    assert rows(read_rollup(spark, path).select("total_records")) == sorted((2 * r[1],) for r in once)


def test_an_increment_that_was_cut_short_is_made_good(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "states")
    data = sales(8)
    apply_increment(path, spark.createDataFrame(data[:100], SCHEMA), "one")
    news = spark.createDataFrame(data[100:], SCHEMA)
    for step in ("gather", "discard"):
        with monkeypatch.context() as patch:
            calls = []

            def fail(*args):
                calls.append(args)
                if step == "discard" or len(calls) == 2:
                    raise RuntimeError("lost")
                return args[0].hint("rebalance", *args[1])

            patch.setattr(rollups, step, fail)
            with pytest.raises(RuntimeError, match="lost"):
                apply_increment(path, news, f"two-{step}")
        assert apply_increment(path, news, f"two-{step}") == (step == "gather")
        # Each of the two counts once.
        data = data + data[100:] if step == "discard" else data
        want = period_rollup(spark.createDataFrame(data, SCHEMA)).drop("generated_at")
        assert rows(read_rollup(spark, path).drop("generated_at")) == rows(want)


def test_only_the_days_of_an_increment_are_read_and_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "states")
    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    apply_increment(path, spark.createDataFrame([(d, 1, 1) for d in days], SCHEMA), "one")
    before = {p: p.stat().st_mtime_ns for p in Path(path).glob("period_day=*/*.parquet")}
    read = []
    kept = rollups.stored_rows

    def watched(*args):
        read.append(kept(*args))
        return read[-1]

    monkeypatch.setattr(rollups, "stored_rows", watched)
    apply_increment(path, spark.createDataFrame([(days[1], 5, 2), (days[1], 5, 1)], SCHEMA), "two")
    assert {Path(f).parent.name for f in read[0].inputFiles()} == {"period_day=2024-01-02"}
    after = {p: p.stat().st_mtime_ns for p in Path(path).glob("period_day=*/*.parquet")}
    same = {p.parent.name for p in before if after.get(p) == before[p]}
    assert same == {"period_day=2024-01-01", "period_day=2024-01-03"}
    got = {r.period: (r.total_records, r.unique_customers) for r in read_rollup(spark, path).collect()}
    assert got == {days[0]: (1, 1), days[1]: (3, 2), days[2]: (1, 1)}


def test_states_are_combined_before_the_shuffle(spark, plan):
    text = plan(increment_states(spark.createDataFrame(sales(1), SCHEMA)))
    assert "partial_bitmap_construct_agg" in text and "partial_sum" in text


def test_text_customers_and_empty_increments(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    data = [(datetime(2024, 1, 1), 5, c) for c in ("a", "b", "a", None)]
    schema = SCHEMA.replace("customer_id bigint", "customer_id string")
    for number, part in enumerate((data[:2], [], data[2:])):
        apply_increment(path, spark.createDataFrame(part, schema), str(number))
    assert rows(read_rollup(spark, path).select("total_records", "unique_customers")) == [(4, 2)]


def test_job(spark, rows, tmp_path):
    for number, part in enumerate((sales(1), sales(2))):
        spark.createDataFrame(part, SCHEMA).write.parquet(str(tmp_path / f"in{number}"))
        args = (str(tmp_path / f"in{number}"), f"day-{number}", str(tmp_path / "s"), str(tmp_path / "out"))
        assert jobs.aggregate_increment(spark, *args) and not jobs.aggregate_increment(spark, *args)
    got = spark.read.parquet(str(tmp_path / "out" / "daily")).agg(F.sum("total_records"))
    assert rows(got) == [(400,)]
