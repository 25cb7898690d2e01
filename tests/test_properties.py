"""Operators against plain Python on random small inputs."""

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tristrata.operators.gold import period_rollup
from tristrata.operators.merge import insert_if_absent, upsert
from tristrata.operators.quality import apply_policy, completeness, duplicates, profile, uniqueness

few = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
keys = st.integers(0, 6)
maybe = st.none() | st.integers(-3, 3)
times = st.none() | st.integers(0, 200).map(lambda h: datetime(2024, 1, 28) + timedelta(hours=h))


@few
@given(st.lists(st.tuples(times, maybe, maybe), max_size=40))
def test_rollup(spark, sales):
    df = spark.createDataFrame(sales, "created_at TIMESTAMP, amount INT, customer_id INT")
    groups = defaultdict(list)
    for at, amount, customer in sales:
        groups[at and at.replace(day=1, hour=0)].append((amount, customer))
    want = {}
    for period, rows in groups.items():
        amounts = [a for a, _ in rows if a is not None]
        customers = {c for _, c in rows if c is not None}
        stats = [None] * 4
        if amounts:
            stats = [sum(amounts), sum(amounts) / len(amounts), max(amounts), min(amounts)]
        want[period] = (len(rows), *stats, len(customers))
    got = {r.period: tuple(r)[1:7] for r in period_rollup(df, "monthly").collect()}
    assert got == want


@few
@given(
    st.dictionaries(keys, st.integers(0, 9), max_size=6),
    st.lists(st.tuples(keys, st.integers(0, 5), st.integers(0, 9)), max_size=25),
)
def test_upsert_and_insert(spark, target, changes):
    schema = "k INT, at INT, v INT"
    stored = spark.createDataFrame([(k, -1, v) for k, v in target.items()], schema)
    incoming = spark.createDataFrame(changes, schema).repartition(3)
    newest = {}
    for k, at, v in changes:
        newest[k] = max(newest.get(k, (at, v)), (at, v))
    want = {k: (-1, v) for k, v in target.items()} | newest
    out = upsert(stored, incoming, ["k"], ["at"]).collect()
    assert len(out) == len(want) and {r.k: (r.at, r.v) for r in out} == want
    added = [r.k for r in insert_if_absent(stored, incoming, ["k"]).collect()]
    assert sorted(added) == sorted(set(newest) - set(target))


@few
@given(st.lists(st.tuples(maybe, maybe), min_size=1, max_size=30))
def test_reports(spark, data):
    df = spark.createDataFrame(data, "a INT, b INT")
    a, b = [x for x, _ in data if x is not None], [y for _, y in data if y is not None]
    n = len(data)
    filled = {r.column_name: r.non_null_rows for r in completeness(df).collect()}
    assert filled == {"a": len(a), "b": len(b), "*": len(a) + len(b)}
    pairs = {(x, y) for x, y in data if x is not None and y is not None}
    distinct = {r.column_name: r.distinct_values for r in uniqueness(df, ["a", ("a", "b")]).collect()}
    assert distinct == {"a": len(set(a)), "a,b": len(pairs)}
    copies = {(r.a, r.b): r.copies for r in duplicates(df, ["a", "b"]).collect()}
    assert copies == {p: data.count(p) for p in data if data.count(p) > 1}
    for row, values in zip(sorted(profile(df, exact=True).collect()), (a, b)):
        assert (row.null_rows, row.distinct_values) == (n - len(values), len(set(values)))
        assert row.min_value == (str(min(values)) if values else None)
        assert row.max_value == (str(max(values)) if values else None)
    bad = sum(x is None or y is None or not 0 <= x <= 2 for x, y in data)
    gate = {r.metric: r.value for r in apply_policy(df, ranges={"a": (0, 2)}).collect()}
    assert gate == {"error_rate": bad / n, "completeness": (len(a) + len(b)) / (2 * n)}
