import numpy as np
import pytest
from pyspark.sql import functions as F

from tristrata.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, idx int"


def filled(sizes, most=3):
    """Targets by the rule, in plain Python."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, left = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        free = left - sum(most * sizes[s] for s in full)
        share = free / (sum(weight[s] for s in rest) or 1)
        more = {s for s in rest if weight[s] * share > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else weight[s] * share for s in names}
        full |= more


def docs(frame):
    rows, k = [], 0
    for source, n, words in [("b", 40, 100), ("a", 3, 50), (None, 30, 90), ("Z", 900, 10), ("é", 1, 7), ("c", 2, 0)]:
        for i in range(n):
            rows.append((k, " ".join(f"w{i}x{j}" for j in range(words)), source, "clash", 1))
            k += 1
    rows += [(k, None, "a", "x", 1), (None, "un deux", "b", "x", 1), (5, rows[5][1], "b", "x", 1)]
    return frame(rows, SCHEMA), rows


def test_mix_follows_the_targets(frame):
    df, rows = docs(frame)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    target = filled(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(target[source])
        assert abs(sum(r.taken for r in own) - target[source]) <= mixing.BLOCK
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    again = mixing.mix(df.repartition(5)).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(got, key=key) == sorted(again, key=key)


def test_mixture_holds_the_words_that_are_taken(frame):
    df, rows = docs(frame)
    slots = mixing.mixture(df, block=32).collect()
    taken = {r.source: 0 for r in slots}
    for r in slots:
        taken[r.source] += len(r.words)
        assert len(r.words) <= 32
    want = {}
    for r in mixing.mix(df, block=32).collect():
        want[r.source] = want.get(r.source, 0) + r.taken
    assert {k: v for k, v in want.items() if v} == taken
    assert max(F.col and r.shard for r in slots) >= 0
    # Each pass over a source takes each block once.
    seen = [(r.source, r.block, r.q) for r in slots]
    assert len(seen) == len(set(seen))


def test_empty_table(frame):
    assert mixing.mix(frame([], SCHEMA)).count() == 0


def test_only_empty_texts(frame):
    got = mixing.mix(frame([(1, "", "a", "x", 1), (2, None, None, "x", 1)], SCHEMA)).collect()
    assert [(r.size, r.taken) for r in got] == [(0, 0), (0, 0)]


def test_permutations():
    for n in (1, 2, 3, 17, 64, 1000):
        at = np.arange(n)
        got = mixing.permuted(at, np.full(n, n), np.full(n, 5, np.uint64))
        assert sorted(got.tolist()) == list(range(n))
    a = mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 5, np.uint64))
    b = mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 6, np.uint64))
    assert (a != b).mean() > 0.9


def test_many_groups_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_AT_ONCE", 4)
    sources = spark.createDataFrame([(k, 10 + k) for k in range(11)], "idx long, n_slots long")
    got = mixing.slots(spark, sources, shard=16).collect()
    assert sorted((r.idx, r.q) for r in got) == [(k, q) for k in range(11) for q in range(10 + k)]
