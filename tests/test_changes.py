import random
from datetime import datetime, timedelta

import pytest

from tristrata.streaming.changes import change_feed, rocksdb_state
from tristrata.streaming.run import AVAILABLE_NOW, drain, to_files

SCHEMA = "k string, at timestamp_ntz, n int, v string"
START = datetime(2024, 1, 1)


def run(spark, tmp_path, batches, schema=SCHEMA, watermark=None, **feed):
    """The feed's rows by batch; each batch is a run on the same checkpoint."""
    out = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        if watermark:
            stream = stream.withWatermark(*watermark)
        with rocksdb_state(spark):
            query = to_files(
                change_feed(stream, ["k"], ["at", "n"] if "n int" in schema else ["at"], **feed),
                f"{tmp_path}/out", f"{tmp_path}/cp", trigger=AVAILABLE_NOW,
            )
        drain(query)
        now = sorted((tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=repr)
        before = [r for part in out for r in part]
        for r in before:
            now.remove(r)
        out.append(now)
    return out, query


def test_changes_against_plain_python(spark, tmp_path):
    rng = random.Random(5)
    hours = [None, *[START + timedelta(hours=h) for h in range(6)]]
    keys = ["hot", "hot", None, *"abcdef"]
    batches = [
        [(rng.choice(keys), rng.choice(hours), rng.choice([None, 1, 2]), rng.choice("xyz")) for _ in range(40)]
        for _ in range(3)
    ]
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:3])
    got, _ = run(spark, tmp_path, batches)
    state = {}
    for rows, found in zip(batches, got):
        assert sorted(str(r[1]) for r in found) == sorted({str(r[0]) for r in rows})
        for change, *row in found:
            own = [r for r in rows if r[0] == row[0]]
            best = max(map(order, own))
            assert tuple(row) in own and order(row) == best
            before = state.get(row[0])
            assert change == ("insert" if before is None else "update" if best >= before else "late")
            state[row[0]] = best if before is None else max(best, before)


def test_keys_expire_behind_the_watermark(spark, tmp_path):
    schema = "k string, at timestamp, v string"
    at = lambda h: START + timedelta(hours=h)
    batches = [[("a", at(0), "1"), ("b", at(9), "1")], [("b", at(30), "2")], [("c", at(31), "3")], [("a", at(40), "4")]]
    got, query = run(
        spark, tmp_path, batches, schema, ("at", "1 hour"), clock="at", keep_seconds=12 * 3600
    )
    kinds = [(r[0], r[1], r[3]) for part in got for r in part]
    assert ("expired", "a", "1") in kinds and ("insert", "a", "4") in kinds
    assert ("update", "b", "2") in kinds and ("expired", "b", "1") not in kinds
    # The state holds what has not expired: it falls with the watermark.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 12


def test_a_clock_is_needed_to_forget(spark):
    with pytest.raises(ValueError, match="clock"):
        change_feed(spark.createDataFrame([], SCHEMA), ["k"], ["at"], keep_seconds=5)


def test_the_session_keeps_its_setting(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(name)
        raise KeyError
    assert spark.conf.get(name) == before
