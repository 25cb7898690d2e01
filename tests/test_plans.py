"""What reaches the scan, and what is shuffled, in the plans of the checked queries."""

from pathlib import Path

import pytest

import tristrata
from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("gold_rollup_daily", "struct<ts:timestamp_ntz,user_id:bigint,value:double>"),
        (
            "gold_rollup_monthly",
            "struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>",
        ),
        ("distinct_topics", "struct<event_type:string>"),
        ("dq_duplicates", "struct<user_id:bigint,event_type:string>"),
        ("ts_format", "struct<event_id:bigint,ts:timestamp_ntz>"),
        ("silver_star_expand", "struct<event_id:bigint,event_type:string,props:string>"),
    ],
)
def test_only_the_needed_columns_are_read(spark, plan, name, columns):
    for scan in scans(plan(queries()[name](spark, SF))):
        assert scan.endswith(f"ReadSchema: {columns}")


def test_topic_filter_reaches_the_scan(spark, plan):
    assert "EqualTo(event_type,purchase)" in plan(queries()["topic_filter"](spark, SF))


@pytest.mark.parametrize(
    "name",
    [
        "bronze_envelope", "bronze_bad_times", "route_topics", "message_key", "topic_filter",
        "silver_flatten", "silver_star_expand", "drop_null_keys", "partition_date",
        "audit_columns", "ts_parse", "ts_format", "ts_add", "dq_annotate",
    ],
)
def test_row_wise_queries_do_not_shuffle(spark, plan, name):
    assert "Exchange" not in plan(queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["silver_flatten", "silver_star_expand"])
def test_payload_is_parsed_once(spark, plan, name):
    assert plan(queries()[name](spark, SF)).count("from_json") == 1


def test_each_topic_reads_its_own_directory(spark, plan):
    found = scans(plan(queries()["decode_by_topic"](spark, SF)))
    assert len(found) == 8
    assert all("isnotnull(topic" in scan.split("PartitionFilters")[1] for scan in found)


# One row per topic, each of which gets a query or a plan of its own.
TOPICS = {"plans/queries/streams.py": 1, "plans/queries/silver.py": 1}
# Where the library brings rows to the driver: the count is bounded in each place.
BOUNDED_COLLECTS = {"sources/inference.py": 1, "operators/quality.py": 1, **TOPICS}


def test_rows_stay_on_the_executors():
    root = Path(tristrata.__file__).parent
    for file in root.rglob("*.py"):
        if root / "llm" in file.parents:
            continue
        text = file.read_text()
        for banned in (".rdd", ".toPandas(", "localCheckpoint", "udf(", ".crossJoin(", "broadcast("):
            assert banned not in text, (file, banned)
        name = str(file.relative_to(root))
        assert text.count(".collect()") == BOUNDED_COLLECTS.get(name, 0), name
