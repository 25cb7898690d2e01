import pytest
from pyspark.sql import functions as F

from tristrata.functions.text import EMAIL_PATTERN
from tristrata.operators import quality as q
from tristrata.operators.quality import DataQualityError, QualityPolicy


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (1, "a@x.org", 30),
            (2, "b@x.org", None),
            (3, "no mail", 200),
            (3, None, 40),
        ],
        "id INT, email STRING, age INT",
    )


def test_policy_defaults():
    policy = QualityPolicy.of(None)
    assert policy == QualityPolicy()
    assert (policy.enabled, policy.fail_on_error) == (True, False)
    assert (policy.null_check, policy.format_validation, policy.uniqueness_check) == (
        True, True, False,
    )
    assert (policy.error_rate, policy.completeness, policy.uniqueness) == (0.05, 0.95, 0.95)


def test_policy_settings_override_one_by_one():
    policy = QualityPolicy.of(
        {
            "enabled": False,
            "fail-on-error": True,
            "rules": {"null-check": False, "format-validation": True},
            "thresholds": {"error-rate": 0.1, "completeness": 0.8},
        }
    )
    assert (policy.enabled, policy.fail_on_error) == (False, True)
    assert (policy.null_check, policy.format_validation, policy.uniqueness_check) == (
        False, True, False,
    )
    assert (policy.error_rate, policy.completeness, policy.uniqueness) == (0.1, 0.8, 0.95)


def test_basic_report(people):
    assert q.require_rows(q.basic_report(people)) == (4, 2)


def test_no_rows_is_an_error(people):
    with pytest.raises(DataQualityError, match="No data found to process"):
        q.require_rows(q.basic_report(people.limit(0)))


def test_any_null_needs_columns(spark):
    with pytest.raises(ValueError):
        q.any_null(spark.range(1).select())


def test_completeness(people, rows):
    assert rows(q.completeness(people, 0.8)) == [
        ("*", 12, 10, 10 / 12, True),
        ("age", 4, 3, 0.75, False),
        ("email", 4, 3, 0.75, False),
        ("id", 4, 4, 1.0, True),
    ]


def test_completeness_of_nothing_does_not_pass(people, rows):
    assert {r[3:] for r in rows(q.completeness(people.limit(0)))} == {(None, False)}


def test_uniqueness(people, rows):
    assert rows(q.uniqueness(people, ["id", ("id", "email")], 0.75)) == [
        ("id", 4, 3, 0.75, True),
        ("id,email", 4, 3, 0.75, True),
    ]


def test_format_check(people, rows):
    assert rows(q.format_check(people, {"email": EMAIL_PATTERN})) == [("email", 4, 2, 1, 1)]


def test_range_check(people, rows):
    assert rows(q.range_check(people, {"age": (0, 120), "id": (2, None)})) == [
        ("age", 4, 2, 1, 1),
        ("id", 4, 3, 1, 0),
    ]


def test_custom_check(people, rows):
    assert rows(q.custom_check(people, {"adult": F.expr("age >= 18 AND id > 0")})) == [
        ("adult", 4, 3, 0, 1)
    ]


def test_schema_check(people, rows):
    assert rows(q.schema_check(people, "id INT, email INT, city STRING")) == [
        ("age", None, "int", False),
        ("city", "string", None, False),
        ("email", "int", "string", False),
        ("id", "int", "int", True),
    ]


def test_schema_compliance(spark):
    df = spark.createDataFrame(
        [('{"k": 1}',), ("{}",), ('{"k": "x"}',), ("no json",), (None,)], "value STRING"
    )
    row = q.schema_compliance(df, "k INT", threshold=0.4).first()
    assert tuple(row) == (5, 2, 0.4, True)


def test_duplicates(people, rows):
    assert rows(q.duplicates(people, ["id"])) == [(3, 2)]


@pytest.mark.parametrize("exact", [True, False])
def test_profile(people, rows, exact):
    assert rows(q.profile(people, exact)) == [
        ("age", "int", 4, 1, 3, "30", "200", 90.0),
        ("email", "string", 4, 1, 3, "a@x.org", "no mail", None),
        ("id", "int", 4, 0, 3, "1", "3", 2.25),
    ]


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_nothing(people, rows, exact):
    assert rows(q.profile(people.limit(0).select("id"), exact)) == [
        ("id", "int", 0, 0, 0, None, None, None)
    ]


def test_annotate(people, rows):
    out = q.annotate(people, {"mail": F.col("email").rlike(EMAIL_PATTERN), "age": F.expr("age < 120")})
    assert rows(out, "id", "data_quality_score", "validation_status", "error_message") == [
        (1, 1.0, "valid", None),
        (2, 0.5, "invalid", "age"),
        (3, 0.0, "invalid", "mail; age"),
        (3, 0.5, "invalid", "mail"),
    ]


def test_gate_reports(people, rows):
    report = q.apply_policy(
        people,
        QualityPolicy(uniqueness_check=True, uniqueness=0.75, completeness=0.9),
        formats={"email": EMAIL_PATTERN},
        ranges={"age": (0, 120)},
        unique=["id"],
    )
    assert rows(report) == [
        ("completeness", 10 / 12, 0.9, False),
        ("error_rate", 0.75, 0.05, False),
        ("uniqueness", 0.75, 0.75, True),
    ]


def test_gate_counts_a_null_only_in_the_null_check(people, rows):
    policy = QualityPolicy(null_check=False)
    report = q.apply_policy(people, policy, {"email": EMAIL_PATTERN}, {"age": (0, 120)})
    assert rows(report) == [("error_rate", 0.25, 0.05, False)]


def test_gate_raises_only_when_told(people):
    strict = QualityPolicy(fail_on_error=True)
    with pytest.raises(DataQualityError, match="error_rate"):
        q.apply_policy(people, strict)
    clean = people.filter("id = 1")
    assert all(r.passed for r in q.apply_policy(clean, strict).collect())


def test_disabled_gate_measures_nothing(people):
    policy = QualityPolicy(enabled=False, fail_on_error=True)
    assert q.apply_policy(people, policy).count() == 0


def test_switched_off_rules_do_not_count(people, rows):
    policy = QualityPolicy(
        null_check=False, format_validation=False, range_validation=False, custom_validation=False
    )
    report = q.apply_policy(
        people, policy, {"email": "never"}, {"age": (0, 0)}, {"none": F.lit(False)}
    )
    assert rows(report) == [("error_rate", 0.0, 0.05, True)]


def test_reports_take_one_scan(people, plan, spark, tmp_path):
    people.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    for report in (
        q.basic_report(stored),
        q.completeness(stored),
        q.format_check(stored, {"email": "x"}),
        q.profile(stored),
        q.apply_policy(stored),
    ):
        assert plan(report).count("FileScan") == 1


def test_distinct_counts_read_their_own_columns(people, plan, spark, tmp_path):
    people.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    for report in (q.uniqueness(stored, ["id", "age"]), q.profile(stored, exact=True)):
        text = plan(report)
        assert "ReadSchema: struct<id:int>" in text
        assert "ReadSchema: struct<age:int>" in text
        assert "Expand" not in text


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_columns_that_do_not_compare(spark, rows, exact):
    df = spark.range(2).selectExpr("map('a', id) AS m", "named_struct('x', id) AS s", "id AS `d.o`")
    assert rows(q.profile(df, exact)) == [
        ("d.o", "bigint", 2, 0, 2, "0", "1", 0.5),
        ("m", "map<string,bigint>", 2, 0, None, None, None, None),
        ("s", "struct<x:bigint>", 2, 0, 2, "{0}", "{1}", None),
    ]


def test_names_with_dots(spark, rows):
    df = spark.createDataFrame([(1, None)], "`a.b` INT, `c.d` INT")
    assert q.require_rows(q.basic_report(df)) == (1, 1)
    assert rows(q.completeness(df), "column_name", "non_null_rows") == [
        ("*", 1), ("a.b", 1), ("c.d", 0),
    ]


def test_no_rules_leave_every_row_valid(spark):
    row = q.annotate(spark.range(1), {}).first()
    assert (row.data_quality_score, row.validation_status, row.error_message) == (1.0, "valid", None)


def test_schema_compliance_is_part_of_the_gate(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("no json",)], "value STRING")
    report = {r.metric: (r.value, r.passed) for r in q.apply_policy(df, schema="k INT").collect()}
    assert report["schema_compliance"] == (0.5, False)
    policy = q.QualityPolicy.of({"checks": {"schema-validation": False}, "fail-on-error": True})
    assert "schema_compliance" not in {r.metric for r in q.apply_policy(df, policy, schema="k INT").collect()}
    with pytest.raises(q.DataQualityError, match="schema_compliance"):
        q.apply_policy(df, q.QualityPolicy(fail_on_error=True), schema="k INT")


def test_reports_that_the_policy_switches_on(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    assert q.policy_reports(df, q.QualityPolicy()) == {}
    policy = q.QualityPolicy.of({"checks": {"duplicate-detection": True, "data-profiling": True}})
    reports = q.policy_reports(df, policy)
    assert reports["duplicates"].collect() == [(1, 2)] and reports["profile"].count() == 1
