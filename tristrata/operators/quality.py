"""Data quality: checks, reports, the policy that gates a job, and row annotation.

A report is one aggregation over its input, whatever the number of columns or rules; only
exact distinct counts read their own columns once more.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from tristrata.operators.silver import decode_payload
from tristrata.schemas import CORRUPT, orderable, struct


class DataQualityError(RuntimeError):
    """The data does not meet the policy."""


@dataclass(frozen=True)
class QualityPolicy:
    """Which checks run and what they must reach. The defaults are fixed values.

    ``apply_policy`` measures against the thresholds; ``policy_reports`` gives the reports that
    ``duplicate_detection`` and ``data_profiling`` ask for.
    """

    enabled: bool = True
    fail_on_error: bool = False
    null_check: bool = True
    format_validation: bool = True
    range_validation: bool = True
    custom_validation: bool = True
    uniqueness_check: bool = False
    schema_validation: bool = True
    duplicate_detection: bool = False
    data_profiling: bool = False
    error_rate: float = 0.05
    completeness: float = 0.95
    uniqueness: float = 0.95
    schema_compliance: float = 0.95

    @classmethod
    def of(cls, settings: Mapping | None) -> QualityPolicy:
        """From nested settings with dashed names; what is not set keeps its default."""
        flat: dict = {}
        for key, value in (settings or {}).items():
            flat.update(value if isinstance(value, Mapping) else {key: value})
        settings = {k.replace("-", "_"): v for k, v in flat.items()}
        return cls(**{k: v for k, v in settings.items() if k in cls.__dataclass_fields__})


def any_null(df: DataFrame, columns: list[str] | None = None) -> Column:
    """True for a row with a null in any of the columns, by default all."""
    names = df.columns if columns is None else columns
    if not names:
        raise ValueError("no columns to test for nulls")
    return reduce(or_, [named(c).isNull() for c in names])


def named(column: str) -> Column:
    """The column of exactly this name, also when it has a dot in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def _holds(rule: Column) -> Column:
    """A rule that comes out null does not hold."""
    return F.coalesce(rule, F.lit(False))


def as_rows(*structs: Column) -> Column:
    return F.inline(F.array(*structs))


def basic_report(df: DataFrame) -> DataFrame:
    """Row count and count of rows with a null, in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(any_null(df)).alias("records_with_nulls"),
    )


def require_rows(report: DataFrame) -> tuple[int, int]:
    """The two numbers of a basic report; an empty input is an error."""
    total, with_nulls = report.first()
    if total == 0:
        raise DataQualityError("No data found to process")
    return total, with_nulls


def completeness(
    df: DataFrame, threshold: float = 0.95, columns: list[str] | None = None
) -> DataFrame:
    """Share of non-null values per column, and over all of them under the name ``*``."""
    names = df.columns if columns is None else columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(named(c)).alias(f"_{i}") for i, c in enumerate(names)],
    )
    filled = [F.col(f"_{i}") for i in range(len(names))]
    lines = [(c, F.col("_n"), n) for c, n in zip(names, filled)]
    lines.append(("*", F.col("_n") * len(names), reduce(lambda a, b: a + b, filled)))
    report = counts.select(
        as_rows(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    total.alias("total_rows"),
                    n.alias("non_null_rows"),
                )
                for name, total, n in lines
            ]
        )
    )
    return _against(report, "non_null_rows", "completeness", threshold)


def _against(report: DataFrame, part: str, into: str, threshold: float) -> DataFrame:
    rate = F.try_divide(F.col(part), F.col("total_rows"))
    return report.withColumn(into, rate).withColumn(
        "passed", F.coalesce(F.col(into) >= threshold, F.lit(False))
    )


def uniqueness(
    df: DataFrame, keys: list[str | tuple[str, ...]], threshold: float = 0.95
) -> DataFrame:
    """Distinct values over rows, exactly, per column or per tuple of columns.

    Each key is counted on its own and reads its own columns only. Counting all of them in
    one aggregation would shuffle every row once per key with all the keys' columns. On an
    input that is not columnar, or is itself computed, write it to Parquet once and pass that:
    otherwise each key parses or computes all of it again.
    """
    groups = [(k,) if isinstance(k, str) else tuple(k) for k in keys]
    reports = [
        df.agg(
            F.lit(",".join(g)).alias("column_name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(*[named(c) for c in g]).alias("distinct_values"),
        )
        for g in groups
    ]
    return _against(_stacked(reports), "distinct_values", "uniqueness", threshold)


def _stacked(reports: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionAll(b), reports)


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows per rule that pass, that fail, and where the rule is null."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            agg
            for i, rule in enumerate(rules.values())
            for agg in (
                F.count_if(rule).alias(f"_ok{i}"),
                F.count_if(rule.isNull()).alias(f"_na{i}"),
            )
        ],
    )
    return counts.select(
        as_rows(
            *[
                F.struct(
                    F.lit(name).alias("rule"),
                    F.col("_n").alias("total_rows"),
                    F.col(f"_ok{i}").alias("passed_rows"),
                    (F.col("_n") - F.col(f"_ok{i}") - F.col(f"_na{i}")).alias("failed_rows"),
                    F.col(f"_na{i}").alias("null_rows"),
                )
                for i, name in enumerate(rules)
            ]
        )
    )


def format_rules(formats: dict[str, str]) -> dict[str, Column]:
    return {c: F.col(c).rlike(pattern) for c, pattern in formats.items()}


def range_rules(ranges: dict[str, tuple]) -> dict[str, Column]:
    """Bounds are inclusive; ``None`` leaves a side open."""
    rules = {}
    for c, (low, high) in ranges.items():
        inside = F.col(c).isNotNull() if low is None else F.col(c) >= F.lit(low)
        rules[c] = inside if high is None else inside & (F.col(c) <= F.lit(high))
    return rules


def format_check(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """Column -> regular expression. Nulls are counted apart: they are the null check's matter."""
    return rule_report(df, format_rules(formats))


def range_check(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    return rule_report(df, range_rules(ranges))


def custom_check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return rule_report(df, rules)


def schema_check(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Expected against actual columns. Reads no data."""
    expected = {f.name: f.dataType.simpleString() for f in struct(schema).fields}
    actual = dict(df.dtypes)
    rows = [
        (name, expected.get(name), actual.get(name), expected.get(name) == actual.get(name))
        for name in [*expected, *[c for c in actual if c not in expected]]
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name STRING, expected_type STRING, actual_type STRING, passed BOOLEAN"
    )


def schema_compliance(
    df: DataFrame, schema: str | StructType, column: str = "value", threshold: float = 0.95
) -> DataFrame:
    """Share of payloads that parse under the schema; a null payload does not."""
    parsed = decode_payload(df.select(column), schema, column, "_data", keep_corrupt=True)
    good = F.col(column).isNotNull() & F.col(f"_data.{CORRUPT}").isNull()
    report = parsed.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(good).alias("compliant_rows")
    )
    return _against(report, "compliant_rows", "schema_compliance", threshold)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, nulls, distinct values, least and greatest (as text), average.

    Distinct values are estimated in one scan of all columns, with nothing but one row per
    task to shuffle. ``exact`` counts how often each value occurs instead, column by column:
    each column is read on its own, and a value is shuffled once per task at most; write an
    input that is not columnar to Parquet first, or each column parses all of it again. Columns
    that Spark cannot compare, such as maps, get their nulls counted only.
    """
    fields = df.schema.fields
    if exact:
        return _stacked([_exact_profile(df, f) for f in fields])
    measures = {"_n": F.count(F.lit(1))}
    lines = []
    for i, f in enumerate(fields):
        value = named(f.name)
        mine = {"filled": F.count(value)}
        if orderable(f.dataType):
            distinct = F.approx_count_distinct(value)
            mine |= {"distinct": distinct, "min": F.min(value), "max": F.max(value)}
        if isinstance(f.dataType, NumericType):
            mine["avg"] = F.avg(value)
        measures |= {f"_{part}{i}": agg for part, agg in mine.items()}
        lines.append(profile_line(f, F.col("_n"), {part: F.col(f"_{part}{i}") for part in mine}))
    totals = df.agg(*[agg.alias(name) for name, agg in measures.items()])
    return totals.select(as_rows(*lines))


def _exact_profile(df: DataFrame, field: StructField) -> DataFrame:
    if not orderable(field.dataType):
        return profile(df.select(named(field.name)))
    values = df.groupBy(named(field.name).alias("_v")).agg(F.count(F.lit(1)).alias("_times"))
    value, times = F.col("_v"), F.col("_times")
    mine = {
        "filled": F.coalesce(F.sum(F.when(value.isNotNull(), times)), F.lit(0)),
        "distinct": F.count(value),
        "min": F.min(value),
        "max": F.max(value),
    }
    if isinstance(field.dataType, NumericType):
        mine["sum"] = F.sum(value.cast("double") * times)
    totals = values.agg(
        F.coalesce(F.sum(times), F.lit(0)).alias("_n"), *[agg.alias(k) for k, agg in mine.items()]
    )
    parts = {k: F.col(k) for k in mine}
    if "sum" in parts:
        parts["avg"] = F.try_divide(parts.pop("sum"), parts["filled"])
    return totals.select(as_rows(profile_line(field, F.col("_n"), parts)))


def profile_line(field: StructField, rows: Column, parts: dict[str, Column]) -> Column:
    nothing = F.lit(None)
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("data_type"),
        rows.alias("total_rows"),
        (rows - parts["filled"]).alias("null_rows"),
        parts.get("distinct", nothing).cast("bigint").alias("distinct_values"),
        parts.get("min", nothing).cast("string").alias("min_value"),
        parts.get("max", nothing).cast("string").alias("max_value"),
        parts.get("avg", nothing).cast("double").alias("avg_value"),
    )


def annotate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Score each row by the share of rules that hold, with its status and the failed rules.

    Without rules every row is valid.
    """
    if not rules:
        perfect = {"data_quality_score": F.lit(1.0), "validation_status": F.lit("valid")}
        return df.withColumns(perfect | {"error_message": F.lit(None).cast("string")})
    failed = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(n)) for n, r in rules.items()]))
    count = F.size("_failed")
    return (
        df.withColumn("_failed", failed)
        .withColumns(
            {
                "data_quality_score": (F.lit(len(rules)) - count) / F.lit(float(len(rules))),
                "validation_status": F.when(count == 0, "valid").otherwise("invalid"),
                "error_message": F.when(count > 0, F.concat_ws("; ", "_failed")),
            }
        )
        .drop("_failed")
    )


def _line(metric: str, value: Column, limit: float, at_least: bool = True) -> Column:
    met = value >= limit if at_least else value <= limit
    return F.struct(
        F.lit(metric).alias("metric"),
        value.alias("value"),
        F.lit(float(limit)).alias("threshold"),
        F.coalesce(met, F.lit(False)).alias("passed"),
    )


_REPORT = "metric STRING, value DOUBLE, threshold DOUBLE, passed BOOLEAN"


def apply_policy(
    df: DataFrame,
    policy: QualityPolicy = QualityPolicy(),
    formats: dict[str, str] | None = None,
    ranges: dict[str, tuple] | None = None,
    custom: dict[str, Column] | None = None,
    unique: list[str] | None = None,
    schema: str | StructType | None = None,
    payload: str = "value",
) -> DataFrame:
    """Measure the rows against the policy, one line per metric.

    One scan gives the error rate and completeness; uniqueness, if asked for, reads its key
    columns again and shuffles nothing else. With a ``schema`` the share of payloads that parse
    under it is measured, too, from the payload column.

    A row is bad if a switched-on rule fails on it; a null fails the null check only. When
    ``fail_on_error`` is set a missed threshold raises ``DataQualityError``. A policy that is
    not enabled measures nothing.
    """
    if not policy.enabled:
        return df.sparkSession.createDataFrame([], _REPORT)
    failures = [any_null(df)] if policy.null_check else []
    for switched_on, rules in (
        (policy.format_validation, format_rules(formats or {})),
        (policy.range_validation, range_rules(ranges or {})),
        (policy.custom_validation, custom or {}),
    ):
        if switched_on:
            failures += [F.coalesce(~rule, F.lit(False)) for rule in rules.values()]
    bad = reduce(or_, failures) if failures else F.lit(False)
    aggregates = {"_n": F.count(F.lit(1)), "_bad": F.count_if(bad)}
    rows = F.col("_n").cast("double")
    lines = [_line("error_rate", F.try_divide("_bad", rows), policy.error_rate, at_least=False)]
    if policy.null_check:
        aggregates["_filled"] = reduce(lambda a, b: a + b, [F.count(named(c)) for c in df.columns])
        share = F.try_divide("_filled", rows * len(df.columns))
        lines.append(_line("completeness", share, policy.completeness))
    report = df.agg(*[agg.alias(name) for name, agg in aggregates.items()]).select(as_rows(*lines))
    if policy.uniqueness_check and unique:
        share = F.col("uniqueness")
        distinct = uniqueness(df, [tuple(unique)], policy.uniqueness)
        report = report.unionAll(
            distinct.select(as_rows(_line("uniqueness", share, policy.uniqueness)))
        )
    if policy.schema_validation and schema is not None:
        share = F.col("schema_compliance")
        good = schema_compliance(df, schema, payload, policy.schema_compliance)
        report = report.unionAll(
            good.select(as_rows(_line("schema_compliance", share, policy.schema_compliance)))
        )
    if policy.fail_on_error:
        measured = report.collect()  # at most four lines
        missed = [f"{r.metric}={r.value}" for r in measured if not r.passed]
        if missed:
            raise DataQualityError("thresholds missed: " + ", ".join(missed))
        return df.sparkSession.createDataFrame(measured, _REPORT)
    return report


def policy_reports(
    df: DataFrame, policy: QualityPolicy, keys: list[str] | None = None
) -> dict[str, DataFrame]:
    """The reports beside the gate that the policy switches on: ``duplicates`` of the keys (by
    default of whole rows) and ``profile``."""
    reports = {}
    if policy.enabled and policy.duplicate_detection:
        reports["duplicates"] = duplicates(df, keys or df.columns)
    if policy.enabled and policy.data_profiling:
        reports["profile"] = profile(df)
    return reports
