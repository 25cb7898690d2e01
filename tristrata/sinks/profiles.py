"""Profiles that merge: a stored state per directory, from which any range is profiled.

A state is one row: its row count and, for each column, filled values, least and greatest, the sum,
and sketches: HyperLogLog for distinct values, KLL for quantiles, and theta for those columns whose
overlap is asked for. Increments only add states, so a directory that gets late rows has several;
readers merge them. The detail rows are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from tristrata.operators.quality import as_rows, named, profile_line
from tristrata.schemas import orderable
from tristrata.sinks.merge import finished

INCREMENT = "profile_increment"
ROWS = "profile_rows"

# Twice the sketches' stated errors at the sizes used here (2^12 registers, k = 200, 2^12 entries).
DISTINCT_ERROR = 0.04
RANK_ERROR = 0.03
OVERLAP_ERROR = 0.04


def profile_states(df: DataFrame, by: list[str], keys: list[str] | None = None) -> DataFrame:
    """One state per directory, that is per value of ``by``; ``keys`` get theta sketches, too.

    Every task makes one state per directory it has rows of, and only these are shuffled: a
    directory that holds a large share of all rows is as small as any other by then. Nulls count as
    not filled; columns that Spark cannot compare have filled values only.
    """
    if {INCREMENT, ROWS} & set(df.columns):
        raise ValueError(f"columns of these names are the states' own: {INCREMENT}, {ROWS}")
    fields = [f for f in df.schema.fields if f.name not in by]
    return df.groupBy(*[named(b).alias(b) for b in by]).agg(
        F.count(F.lit(1)).alias(ROWS),
        *[_state(f, f.name in (keys or ())).alias(f.name) for f in fields],
    )


def _state(field: StructField, key: bool) -> Column:
    value = named(field.name)
    parts = {"filled": F.count(value)}
    if orderable(field.dataType):
        code = F.when(value.isNotNull(), F.xxhash64(value))
        parts |= {"min": F.min(value), "max": F.max(value), "hll": F.hll_sketch_agg(code)}
        if key:
            parts["theta"] = F.theta_sketch_agg(code)
    else:
        parts["type"] = F.max(F.lit(field.dataType.simpleString()))
    if isinstance(field.dataType, NumericType):
        number = value.cast("double")
        parts |= {"sum": F.sum(number), "kll": F.kll_sketch_agg_double(number)}
    return F.struct(*[part.alias(name) for name, part in parts.items()])


MERGES = {
    "filled": F.sum,
    "min": F.min,
    "max": F.max,
    "type": F.max,
    "sum": F.sum,
    "hll": F.hll_union_agg,
    "theta": F.theta_union_agg,
    "kll": F.kll_merge_agg_double,
}


def merge_states(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """States of the same values of ``by`` made one; without ``by`` all of them, one row."""
    by = by or []
    merged = [F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS)]
    for f in _profiled(states):
        parts = [
            MERGES[part](_part(f.name, part)).alias(part) for part in f.dataType.names
        ]
        merged.append(F.struct(*parts).alias(f.name))
    return states.groupBy(*[named(b).alias(b) for b in by]).agg(*merged)


def _profiled(states: DataFrame) -> list[StructField]:
    """The columns that hold states."""
    fields = states.schema.fields
    return [f for f in fields if isinstance(f.dataType, StructType) and "filled" in f.dataType.names]


def _part(column: str, part: str) -> Column:
    return named(column).getField(part)


def add_profiles(
    path: str, df: DataFrame, increment: str, by: list[str], keys: list[str] | None = None
) -> bool:
    """Store the states of an increment's rows; false if an increment of that name is there.

    A run that was cut short left no mark and is made good by the next of that name, so no row
    counts twice.
    """
    spark = df.sparkSession
    into = f"{path}/{INCREMENT}={increment}"
    if finished(spark, into):
        return False
    profile_states(df, by, keys).write.mode("overwrite").parquet(into)
    return True


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The stored states; filter them by the columns of ``by`` for a range. Columns that later
    increments have gained are null in earlier ones."""
    return spark.read.option("mergeSchema", True).parquet(path)


def compact_profiles(spark: SparkSession, path: str, into: str, by: list[str]) -> None:
    """One state per directory, written to a new place, as a single increment."""
    states = merge_states(read_profiles(spark, path), by)
    states.write.mode("overwrite").parquet(f"{into}/{INCREMENT}=compacted")


def profile_of(states: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all rows that the states stand for, in the columns of ``quality.profile`` and
    with ``quantiles`` of numeric columns (null for others, and where no value is filled).

    Rows, nulls, least, greatest and average are exact. Distinct values and the quantiles' ranks
    have the errors of their sketches; quantiles leave NaN out.
    """
    one = merge_states(states)
    lines = []
    for f in _profiled(states):
        kinds = {p.name: p.dataType for p in f.dataType.fields}
        filled = F.coalesce(_part(f.name, "filled"), F.lit(0))
        parts = {"filled": filled}
        if "hll" in kinds:
            distinct = F.hll_sketch_estimate(_part(f.name, "hll"))
            parts |= {
                "distinct": F.when(filled > 0, distinct).otherwise(0),
                "min": _part(f.name, "min"),
                "max": _part(f.name, "max"),
            }
        cuts = F.lit(None)
        if "kll" in kinds:
            parts["avg"] = F.try_divide(_part(f.name, "sum"), filled)
            kll = _part(f.name, "kll")
            asked = F.array(*[F.lit(float(q)) for q in quantiles])
            some = F.kll_sketch_get_n_double(kll) > 0
            cuts = F.when(some, F.kll_sketch_get_quantile_double(kll, asked))
        kind = kinds["min"] if "min" in kinds else None
        line = profile_line(StructField(f.name, kind or f.dataType), F.col(ROWS), parts)
        if kind is None:
            line = line.withField("data_type", _part(f.name, "type"))
        lines.append(line.withField("quantiles", cuts.cast("array<double>")))
    return one.select(as_rows(*lines))


def key_overlap(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of a key on both sides and those they share, estimated from stored theta
    sketches: up to 4,096 distinct values the counts are exact. One row; no key is read or joined."""
    sides = [
        merge_states(side).select(_part(column, "theta").alias("theta"), F.lit(n).alias("side"))
        for n, side in enumerate((left, right))
    ]
    both = sides[0].unionByName(sides[1]).agg(
        *[F.max(F.when(F.col("side") == n, F.col("theta"))).alias(name)
          for n, name in enumerate(("a", "b"))]
    )

    def count(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0))

    return both.select(
        count(F.col("a")).alias("left_keys"),
        count(F.col("b")).alias("right_keys"),
        count(F.theta_intersection("a", "b")).alias("shared_keys"),
    )
