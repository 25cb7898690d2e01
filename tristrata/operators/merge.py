"""Keyed upsert and insert-if-absent. Keys are primary keys: unique and not null in the target."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.schemas import orderable


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A null in a key column stops the job, as a primary key would.

    The filter on the checked columns never drops a row. It is the one Spark would add on the
    join's side only; with it on both uses of the rows their shuffle is done once.
    """
    types = dict(df.dtypes)
    checked = df.withColumns(
        {
            k: F.coalesce(F.col(k), F.raise_error(F.lit(f"null in key column {k}")).cast(types[k]))
            for k in keys
        }
    )
    return checked.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def newest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row of each key with the greatest ``order_by``.

    Ties go by the other columns, so a task that is run again picks the same row. Spark cuts
    each task's rows to one per key before the shuffle; a hot key stays small.
    """
    ties = [f for f in df.schema.fields if f.name not in keys and f.name not in order_by]
    order = [F.col(c) for c in order_by] + [
        F.col(f.name) if orderable(f.dataType) else F.to_json(f.name) for f in ties
    ]
    if not order:
        return df.dropDuplicates(keys)
    best = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def replace_keys(target: DataFrame, newest: DataFrame, keys: list[str]) -> DataFrame:
    """The target with the rows of ``newest``, one per key, in place of its own.

    The target meets the new keys in one join. It is not shuffled for that when Spark knows
    from their size that they can be broadcast, as it does for stored rows.
    """
    kept = target.join(newest.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(newest.select(*target.columns))


def keep_newer(
    target: DataFrame, newest: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """Of each key the row with the greater ``order_by``, stored or new; on a tie the new one.

    So the result does not depend on how changes are cut into batches, and a change that comes
    late does not undo a newer one. A null is smaller than any value. Like ``replace_keys`` this
    leaves the target where it is when the new keys can be broadcast; of the stored rows that
    win, only keys and order are read a second time.
    """
    if not order_by:
        return replace_keys(target, newest, keys)
    came = newest.select(*keys, F.struct(*order_by).alias("_came"))
    wins = F.struct(*order_by) > F.col("_came")
    kept = target.join(came, keys, "left").filter(F.col("_came").isNull() | wins)
    beaten = target.select(*keys, *[c for c in order_by if c not in keys]).join(came, keys)
    fresh = newest.join(beaten.filter(wins).select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def upsert(
    target: DataFrame, changes: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """The target with each changed key's row replaced by its newest change, and new keys added.

    A stored row that is newer by ``order_by`` stays; without ``order_by`` the change wins.
    """
    newest = newest_per_key(require_keys(changes, keys), keys, order_by)
    return keep_newer(target, newest, keys, order_by)


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose key the target lacks, one per key; append them to the target.

    Both sides are read once. Each task cuts the target's rows to distinct keys before they are
    shuffled, so a key that the target holds many times is shuffled once per task.
    """
    one = newest_per_key(require_keys(new, keys), keys, [])
    known = target.select(*keys).dropDuplicates(keys)
    return one.join(known, keys, "left_anti").select(*new.columns)
