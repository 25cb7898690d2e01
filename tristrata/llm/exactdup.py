"""Exact de-duplication by progressive refinement, in DataFrame operations only.

Rows are grouped by the length of their text, then by a hash of its first characters, and only
rows whose (length, prefix) group has more than one row have their whole text hashed (SHA-256).
Texts are equal when they are identical after A-Z are lower-cased; null counts as empty.

Only the narrow keys of the rows are refined. Texts are read again for the surviving groups
alone: where the groups are few enough to be broadcast (counted, ``BROADCAST_KEYS``) no text
moves; beyond that the texts meet the groups in a salted join.

A hot group (a third of all rows may be copies of one text) is never gathered: counts are
combined inside the tasks before they are shuffled, and every join that shuffles rows has a salt,
so that the rows of a hot key spread over several tasks.

Defined results: an empty table gives an empty result; a null id is smaller than every other id
and its rows are kept only where the whole group has no id; repeated rows (same id, equal text)
count towards the group's size and are all marked as kept, while ``deduplicate`` returns one of
them. Other columns are not looked at, so their names may clash with nothing but the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.common import apart, lower_ascii, salt_of, salted, together
from tristrata.scratch import staged

#: Characters of the prefix that is hashed for every row whose length is shared.
PREFIX_CHARS = 256
#: Tasks that one hot key is spread over in joins.
SALTS = 32
#: Most surviving groups (12 bytes each) that are sent to all tasks.
BROADCAST_KEYS = 500_000


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, in lowercase hex."""
    return F.sha2(lower_ascii(text).cast("binary"), 256)


def text_length(text: Column) -> Column:
    """Bytes of the text: A-Z and a-z have one byte each, so those of its normal form."""
    return F.octet_length(F.coalesce(text, F.lit("")))


def prefix_hash(text: Column) -> Column:
    """A hash of the first characters of the normalised text."""
    return F.xxhash64(lower_ascii(F.substring(F.coalesce(text, F.lit("")), 1, PREFIX_CHARS)))


def refine(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, full_hash``, then ``carry``.

    ``full_hash`` is null where a shorter key already tells the row from all others. ``carry``
    names expressions over ``docs`` that go along with each row.
    """
    carry = carry or {}
    text = F.coalesce(F.col(text_col), F.lit(""))
    length, prefix = text_length(text), prefix_hash(text)
    salt = salt_of(SALTS, F.col(id_col))

    lengths = docs.groupBy(length.alias("len")).count().where("count > 1").select("len")
    prefixes = (
        docs.select(length.alias("len"), prefix.alias("pre"), salt.alias("salt"))
        .join(salted(lengths, SALTS), ["len", "salt"], "left_semi")
        .groupBy("len", "pre")
        .count()
        .where("count > 1")
        .select("len", "pre")
    )
    prefixes = staged(prefixes.withColumn("survives", F.lit(True)), "prefixes")
    if prefixes.count() <= BROADCAST_KEYS:
        survivors, keys = F.broadcast(prefixes), ["len", "pre"]
    else:
        survivors, keys = salted(prefixes, SALTS), ["len", "pre", "salt"]
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            text.alias("text"),
            length.alias("len"),
            prefix.alias("pre"),
            salt.alias("salt"),
            *[column.alias(name) for name, column in carry.items()],
        )
        .join(survivors, keys, "left")
        .select(
            "doc_id",
            "len",
            "pre",
            "salt",
            F.when(F.col("survives"), text_digest(F.col("text"))).alias("full_hash"),
            *carry,
        ),
        "refined",
    )
    groups = (
        rows.where("full_hash IS NOT NULL")
        .groupBy("len", "pre", "full_hash")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    return (
        rows.join(salted(groups, SALTS), ["len", "pre", "full_hash", "salt"], "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id"))
            .otherwise(F.col("keep_id"))
            .alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            "full_hash",
            *carry,
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "full_hash", *carry)
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the largest id. Only rows
    whose id, length and prefix are those of a dropped row have their whole text hashed again."""
    rows = apart(docs, text_col)
    own = F.col("text") if id_col == text_col else F.col(f"rest.{id_col}")
    rows = rows.withColumns({"id": own, "size": text_length(F.col("text")), "head": prefix_hash(F.col("text"))})
    carry = {"size": text_length(F.col(text_col)), "head": prefix_hash(F.col(text_col))}
    found = staged(refine(docs, id_col, text_col, carry).where("group_size > 1"), "repeats")
    keys = ["doc_id", "size", "head"]
    dropped = found.where("NOT kept").groupBy(*keys).agg(F.collect_set("full_hash").alias("hashes"))
    same = F.col("r.id").eqNullSafe(F.col("g.doc_id"))
    same &= (F.col("r.size") == F.col("g.size")) & (F.col("r.head") == F.col("g.head"))
    met = rows.alias("r").join(dropped.alias("g"), same, "left").select("r.*", "hashes")
    gone = F.array_contains("hashes", text_digest(F.col("text")))
    left = met.where(F.col("hashes").isNull() | ~gone).drop("hashes")
    # Where an id is repeated with its text, more than one row of a group is left.
    twice = found.where("kept").groupBy(*keys, "full_hash").count().where("count > 1").drop("count")
    if not twice.isEmpty():
        same &= text_digest(F.col("r.text")) == F.col("g.full_hash")
        one = left.alias("r").join(twice.alias("g"), same, "left_semi")
        one = one.withColumn("hash", text_digest(F.col("text"))).dropDuplicates(["id", "hash"])
        rest = left.alias("r").join(twice.alias("g"), same, "left_anti")
        left = rest.unionByName(one.drop("hash"))
    return together(left, docs, text_col)
