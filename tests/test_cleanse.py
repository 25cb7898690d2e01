from datetime import date

import pytest
from pyspark.sql import functions as F

from tristrata.functions.text import normalise_email, normalise_phone, quality_score
from tristrata.operators.cleanse import (
    add_audit_columns,
    cleanse_contacts,
    dedupe,
    keep_scored,
    partition_key,
)


def test_text(spark):
    df = spark.createDataFrame(
        [("  Ann@Example.ORG ", "+33 (0)6-12 ext"), (None, None)], "email STRING, phone STRING"
    )
    out = df.select(normalise_email("email"), normalise_phone("phone")).collect()
    assert [tuple(r) for r in out] == [("ann@example.org", "+330612"), (None, None)]


@pytest.mark.parametrize(
    ("email", "score"),
    [
        ("a.b+c%d_e-f@x-y.co.uk", 1.0),
        ("a@b.c", 0.0),
        ("a@b", 0.0),
        ("a b@c.org", 0.0),
        ("@c.org", 0.0),
        ("", 0.0),
        (None, 0.0),
    ],
)
def test_score(spark, email, score):
    df = spark.createDataFrame([(email,)], "email STRING")
    assert df.select(quality_score("email")).first()[0] == score


def test_keep_scored(spark, rows):
    df = spark.createDataFrame([(0.5,), (0.6,), (None,)], "data_quality_score DOUBLE")
    assert rows(keep_scored(df)) == [(0.6,)]


def test_dedupe_rows_and_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "k INT, v STRING"
    )
    assert rows(dedupe(df)) == [(1, "a"), (1, "b"), (None, None)]
    assert dedupe(df, ["k"]).count() == 2


def test_copies_of_one_row_shrink_before_the_shuffle(spark, plan):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    text = plan(dedupe(df))
    assert text.count("HashAggregate") == 2
    assert dedupe(df).count() == 1


def test_audit_columns(spark):
    df = spark.createDataFrame([("d1", 7)], "device STRING, n INT")
    row = add_audit_columns(
        df, source_system="mqtt", version=1, is_deleted=False,
        partition_key=partition_key("device", "n"),
    ).first()
    assert (row.source_system, row.version, row.is_deleted) == ("mqtt", 1, False)
    assert row.partition_key == "d1|7"
    assert isinstance(row.processing_date, date)
    assert row.created_at is not None


def test_audit_columns_are_known(spark):
    with pytest.raises(ValueError, match="colour"):
        add_audit_columns(spark.range(1), colour="red")


def test_cleanse(spark, rows):
    df = spark.createDataFrame(
        [
            (1, " Ann@Example.org", "+1 (2) 3"),
            (1, " Ann@Example.org", "+1 (2) 3"),
            (2, "no mail", "4"),
            (3, None, "5"),
        ],
        "id INT, email STRING, phone STRING",
    )
    out = cleanse_contacts(df)
    assert rows(out, "id", "email", "phone", "data_quality_score") == [
        (1, "ann@example.org", "+123", 1.0)
    ]
    assert {"processing_date", "created_at"} <= set(out.columns)


def test_unusable_rows_go_before_the_shuffle(spark, plan, tmp_path):
    spark.range(3).selectExpr("id", "'a@b.org' AS email", "'1' AS phone").write.parquet(
        f"{tmp_path}/c"
    )
    text = plan(cleanse_contacts(spark.read.parquet(f"{tmp_path}/c")))
    assert "RLIKE" in text.split("Exchange")[1]
