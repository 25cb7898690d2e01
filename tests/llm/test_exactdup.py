from collections import defaultdict

from pyspark.sql import functions as F

from tristrata.llm import exactdup

SCHEMA = "doc_id long, text string, keep_id string, len int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = groups[lowered(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep))
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark):
    long = "Ab " * 3000
    rows = [(1, "Hello"), (2, "hELLO"), (3, "hellO!"), (4, None), (5, ""), (6, "É"), (7, "é")]
    rows += [(8, long), (9, long.upper()), (10, long[:-1] + "x"), (None, "x"), (11, "X")]
    rows += [(12, "same"), (12, "same"), (None, None), (13, long[:400]), (14, long[:399] + "z")]
    rows += [(100 + i, "hot") for i in range(500)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    got = exactdup.refine(df).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    kept = exactdup.deduplicate(df)
    assert kept.columns == df.columns
    left = [lowered(r.text) for r in kept.collect()]
    assert sorted(left) == sorted({lowered(b) for _, b in rows})


def test_many_groups_are_joined_by_salt(spark, monkeypatch):
    rows = [(k, f"text {k % 40}") for k in range(100)] + [(200 + k, "hot") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keep = ["doc_id", "keep_id", "group_size", "kept"]
    few = sorted(tuple(r) for r in exactdup.refine(df).select(keep).collect())
    monkeypatch.setattr(exactdup, "BROADCAST_KEYS", 0)
    assert sorted(tuple(r) for r in exactdup.refine(df).select(keep).collect()) == few == sorted(brute(rows))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exactdup.refine(df).count() == 0
    assert exactdup.deduplicate(df).count() == 0


def test_only_survivors_have_their_text_hashed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "cc"), (4, "dd"), (5, "dd")], "doc_id long, text string")
    hashed = exactdup.refine(df).where(F.col("full_hash").isNotNull()).select("doc_id").collect()
    assert sorted(r.doc_id for r in hashed) == [4, 5]


def test_columns_of_any_name_are_kept(spark):
    names = ["__id", "__hash", "__key", "hashes", "size", "head", "rest", "tie"]
    rows = [(1, "a"), (2, "A"), (2, "b"), (3, "b"), (4, "c"), (4, "c"), (None, "d"), (None, "D"), (5, None)]
    df = spark.createDataFrame([(*r, *range(8)) for r in rows], ["doc_id", "text", *names])
    kept = exactdup.deduplicate(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, lowered(r.text)) for r in kept.collect()), key=repr)
    assert got == sorted([(2, "a"), (3, "b"), (4, "c"), (None, "d"), (5, "")], key=repr)
    assert all(tuple(r)[2:] == tuple(range(8)) for r in kept.collect())
