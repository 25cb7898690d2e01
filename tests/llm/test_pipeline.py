import random

import corpus_pipeline
import pytest
import test_decontaminate
import test_exactdup
import test_neardup
from __spark_entry__ import oracle_sql, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder):
    rng = random.Random(12)
    parts = {"aa": ["ba", "lo", "mi", "nu"], "bb": ["xor", "yek", "wiz", "qua"]}
    word = lambda lang: "".join(rng.choices(parts[lang], k=3))
    items = [(k, " ".join(word("aa") for _ in range(20))) for k in range(3)]
    rows = []
    for k in range(60):
        lang = rng.choice(["aa", "bb"])
        own = [word(lang) for _ in range(60)]
        rows.append([k, " ".join(own), lang, f"s{k % 3}"])
    rows += [[100 + k, rows[k][1].upper(), rows[k][2], "s0"] for k in range(5)]
    rows += [[200 + k, rows[k + 20][1] + " extra", rows[k + 20][2], "s1"] for k in range(5)]
    rows += [[300 + k, rows[k + 30][1] + " " + items[k][1], rows[k + 30][2], "s1"] for k in range(3)]
    rows += [[400, "", None, None], [401, None, None, None], [402, "12 34", "aa", "s2"]]
    rows = [(*r, len(r[1] or "")) for r in rows]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_match_brute_force(spark, tmp_path):
    rows, items = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {r[0]: r[1] for r in rows if any(c.isalpha() for c in r[1] or "")}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "decontamination", "source_mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "exact_dedup":
            keep = {i for i, _, _, kept in test_exactdup.brute(list(want.items())) if kept}
            want = {i: t for i, t in want.items() if i in keep}
        if name == "near_dedup":
            keep = {i for i, _, _, kept in test_neardup.brute(list(want.items())) if kept}
            want = {i: t for i, t in want.items() if i in keep}
        if name == "decontamination":
            found = test_decontaminate.brute(list(want.items()), items)
            want = {i: want[i] for i, n, h, _ in found if not (h and 20 * h >= n)}
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert {r.doc_id: r.text for r in docs.collect()} == want, name
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.size for r in mixed} == {i: len(t.split()) for i, t in want.items()}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(tuple(r) for r in run.collect()) == sorted(tuple(r) for r in mixed)


def test_every_operator_has_a_query():
    names = queries()
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_decontamination", "op2_warc_salvage", "op4_near_dedup", "op5_exact_dedup"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries()[name](spark, sf)
    order = sorted(got.columns)
    want = con.sql(oracle_sql()[name]).to_arrow_table().select(order).to_pylist()
    have = [r.asDict() for r in got.select(order).collect()]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(have, key=key) == sorted(want, key=key)
