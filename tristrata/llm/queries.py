"""The registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tristrata.llm import (
    convtrie,
    decontaminate,
    exactdup,
    extract,
    langid,
    mixing,
    neardup,
    pii,
    quality,
    suffixdup,
    toxicity,
    variants,
    warc,
)
from tristrata.llm.common import table
from tristrata.scratch import scratch

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


#: Lower-cases A-Z alone, as DuckDB's lower() would change other letters too.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    rf"""
    WITH d AS (
      SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p : p + 12], ' ') AS k
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p
            FROM b WHERE len(w) > 0)),
    grams AS (
      SELECT rid, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
      FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
            FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT rid, p, n, item_id FROM grams JOIN windows USING (n, k)),
    words AS (
      SELECT rid, count(DISTINCT q) AS n_hit
      FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
    items AS (
      SELECT rid, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS sha
      FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM hits) GROUP BY rid)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
           coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
    """
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside windows of the benchmark."""
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query(
    """
    WITH p AS (
      SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (
      SELECT *, max(page_id) OVER (PARTITION BY b) AS top FROM p),
    d AS (
      SELECT *, list_transform(range(0, 8),
               lambda i: ('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5))::BIGINT) AS v
      FROM g)
    SELECT page_id, octet_length(b) AS payload_bytes,
           array_to_string(list_transform(range(0, 32),
             lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((v[CAST(k // 4 + 1 AS BIGINT)] >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31), 1)),
             '') AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM d
    """
)
def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back by the salvage reader."""
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.pages_of(warc.read(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from labels of the rows that are not held out."""
    return quality.classify(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        langid.held_out(F.col("doc_id"), 3, 1),
    )


@query(
    rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[p : p + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p
            FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n
      HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    r AS (SELECT doc_id, doc_id AS c FROM documents
          UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
    m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM m LEFT JOIN n USING (doc_id)
    """
)
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are similar."""
    return neardup.group(table(spark, sf_dir, "documents"))


@query(
    f"""
    WITH t AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
    """
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by length, prefix hash and full hash."""
    docs = table(spark, sf_dir, "documents")
    # The operator hashes survivors alone; the contract wants a digest of every text.
    digest = {"text_sha256": exactdup.text_digest(F.col("text"))}
    return exactdup.refine(docs, carry=digest).drop("full_hash")


@query()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text."""
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def joined(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def of_kind(kind):
        return F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that long strings repeat."""
    return suffixdup.digest(table(spark, sf_dir, "documents"))


@query()
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query()
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the texts that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", langid.held_out(F.col("doc_id"), 5, 0)
    )
    model = langid.train(docs.where("NOT held_out"))
    return langid.identify(docs, model, spans=False, keep=["doc_id", "held_out"])


#: Expressions for crc32, which DuckDB lacks: its table, and the sum of a text.
CRC_TABLE = """
    k(i, j, c) AS (
      SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
      UNION ALL
      SELECT i, j + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END
      FROM k WHERE j < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM k WHERE j = 8)"""


def crc_of(text: str) -> str:
    """The unsigned crc32 of a text column; ``crc`` must be joined."""
    code = f"hex(encode({text}))"
    codes = f"""list_transform(range(1, length({code}), 2),
               lambda p: ('0x' || substr({code}, p, 2))::BIGINT)"""
    step = "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


@query(
    rf"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (
      SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS own, run, count(*) AS many
      FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-zÀ-ÿ]+')) AS run
            FROM documents) GROUP BY ALL),
    coded AS (SELECT run, many, {crc_of("own")} AS h FROM runs, crc),
    v AS (
      SELECT w, sum(many)::BIGINT AS n
      FROM (SELECT many, CASE WHEN h % 97 = 0
                   THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                   ELSE run END AS w FROM coded)
      WHERE length(w) >= 5 GROUP BY w HAVING sum(many) >= 3),
    cut AS (
      SELECT w, i, left(w, i - 1) AS x, substr(w, i + 1) AS y
      FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM v)),
    near AS (
      SELECT a.w AS a, b.w AS b FROM cut a JOIN cut b ON a.i = b.i AND a.x = b.x AND a.y = b.y
      WHERE a.w <> b.w
      UNION SELECT cut.w, v.w FROM cut JOIN v ON v.w = x || y
      UNION SELECT v.w, cut.w FROM cut JOIN v ON v.w = x || y),
    best AS (
      SELECT a AS w, count(*) AS n_near, min_by(b, (-n, b)) AS form, max(n) AS form_n
      FROM near JOIN v ON v.w = b GROUP BY a),
    forms AS (
      SELECT v.w, v.n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= 2 * n THEN form END AS form,
             CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
      FROM v LEFT JOIN best USING (w)),
    path AS (
      SELECT w, w AS here, 0 AS hops FROM forms
      UNION ALL
      SELECT path.w, forms.form, hops + 1 FROM path JOIN forms ON forms.w = here
      WHERE forms.form IS NOT NULL)
    SELECT w AS word, form, root, n, n_near, form_n
    FROM forms JOIN (SELECT w, max_by(here, hops) AS root FROM path GROUP BY w) USING (w)
    """
)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart and the forms they are spellings of."""
    return variants.group(table(spark, sf_dir, "documents"))


@query(
    rf"""
    WITH RECURSIVE {CRC_TABLE},
    turns AS (
      SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '')
                          || coalesce(text, '')) AS id,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
      SELECT conv_id, conv_id - conv_id % 20 AS base, {crc_of("conv_id::VARCHAR")} % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM turns), crc),
    rebuilt AS (
      SELECT c.conv_id, p, id, words FROM c JOIN turns t ON t.conv_id = c.base AND p <= h
      UNION ALL
      SELECT c.conv_id, p, id, words FROM c JOIN turns t ON t.conv_id = c.conv_id AND p > h),
    m AS (
      SELECT conv_id, row_number() OVER w AS d, string_agg(id, '') OVER w AS key, words
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY p)
      UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    n AS (
      SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words
      FROM m GROUP BY d, key),
    kids AS (
      SELECT d - 1 AS d, left(key, 32 * (d - 1)) AS key, count(*) AS n_children
      FROM n WHERE d > 0 GROUP BY ALL),
    own AS (
      SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, key)),
    sub AS (
      SELECT a AS d, left(key, 32 * a) AS key, count(*) FILTER (n_children = 0) AS n_leaves,
             sum((n_convs - 1) * words) AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY ALL),
    ends AS (
      SELECT d, key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM (SELECT conv_id, max(d) AS d, max_by(key, d) AS key FROM m GROUP BY conv_id)
      GROUP BY d, key)
    SELECT own.conv_id, own.d AS depth, up.conv_id AS parent_conv_id, own.n_convs,
           own.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM own JOIN sub USING (d, key) LEFT JOIN ends USING (d, key)
    LEFT JOIN n up ON up.d = own.d - 1 AND up.key = left(own.key, 32 * (own.d - 1))
    """
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return convtrie.nodes_of(table(spark, sf_dir, "conversations"))


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from labels of the rows that are not held out."""
    return toxicity.classify(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        langid.held_out(F.col("doc_id"), 3, 1),
    )


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
