import gzip
import random

from pyspark.sql import functions as F

from tristrata.llm import warc
from tristrata.scratch import scratch

SCHEMA = "page_id long, url string, html string, record string, n int"


def record(page, block, digest=True):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + block
    head = b"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: %d\r\n" % page
    if digest:
        head += b"WARC-Block-Digest: sha1:" + warc.digest(block).encode() + b"\r\n"
    head += b"Content-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block)
    return head + block + b"\r\n\r\n"


def test_round_trip(spark):
    long = "<p>" + "x" * 300_000
    rows = [(1, "u", "same"), (2, None, "same"), (3, "a\r\nb c", None), (4, "u", ""), (5, "ü", "ünï"), (6, "u", long)]
    rows += [(7, "u", long), (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", "same"), (5, "ü", "ünï")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    path = scratch(spark, "warc-test")
    warc.write(df, path)
    back = warc.read(spark, path)
    assert warc.gaps(back).count() == 0
    got = warc.pages_of(back).collect()
    assert len(got) == len(rows)
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), -1 if i is None else i)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), warc.digest(html.encode()))
        last = top[html]
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == last else ("revisit", last))
        if r.record_type == "response":
            assert bytes(r.payload) == html.encode()
    assert {r.url for r in got if r.page_id == 3} == {"a%20%20b%20c"}


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = scratch(spark, "warc-test")
    warc.write(df, path, least=3)
    got = {r.page_id: r.record_type for r in warc.pages_of(warc.read(spark, path)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_files_are_cut_by_bytes(spark, tmp_path):
    sizes = [10, 40_000, 10, 90_000, 10, 10, 200_000, 10] * 5
    rows = [(k, "u", f"{k}:" + "x" * n) for k, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(df, str(tmp_path / "cut"), file_bytes=100_000)
    files = sorted((tmp_path / "cut").rglob("part-*"))
    assert len(files) > 10
    assert max(f.stat().st_size for f in files) < 100_000 + 200_000 + 2_000
    back = warc.read(spark, str(tmp_path / "cut"))
    assert warc.gaps(back).count() == 0
    got = {r.page_id: bytes(r.payload).decode() for r in warc.pages_of(back).collect()}
    assert got == {k: html for k, _, html in rows}


def test_damaged_copy_of_an_archive(spark, tmp_path):
    """A stated part of the records is damaged: all others come back, and gaps hold every byte cut."""
    rows = [(k, f"u{k}", f"<p>page {k} " + "word " * (k % 50)) for k in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write(df, str(tmp_path / "whole"))
    damaged, bad = tmp_path / "damaged", set()
    damaged.mkdir()
    lost = 0
    for number, f in enumerate(sorted((tmp_path / "whole").rglob("part-*"))):
        out = b""
        for kind, at, size, header, block in warc.salvage(f.read_bytes()):
            record, page = f.read_bytes()[at : at + size], int(header["x-page-id"])
            if page % 7 == 0:
                bad.add(page)
                middle = len(record) - len(block) // 2 - 4
                record = record[:middle] + b"#" + record[middle + 1 :] if page % 2 else record[:middle]
                lost += len(record)
            out += record
        (damaged / f"{number}.warc").write_bytes(out)
    back = warc.read(spark, str(damaged))
    got = {r.page_id for r in warc.pages_of(back).collect()}
    assert bad and got == {k for k, _, _ in rows} - bad
    assert warc.gaps(back).agg(F.sum("length")).first()[0] == lost


def test_empty_table(spark):
    path = scratch(spark, "warc-test")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.read(spark, path).where("kind = 'record'").count() == 0


def summary(data):
    found = list(warc.salvage(data))
    # Records and gaps follow each other and cover the file.
    at = 0
    for _, offset, size, *_ in found:
        assert offset == at and size > 0
        at += size
    assert at == len(data)
    return [int(f[3].get("x-page-id", -1)) if f[0] == "record" else "gap" for f in found]


def test_salvage_of_plain_and_compressed_archives():
    records = [record(k, b"payload %d " % k * 50) for k in range(6)]
    for pack in (bytes, gzip.compress):
        parts = [pack(r) for r in records]
        assert summary(b"".join(parts)) == [0, 1, 2, 3, 4, 5]
        cut = parts[2][: len(parts[2]) // 2]
        assert summary(b"".join([*parts[:2], cut, *parts[3:]])) == [0, 1, "gap", 3, 4, 5]
        broken = bytearray(parts[3])
        broken[len(broken) // 2] ^= 0x55
        assert summary(b"".join([*parts[:3], broken, *parts[4:]])) == [0, 1, 2, "gap", 4, 5]
        assert summary(b"junk" + b"".join(parts) + b"tail") == ["gap", 0, 1, 2, 3, 4, 5, "gap"]
        assert summary(parts[0] + bytes(1000) + parts[1]) == [0, "gap", 1]
    assert summary(b"") == []
    assert summary(b"nothing of use") == ["gap"]
    assert summary(gzip.compress(records[0]) + records[1]) == [0, 1]
    # A wrong length without a digest is found by the missing end.
    assert summary(records[0].replace(b"Length: ", b"Length: 1", 1) + records[1]) == ["gap", 1]


def test_a_cut_at_any_byte_is_a_gap_and_nothing_else_is_lost():
    records = [record(k, b"payload %d " % k * 3) for k in range(3)]
    for pack in (bytes, gzip.compress):
        parts = [pack(r) for r in records]
        for cut in range(1, len(parts[1])):
            found = list(warc.salvage(parts[0] + parts[1][:cut] + parts[2]))
            assert [(f[0], f[1], f[2]) for f in found] == [
                ("record", 0, len(parts[0])),
                ("gap", len(parts[0]), cut),
                ("record", len(parts[0]) + cut, len(parts[2])),
            ]
            assert found[2][3]["x-page-id"] == "2"


def test_a_value_may_end_as_a_version_line():
    good = record(1, b"x").replace(b"X-Page-Id", b"WARC-Target-URI: http://a/WARC/1.1\r\nX-Page-Id")
    assert summary(good + record(2, b"y")) == [1, 2]


def test_ids_of_text(spark):
    df = spark.createDataFrame([("a", "u", "x"), ("b", "u", "x"), (None, "u", "")], "page_id string, url string, html string")
    path = scratch(spark, "warc-test")
    warc.write(df, path)
    back = warc.read(spark, path)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.pages_of(back, "string").collect()}
    assert got == {"a": ("revisit", "b"), "b": ("response", None), None: ("response", None)}
    assert {r.page_id for r in warc.pages_of(back).collect()} == {None}


def test_random_damage_never_raises():
    rng = random.Random(3)
    data = b"".join(gzip.compress(record(k, b"x" * 40)) if k % 2 else record(k, b"y" * 40) for k in range(10))
    for _ in range(300):
        hurt = bytearray(data)
        for _ in range(rng.randint(1, 5)):
            a = rng.randrange(len(hurt))
            hurt[a : a + rng.randint(0, 30)] = rng.randbytes(rng.randint(0, 30))
        list(warc.salvage(bytes(hurt)))


def test_gaps_are_logged(spark, tmp_path):
    good = record(1, b"one")
    (tmp_path / "a.warc").write_bytes(good + b"damage" + record(2, b"two"))
    (tmp_path / "empty.warc").write_bytes(b"")
    back = warc.read(spark, str(tmp_path))
    row = warc.gaps(back).first()
    assert (row.offset, row.length, row.reason) == (len(good), 6, "no version line")
    assert back.where(F.col("kind") == "record").count() == 2
