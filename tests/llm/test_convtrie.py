import hashlib
import random
import zlib

import pytest

from tristrata.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string, n int, base string"


def brute(rows):
    """Nodes by plain dictionaries."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq = own.get(base, [])[:h] + ts[h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    out = []
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        inner = {k[:-1] for k in members if k}
        saved = sum((len(members[k]) - 1) * len(k[-1][1].split()) for k in below if k)
        joined = ",".join(map(str, sorted(ends.get(key, []))))
        out.append(
            (
                min(convs),
                len(key),
                min(members[key[:-1]]) if key else None,
                len(convs),
                sum(len(k) == len(key) + 1 for k in below),
                sum(k not in inner for k in below),
                saved,
                hashlib.sha256(joined.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def talk(seed, convs=60, turns=6, texts=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(turns)):
            text = rng.choice(["", "a b", "a b c d", None] + ["w" * k for k in range(texts)])
            turn = rng.choice([t, None]) if t == 0 else t
            rows.append((c * rng.choice([1, 1, 7]), 10 * c + t if turn is not None else None, rng.choice(["u", None]), text, 1, "x"))
    # Ties are put in the order of their ids, so texts that tie are equal here.
    seen, out = {}, []
    for r in rows:
        out.append((*r[:2], *seen.setdefault(r[:2], r[2:4]), *r[4:]))
    return out


@pytest.mark.parametrize("seed,most,last", [(1, 1 << 20, 1 << 22), (2, 8, 8), (3, 50, 300)])
def test_against_plain_python(spark, rows, monkeypatch, seed, most, last):
    data = talk(seed, convs=400 if seed == 2 else 60)
    data += [(None, 1, "u", "lost", 1, "x"), (-25, 0, "u", "neg ative", 1, "x")]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = rows(convtrie.trie(convtrie.sequences(df), most, last))
    assert got == brute(data)


def test_equal_conversations_over_many_matrices(spark, rows):
    data = [(c, t, "u", f"turn {t}", 1, "x") for c in range(1500) for t in range(2 + (c % 7 == 0))]
    got = rows(convtrie.trie(convtrie.sequences(spark.createDataFrame(data, SCHEMA)), 64, 64))
    assert got == brute(data)


def test_long_conversation_and_long_text(spark, rows):
    data = [(5, t, "u", "w " * (t % 3), 1, "x") for t in range(2000)]
    data += [(6, 0, "u", "long " * 200_000, 1, "x"), (6, 1, "u", None, 1, "x"), (7, None, None, None, 1, "x")]
    got = rows(convtrie.nodes_of(spark.createDataFrame(data, SCHEMA)))
    assert len(got) == len({r[:2] for r in got}) and max(r[1] for r in got) >= 1997
    root = next(r for r in got if r[1] == 0)
    assert root[:4] == (5, 0, None, 3)


def test_no_rows(spark):
    assert convtrie.nodes_of(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(None, 1, "u", "x", 1, "b")], SCHEMA)
    assert convtrie.nodes_of(none).count() == 0
