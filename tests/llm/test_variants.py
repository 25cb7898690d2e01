import random
import re
import zlib
from collections import Counter

import pytest

from tristrata.llm import variants

SCHEMA = "doc_id long, text string, word string, node int, rest string"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def near(a, b):
    """One edit apart, by taking each letter out."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, UPPER.lower()))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    by = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, found in by.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(by[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def texts(seed, letters, docs=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    rows = []
    for k in range(docs):
        picked = [rng.choice(words)[: rng.randrange(4, 9)] for _ in range(rng.randrange(60))]
        picked = [w if rng.random() < 0.7 else w.replace(rng.choice(letters), rng.choice(letters), 1) for w in picked]
        rows.append((k if k % 7 else None, rng.choice([" ", ", ", "\n", "_1"]).join(picked), "w", 1, "r"))
    return rows


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abC"), (3, "aéÀx"), (4, "abcdefgh")])
def test_against_plain_python(spark, rows, seed, letters):
    data = texts(seed, letters, docs=60)
    data += [(901, None, None, None, None), (902, "", None, None, None), (903, "1234 ... ×÷", "c", 2, "z")]
    got = rows(variants.group(spark.createDataFrame(data, SCHEMA)))
    assert len(got) > 3 and got == brute(data)


def test_chains_of_forms_and_long_words(spark, rows):
    long = "ab" * 3000
    words = {"wordwise": 80, "wordwize": 40, "wurdwize": 20, "wurdwizes": 10, "wurdvizes": 5}
    words |= {long: 9, long[:-1]: 3, long[:2999] + "x" + long[3000:]: 4, "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12}
    data = [(k, " ".join([w] * n), "w", 1, "r") for k, (w, n) in enumerate(words.items())]
    got = rows(variants.group(spark.createDataFrame(data, SCHEMA)))
    assert got == brute(data)
    assert {r[0]: r[2] for r in got}.get("wurdvizes") == "wordwise"


def test_prefixes_of_words():
    at, depth, node, letter = variants.prefixes(["abcd", "abx", "abcd"], 0)
    found = sorted(zip(at.tolist(), depth.tolist(), letter.tolist()))
    assert found[:4] == [(0, 1, ord("b")), (0, 2, ord("c")), (0, 3, ord("d")), (0, 4, variants.END)]
    same = {(d, n) for w, d, n in zip(at.tolist(), depth.tolist(), node.tolist()) if w == 0}
    assert same == {(d, n) for w, d, n in zip(at.tolist(), depth.tolist(), node.tolist()) if w == 2}
    assert all((d, n) in same for w, d, n in zip(at.tolist(), depth.tolist(), node.tolist()) if w == 1 and d <= 2)


def test_no_rows(spark):
    assert variants.group(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, "words words", "w", 1, "r")], SCHEMA)
    assert variants.group(one).count() == 0
