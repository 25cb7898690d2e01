import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import suffixdup
from tristrata.llm.lyndon import suffix_array

SCHEMA = "doc_id long, text string, id string, kept int"


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            part = raw[k : k + 100]
            if part in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(part)
        left = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest(), left)
    return out


def fixture():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    common, passage = text(60), text(35)
    rows = []
    for k in range(60):
        parts = [text(rng.randint(0, 80)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice([common, passage, passage[: rng.randint(90, 130)], ""]))
        rows.append((k, " ".join(parts)))
    rows += [(60, rows[3][1]), (61, rows[4][1][:150]), (62, "la " * 400), (63, "la " * 300), (64, None), (65, "")]
    rows += [(None, passage), (66, "x" * 99), (67, "x" * 100), (68, "x" * 101), (69, text(3000) + rows[5][1])]
    rows += [(100 + k, text(5) + common + text(5)) for k in range(40)]
    return rows


@pytest.mark.parametrize("section, crowd, block", [(1 << 20, 4096, 1 << 16), (700, 5, 2000)])
def test_removal_matches_brute_force(spark, monkeypatch, section, crowd, block):
    for name, value in (("SECTION", section), ("CROWD", crowd), ("BLOCK", block), ("FLUSH", 300)):
        monkeypatch.setattr(suffixdup, name, value)
    rows = fixture()
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    want = brute(rows)
    got = suffixdup.digest(df.repartition(3)).collect()
    assert len(got) == len(rows)
    assert {r[0]: tuple(r)[1:] for r in got} == {k: v[:4] for k, v in want.items()}


def test_texts_and_repeated_rows(spark):
    long = "This is a long line that is repeated, word by word, in more than one of the documents of this test. " * 2
    rows = [(1, "a " + long), (2, "b " + long), (2, "b " + long), (3, None)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    got = suffixdup.remove(df)
    assert got.columns == df.columns
    texts = sorted((r.doc_id, r.text) for r in got.collect())
    want = brute([rows[0], rows[1], rows[3]])
    assert texts == [(1, want[1][4].decode()), (2, want[2][4].decode()), (2, want[2][4].decode()), (3, None)]
    assert suffixdup.digest(df.limit(0)).count() == 0


@given(st.lists(st.integers(1, 3), max_size=80), st.integers(1, 5))
@settings(max_examples=400, deadline=None)
def test_suffix_array_matches_sorting(symbols, times):
    symbols = symbols * times + [0]
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda k: symbols[k:])


def test_lowest_of_every_window():
    rng = np.random.default_rng(2)
    for n, width in ((5, 5), (20, 3), (77, 77), (300, 76)):
        keys = rng.integers(0, 1000, n).astype(np.uint64)
        want = [keys[k : k + width].min() for k in range(n - width + 1)]
        assert suffixdup.lowest(keys, width).tolist() == want
