import random
import re

import numpy as np
import pytest

from tristrata.llm import neardup
from tristrata.llm.components import components

SCHEMA = "doc_id long, text string, label string, n int"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 4]) for k in range(len(words) - 3)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest.setdefault(find(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in smallest[find(k)] if x is not None]
        top = min(ids) if ids else None
        out.append((i, len(sets[k]), top, i == top))
    return sorted(out, key=repr)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def check(frame, rows):
    df = frame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    got = neardup.group(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    return df


def test_groups_match_brute_force(frame):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(500)}" for _ in range(n)] for n in (3, 4, 5, 30, 80, 400)]
    rows, k = [], 10
    for words in base:
        for n in (0, 0, 1, 2, 4, 9):
            rows.append((k, edited(rng, words, n)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \n\t"), (k + 3, "Ab cd"), (k + 4, "AB  CD"), (3, rows[4][1])]
    rows += [(None, "lonely text without an id here"), (10, rows[0][1])]
    df = check(frame, rows)
    kept = neardup.deduplicate(df)
    assert kept.columns == df.columns


def test_one_large_group_of_copies_and_of_edited_copies(frame, monkeypatch):
    """Links that no pivot shows: copies of copies, so that the ends of a chain are far apart."""
    monkeypatch.setattr(neardup, "CHUNK", 16)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    rows, texts = [], [words]
    for k in range(220):
        own = list(rng.choice(texts[-40:]))
        for _ in range(rng.choice([1, 1, 2, 3])):
            own[rng.randrange(len(own))] = f"e{k}"
        texts.append(own)
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(words)) for k in range(60)]
    rng.shuffle(rows)
    check(frame, rows)


def test_only_the_rows_that_are_copies_go(frame):
    words = [f"w{k}" for k in range(60)]
    copy = " ".join([*words[:-1], "changed"])
    clean = [(None, "a text that nobody else has written"), (None, None), (7, "another one without any copies")]
    clean += [(None, "two rows without an id share it"), (None, "two rows without an id share it")]
    df = check(frame, [(1, " ".join(words)), (None, copy), (7, copy), *clean])
    kept = sorted(((r.doc_id, r.text) for r in neardup.deduplicate(df).collect()), key=repr)
    assert kept == sorted([(1, " ".join(words)), *clean], key=repr)


def test_empty_table(frame):
    df = frame([], SCHEMA)
    assert neardup.group(df).count() == 0
    assert neardup.deduplicate(df).count() == 0


def test_the_test_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(1)
    least = neardup.needed(0.8, 1e-6)
    for similarity, kept in ((0.9, 1.0), (0.8, 1.0), (0.5, 0.0), (0.2, 0.0)):
        one = rng.integers(0, 60000, (400, neardup.HASHES)).astype(np.uint16)
        two = np.where(rng.random(one.shape) < similarity, one, one + np.uint16(1))
        share = (neardup.plausible(one, two, least) >= 0).mean()
        assert share == pytest.approx(kept, abs=0.01)


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    edges += [(k, k + 1) for k in range(300, 380)] + [(500, 500 + k) for k in range(1, 60)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {k: find(k) for k in root if any(k in e for e in edges if e[0] != e[1])}
    got = components(spark.createDataFrame([*edges, (None, 4)], "a long, b long")).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_columns_of_any_name_are_kept(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(2, text), (1, text + " end"), (None, "alone"), (3, None)]
    names = ["__id", "__gone", "__tie", "tie", "rest", "node"]
    df = spark.createDataFrame([(*r, *range(6)) for r in rows], ["doc_id", "text", *names])
    kept = neardup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, None]
    assert all(tuple(r)[2:] == tuple(range(6)) for r in kept.collect())


@pytest.mark.parametrize("task_edges", [3, 10, 1000])
def test_components_over_many_parts(spark, task_edges):
    rng = random.Random(task_edges)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(25)]
    edges += [(5, 5), (None, 3), (7, None)]
    label = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.label for r in components(df, task_edges).collect()}
    assert got == {n: label[n] for a, b in edges if a is not None and b is not None and a != b for n in (a, b)}
