import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import decontaminate

DOC = "doc_id long, text string, n_words string, matches int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        words = tokens(text)
        hit, found = set(), set()
        for item_id, item in items:
            own = tokens(item)
            size = min(len(own), 13)
            for a in range(len(own) - size + 1 if own else 0):
                window = own[a : a + size]
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == window:
                        hit.update(range(b, b + size))
                        if item_id is not None:
                            found.add(str(item_id))
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "ñandú"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([3, 12, 13, 40])))) for k in range(8)]
    items += [(8, ""), (9, None), (None, "one lone item"), (10, items[3][1])]
    docs = []
    for k in range(40):
        text = rng.choices(vocabulary, k=rng.choice([0, 5, 60]))
        own = (rng.choice(items)[1] or "").split()
        cut = own[rng.randint(0, 5) :]
        docs.append((k, ", ".join(text[:30]).upper() + " ... " + " ".join(cut) + ". " + " ".join(text[30:])))
    docs += [(40, None), (41, ""), (42, "?!"), (None, items[3][1]), (1, docs[1][1]), (43, "one lone item")]
    return docs, items


def test_search_matches_brute_force(frame):
    docs, items = fixture()
    df = frame([(a, b, "clash", 1) for a, b in docs], DOC)
    benchmark = frame(items, "item_id long, text string")
    got = decontaminate.search(df, benchmark, keep=["doc_id"]).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got], key=repr) == brute(docs, items)
    for r in got:
        assert all(m.n_words >= 3 for m in r.matches)
    kept = decontaminate.remove(df, benchmark)
    assert kept.columns == df.columns
    clean = [d for d, n, h, _ in brute(docs, items) if not (h and 20 * h >= n)]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_blocks_of_a_large_benchmark_give_the_same(frame, monkeypatch):
    docs, items = fixture()
    df, benchmark = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert len(decontaminate.blocks(benchmark)) > 2
    got = decontaminate.search(df, benchmark).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got], key=repr) == brute(docs, items)


def test_longest_matches(frame):
    docs = [(1, "a b c d e f x"), (2, "z b c d e f g"), (3, "q q")]
    items = [(7, "a b c d e f g h")]
    df, benchmark = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    got = decontaminate.longest_matches(df, benchmark, min_words=2).collect()
    found = {r.item_word: (r.n_words, r.doc_id, r.doc_word) for r in got}
    assert found == {0: (6, 1, 0), 1: (6, 2, 1), 2: (5, 2, 2), 3: (4, 2, 3), 4: (3, 2, 4), 5: (2, 2, 5)}


def test_empty_tables(frame):
    docs, items = frame([], "doc_id long, text string"), frame([], "item_id long, text string")
    assert decontaminate.search(docs, items).count() == 0
    some = frame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.search(some, items).first().n_hit == 0


@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([1, 4, 20]))
@settings(max_examples=200, deadline=None)
def test_suffix_array_is_sorted_to_its_depth(tokens, depth):
    tokens = np.array(tokens, np.int64)
    order = decontaminate.suffix_array(tokens, depth).tolist()
    assert sorted(order) == list(range(len(tokens)))
    cut = [tokens[k : k + depth].tolist() for k in order]
    assert cut == sorted(cut)
