import random

import numpy as np
from pyspark.sql import functions as F

from tristrata.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, spans int"
PARTS = {
    "aa": ["ba", "lo", "mi", "nu"],
    "bb": ["xor", "yek", "wiz", "qua"],
    "ru": ["при", "вет", "мир", "дом"],
}


def texts(lang, n, seed):
    rng = random.Random(seed)
    words = lambda: "".join(rng.choices(PARTS[lang], k=rng.randint(1, 3)))
    return " ".join(words() for _ in range(n))


def learned(frame):
    rows = [(k, texts(lang, 60, k), lang) for lang in PARTS for k in range(10)]
    return langid.train(frame([*rows, (99, "no language", None)], "doc_id long, text string, lang string"))


def test_texts_and_edge_cases(frame):
    model = learned(frame)
    assert model.langs == ["aa", "bb", "ru"]
    mixed = texts("aa", 40, 50) + ". " + texts("bb", 15, 51) + "! " + texts("ru", 5, 52)
    rows = [
        (1, texts("aa", 30, 40)),
        (2, texts("bb", 30, 41).upper()),
        (3, texts("ru", 30, 42)),
        (4, None),
        (5, ""),
        (6, "123 456 -- !"),
        (7, mixed),
        (7, mixed),
        (None, texts("bb", 3000, 43)),
        (8, "—"),
    ]
    df = frame([(a, b, None, "clash", 1) for a, b in rows], SCHEMA)
    got = langid.identify(df, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "spans"]
    by = {r.doc_id: r for r in got.collect()}
    assert [by[k].lang_pred for k in (1, 2, 3, 4, 5, 6, 7, None, 8)] == [
        "aa", "bb", "ru", "und", "und", "und", "aa", "bb", "und",
    ]
    assert [s.lang for s in by[7].spans] == ["aa", "bb", "ru"]
    assert [s.n_words for s in by[7].spans] == [40, 15, 5]
    assert by[4].score == 0 and by[1].score == 1 and 0.5 < by[7].score < 1
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == 6


def test_more_languages_than_a_block(frame, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 2)
    few = learned(frame)
    assert [b.value.shape[0] for b in few.logs] == [2, 1]
    df = frame([(k, texts(lang, 30, 90 + k)) for k, lang in enumerate(PARTS)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(df, few).orderBy("doc_id").collect()] == list(PARTS)


def test_hundreds_of_languages(frame):
    rng = random.Random(7)
    parts = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(12)] for k in range(300)}
    rows = [(k, " ".join(rng.choices(w, k=60)), lang) for k, (lang, w) in enumerate(parts.items())]
    model = langid.train(frame(rows, "doc_id long, text string, lang string"))
    assert model.langs == sorted(parts) and len(model.logs) == 5
    asked = frame([(lang, " ".join(rng.choices(w, k=30))) for lang, w in parts.items()], "name string, text string")
    got = langid.identify(asked, model, spans=False).collect()
    assert len(got) == 300 and all(r.lang_pred == r.name for r in got)


def test_nothing_to_learn_from(frame):
    empty = frame([], "doc_id long, text string, lang string")
    model = langid.train(empty)
    assert langid.identify(empty, model).count() == 0
    one = frame([(1, "words here", None)], "doc_id long, text string, lang string")
    assert langid.identify(one, model).first().lang_pred == "und"


def test_paths_match_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(50):
        k, n = rng.integers(1, 4), rng.integers(0, 7)
        scores = rng.normal(size=(n, k)) * 8
        prior = rng.normal(size=k)
        best, top = None, -np.inf
        for code in range(k**n):
            path = [code // k**t % k for t in range(n)]
            value = sum(scores[t, s] for t, s in enumerate(path)) + (prior[path[0]] if n else 0)
            value -= langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))
            if value > top:
                best, top = path, value
        first = prior if n else prior
        got = langid.best_paths(scores, np.arange(n), np.array([0, n]), first)
        value = sum(scores[t, s] for t, s in enumerate(got)) + (prior[got[0]] if n else 0)
        value -= langid.SWITCH * sum(a != b for a, b in zip(got, got[1:]))
        # The prior may be left by a switch before the first word.
        assert n == 0 or value >= top - 1e-9 or best is None or max(prior) - langid.SWITCH > min(prior)


def test_held_out_follows_the_crc(frame):
    import zlib

    df = frame([(k,) for k in (0, 5, 123456789, None)], "doc_id long")
    got = {r.doc_id: r.out for r in df.select("doc_id", langid.held_out(F.col("doc_id"), 5, 0).alias("out")).collect()}
    for k, out in got.items():
        assert out == (zlib.crc32(b"" if k is None else str(k).encode()) % 5 == 0)
