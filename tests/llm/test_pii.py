import re

from hypothesis import example, given, settings
from hypothesis import strategies as st

from tristrata.llm import pii
from tristrata.llm.queries import op6_personal_data  # noqa: F401

SCHEMA = "doc_id long, text string, spans string, found int"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, m.end()))
    return sorted(out)


@given(st.text(alphabet="a.@-+%1 2(9)05é_", max_size=60))
@example("a@b.c@d.e%x@y.z")
@example("4111 1111 1111 1111 and 4111-1111-1111-1112")
@example("+1 (873) 555-4781 x 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4")
@settings(max_examples=500, deadline=None)
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_further_candidates_overlap_nothing():
    text = "x@y.org +1 (269) 555-3296 4524132264652876 and 123-45-6789, Mr Paul Smith, call 617-555-1234"
    base = pii.base_spans(text)
    further = pii.further_spans(text, base)
    assert {pii.KINDS[k] for _, k, _ in further} >= {"ssn", "name", "tel"}
    taken = sorted([(a, b) for a, _, b in further])
    assert all(x[1] <= y[0] for x, y in zip(taken, taken[1:]))
    for a, _, b in further:
        assert all(b <= c or a >= d for c, _, d in base)


def test_names_are_found_after_any_word():
    texts = {
        "Dear Maria Schmidt, hello": ["Maria Schmidt"],
        "Contact John Smith": ["John Smith"],
        "By Anna Brown. Yesterday Dr. Peter Weber spoke": ["Anna Brown", "Dr. Peter Weber"],
        "Ask José García or Señora Núñez": ["José García", "Señora Núñez"],
        "Señor Ángel Ibáñez": ["Señor Ángel Ibáñez"],
        "Herr Łukasz Żak and Frau Öztürk": ["Herr Łukasz Żak", "Frau Öztürk"],
        "Berlin Wall, Anna said; Annabel Lee; xMaria Schmidt; Maria SCHMIDT": [],
    }
    for text, names in texts.items():
        assert [text[a:b] for a, _, b in pii.further_spans(text, [])] == names


def test_reliabilities_find_the_good_labelers():
    import numpy as np

    rng = np.random.default_rng(4)
    n, counts, truth = 4000, {}, {}
    for _ in range(n):
        z = rng.random() < 0.6
        cast = []
        for j in range(len(pii.LABELERS)):
            good = 0.9 if j < 4 else 0.5
            cast.append((1 if (rng.random() < good) == z else -1) if rng.random() < 0.8 else 0)
        code = pii.pattern_of(0, tuple(cast))
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, []).append(z)
    chance, theta = pii.reliabilities(counts)
    right = sum((chance[c] > 0.5) == v for c, z in truth.items() for v in z)
    assert right / n > 0.9
    assert theta[:4, 1].min() > 0.85 and theta[:4, 0].max() < 0.15
    assert abs(theta[5] - 0.5).max() < 0.1


def test_rows(spark):
    rows = [
        (1, "write to jo.doe@mail.org or call +49 (30) 1234567 é"),
        (2, None),
        (3, ""),
        (4, "nothing here"),
        (4, "nothing here"),
        (None, "host 10.20.30.40 é 4111 1111 1111 1111"),
        (5, "é" * 100_000 + " a@b.co"),
    ]
    rows += [(100 + k, f"call 617-555-{1000 + 7 * k} or mail u{k}@x.org, card 4111 1111 1111 1111") for k in range(60)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    got = pii.find(df)
    assert got.columns == ["doc_id", "text", "found", "spans"]
    for r in got.collect():
        base = [(s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if s.base]
        assert base == brute(r.text or "")
        assert [(s.start, pii.KINDS.index(s.kind)) for s in r.spans] == sorted((s.start, pii.KINDS.index(s.kind)) for s in r.spans)
    calls = [r for r in got.collect() if r.doc_id and r.doc_id >= 100]
    assert all("tel" in {s.kind for s in r.spans} for r in calls)
    assert pii.find(df.limit(0)).count() == 0
    assert [list(r.spans) for r in pii.find(df.where("doc_id = 4")).collect()] == [[], []]
