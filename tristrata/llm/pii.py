"""Personal data: labelers vote on candidate spans, EM weighs them, a classifier decides.

Every whole text is searched for base spans (e-mail, IP, card, phone), which always stay, and for
further candidates: numbers and names whose form alone does not settle the matter. On every
candidate seven labelers vote yes, no or not at all: by pattern, gazetteer and context. The counts
of vote patterns (a table of bounded size) go into an expectation-maximisation that estimates how
reliable each labeler is and how likely each pattern is personal data. A logistic classifier over
features of the span and its surroundings is trained on these estimates by Newton steps on sums
over all partitions; further candidates that it accepts, and that overlap no base span, are added.

Defined results: null and empty texts have no spans; a table without candidates gives rows without
spans; repeated rows get equal spans, and count as often in the estimates; other columns are not
looked at. Memory is bounded by pieces of texts; a text must fit into a task.
"""

from __future__ import annotations

import bisect
import re
import sys
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.arrowtext import SUMS, partial_sums, pieces, summed
from tristrata.scratch import staged

BASE = ["email", "ip", "card", "phone"]
FURTHER = ["tel", "pan", "ssn", "iban", "ip6", "birth", "name"]
KINDS = BASE + FURTHER
LABELERS = ["form", "check", "gazetteer", "context", "counter", "edges", "shape"]
#: Candidates are added when the classifier gives them at least this probability.
ACCEPT = 0.5
#: Characters on either side that context labelers read.
BEFORE, AFTER = 40, 20
NEWTON_STEPS, RIDGE = 8, 1e-2
EM_STEPS = 60
#: Right votes that a labeler is credited with for each wrong one before any are counted.
PRIOR = 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile("[0-9]")
# A match cannot begin inside a run of digits, so that long runs are read once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
FURTHER_PATTERNS = {
    "tel": re.compile(r"(?<![\w+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![\w-])"),
    "pan": re.compile(r"(?<![0-9])[3-6][0-9]{3}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "ip6": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "birth": re.compile(r"(?<![\w./-])[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4}(?![\w./-])"),
}

# Gazetteers and context words, in four languages.
TITLES = frozenset("Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra".split())
GIVEN = frozenset(
    "Alexander Alice Andrea Andrew Anna Anne Antonio Barbara Carlos Carmen Charles Charlotte"
    " Christian Christine Claire Daniel David Elena Elizabeth Emily Emma Eric Francisco Frank"
    " George Hans Helen Henry Isabel James Jan Jane Jean Jennifer Jessica John Jorge José Joseph"
    " Juan Julia Karen Karl Katharina Klaus Laura Linda Lisa Louis Lucas Luis Manuel Margaret"
    " Maria Marie Martin Mary Matthew Michael Michel Miguel Monika Nancy Nicolas Olivia Oliver"
    " Patricia Paul Peter Philippe Pierre Richard Robert Sandra Sarah Sofia Sophie Stefan Stephen"
    " Susan Thomas Ursula Walter William Wolfgang".split()
)
UPPER = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isupper())
LOWER = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.islower())
WORD = f"[{re.escape(UPPER)}][{re.escape(LOWER)}]+"
# Looked up from the listed word, whatever stands before it; matches may overlap.
NAME = re.compile(
    rf"(?<!\w)(?=((?:{'|'.join(sorted(TITLES | GIVEN))})\.? {WORD}(?: {WORD})?)(?!\w))"
)
TOP_DOMAINS = frozenset("at ch com de edu es eu fr gov info int io it mil net nl org uk us".split())
WORDS_FOR = {
    "email": "email e-mail mail contact write courriel correo kontakt schreiben",
    "ip": "ip host server address client adresse dirección",
    "card": "card visa mastercard amex credit karte carte tarjeta payment",
    "phone": "phone tel telephone call mobile cell fax telefon anruf téléphone teléfono móvil handy",
    "ssn": "ssn social security",
    "iban": "iban account bank konto compte cuenta",
    "birth": "born birth birthday dob geboren geburtsdatum né née naissance nacido nacimiento",
    "name": "name named dear sincerely regards author by signed nom nombre",
}
WORDS_FOR |= {"tel": WORDS_FOR["phone"], "pan": WORDS_FOR["card"], "ip6": WORDS_FOR["ip"]}
CONTEXT = {kind: frozenset(text.split()) for kind, text in WORDS_FOR.items()}
COUNTER = frozenset(
    "version isbn issn order invoice part section figure table page chapter total price serial"
    " model patent release id no nr ref".split()
)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches, found from their @ so that no text is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
        done = tail.end() if tail else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base kinds, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = digits_of(m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def further_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the further kinds that overlap no base span and no earlier candidate."""
    found = []
    if DIGIT.search(text):
        for kind, pattern in FURTHER_PATTERNS.items():
            number = KINDS.index(kind)
            found += [(m.start(), number, m.end()) for m in pattern.finditer(text)]
    found += [(m.start(1), KINDS.index("name"), m.end(1)) for m in NAME.finditer(text)]
    begins = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))
    out, done = [], 0
    for start, kind, end in sorted(found, key=lambda s: (s[0], -s[2], s[1])):
        # The furthest end of all base spans that begin before this candidate's end.
        ahead = bisect.bisect_left(begins, end)
        if start >= done and (not ahead or reach[ahead - 1] <= start):
            out.append((start, kind, end))
            done = end
    return out


def checked(kind: str, value: str, digits: str) -> int:
    """Vote by a check digit or a range of values."""
    if kind in ("card", "pan"):
        return 1 if luhn(digits) and len(set(digits)) > 2 else -1
    if kind == "iban":
        flat = value.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in flat[4:] + flat[:4])
        return 1 if int(number) % 97 == 1 else -1
    if kind == "ssn":
        area, group, serial = value.split("-")
        return -1 if area in ("000", "666") or area > "899" or group == "00" or serial == "0000" else 1
    if kind == "ip":
        parts = [int(p) for p in value.split(".")]
        return -1 if parts[0] in (0, 127) or parts[0] >= 224 or max(parts) < 10 else 1
    if kind in ("tel", "phone"):
        return -1 if len(set(digits)) < 3 else 1
    if kind == "birth":
        numbers = [int(p) for p in re.split(r"[./-]", value)]
        years = [y for y in numbers if 1900 <= y <= 2030]
        return 1 if years and all(1 <= n <= 31 for n in numbers if n not in years) else -1
    return 0


def listed(kind: str, value: str) -> int:
    """Vote by gazetteer."""
    if kind == "email":
        return 1 if value.rpartition(".")[2].lower() in TOP_DOMAINS else 0
    if kind == "name":
        first, _, rest = value.partition(" ")
        return 1 if first.rstrip(".") in TITLES or (first in GIVEN and rest) else -1
    if kind in ("card", "pan"):
        return 1 if value[0] in "3456" else -1
    if kind == "phone":
        return 1 if value[1] != "0" else -1
    return 0


def votes(text: str, start: int, kind_number: int, end: int) -> tuple[int, ...]:
    kind, value = KINDS[kind_number], text[start:end]
    digits = digits_of(value)
    left = re.findall(r"[\w-]+", text[max(0, start - BEFORE) : start].lower())
    right = re.findall(r"[\w-]+", text[end : end + AFTER].lower())
    near = set(left[-5:] + right[:2])
    before, after = text[start - 1 : start], text[end : end + 1]
    separators = {c for c in value if not c.isalnum()}
    return (
        1 if kind_number < len(BASE) or kind in ("iban", "ip6") else 0,
        checked(kind, value, digits),
        listed(kind, value),
        1 if near & CONTEXT[kind] else 0,
        -1 if set(left[-2:]) & COUNTER or before in ("$", "€", "#") else 0,
        -1 if before.isalnum() or after.isalnum() else 1,
        1 if len(separators) <= 3 else -1,
    )


def pattern_of(kind: int, cast: tuple[int, ...]) -> int:
    code = kind
    for v in cast:
        code = code * 3 + v + 1
    return code


#: Parts of the feature vector and their sizes; a span has one feature of each part.
PARTS = {"kind": len(KINDS), "before": 5, "after": 5, "length": 6, "digits": 4, "left": 16, "right": 8}
N_FEATURES = sum(PARTS.values()) + 1


def char_kind(c: str) -> int:
    if not c:
        return 0
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features_of(text: str, start: int, kind: int, end: int) -> list[int]:
    """Numbers of the features that the span has."""
    value = text[start:end]
    left = re.findall(r"\w+", text[max(0, start - BEFORE) : start].lower())[-1:]
    right = re.findall(r"\w+", text[end : end + AFTER].lower())[:1]
    own = {
        "kind": kind,
        "before": char_kind(text[start - 1 : start] if start else ""),
        "after": char_kind(text[end : end + 1]),
        "length": min(len(value) // 5, 5),
        "digits": min(int(4 * len(digits_of(value)) / len(value)), 3),
        "left": zlib.crc32(left[0].encode()) % 16 if left else 0,
        "right": zlib.crc32(right[0].encode()) % 8 if right else 0,
    }
    out, off = [], 0
    for part, size in PARTS.items():
        out.append(off + own[part])
        off += size
    return [*out, off]


CANDIDATES = (
    "array<struct<kind:int,start:long,end:long,pattern:int,features:array<int>>>"
)
CANDIDATE_TYPE = pa.list_(
    pa.struct(
        [
            ("kind", pa.int32()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("pattern", pa.int32()),
            ("features", pa.list_(pa.int32())),
        ]
    )
)


def candidates(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``__found``: all candidates of each text."""
    schema = docs.select(keep).schema
    schema = T.StructType([*schema.fields, T.StructField("__found", T.DataType.fromDDL(CANDIDATES))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text_col):
            out = []
            for text in texts.to_pylist():
                base = base_spans(text)
                out.append(
                    [
                        {
                            "kind": kind,
                            "start": start,
                            "end": end,
                            "pattern": pattern_of(kind, votes(text, start, kind, end)),
                            "features": features_of(text, start, kind, end),
                        }
                        for start, kind, end in base + further_spans(text, base)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(out, CANDIDATE_TYPE)],
                names=[*keep, "__found"],
            )

    return docs.mapInArrow(search, schema)


def reliabilities(counts: dict[int, int]) -> tuple[dict[int, float], np.ndarray]:
    """Each pattern's probability of personal data, and P(yes | truth) of every labeler, for the
    truths no and yes, among its votes.

    Votes are independent given the truth, and not voting says nothing; each kind has a share of
    its own. The first guess is the balance of the votes, and the prior holds labelers to be
    right rather than wrong.
    """
    if not counts:
        return {}, np.full((len(LABELERS), 2), 0.5)
    codes = np.array(sorted(counts))
    many = np.array([counts[c] for c in codes.tolist()], float)
    cast, kind = [], codes.copy()
    for _ in LABELERS:
        cast.append(kind % 3 - 1)
        kind = kind // 3
    cast = np.array(cast[::-1])
    yes, no = cast > 0, cast < 0
    chance = 1 / (1 + np.exp(-cast.sum(0)))
    for _ in range(EM_STEPS):
        theta = np.zeros((len(LABELERS), 2))
        for truth, mass in ((1, many * chance), (0, many * (1 - chance))):
            good, bad = (yes * mass).sum(1), (no * mass).sum(1)
            up, down = (PRIOR, 1) if truth else (1, PRIOR)
            theta[:, truth] = (good + up) / (good + bad + up + down)
        total = np.bincount(kind, many, len(KINDS)) + 2
        share = (np.bincount(kind, many * chance, len(KINDS)) + 1) / total
        odds = np.log(share[kind]) - np.log(1 - share[kind])
        ratio = np.log(theta[:, 1]) - np.log(theta[:, 0])
        against = np.log(1 - theta[:, 1]) - np.log(1 - theta[:, 0])
        odds = odds + ratio @ yes + against @ no
        chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(codes.tolist(), chance.tolist())), theta


def train(found: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from all candidates of ``found``."""
    spans = found.select(F.explode("__found").alias("s")).select("s.pattern", "s.features")
    # One row per kind and combination of votes, at most.
    counts = {r["pattern"]: r["count"] for r in spans.groupBy("pattern").count().collect()}
    truth, _ = reliabilities(counts)
    shared = found.sparkSession.sparkContext.broadcast(truth)
    # Equal spans of features and votes are one weighted row.
    rows = staged(spans.groupBy("pattern", "features").count(), "spans")
    weights = np.zeros(N_FEATURES)
    for _ in range(NEWTON_STEPS if counts else 0):
        now = weights

        def slopes(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros((N_FEATURES, N_FEATURES + 1))
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = np.zeros((n, N_FEATURES))
                flat = batch.column("features").flatten().to_numpy()
                x[np.repeat(np.arange(n), len(PARTS) + 1), flat] = 1
                y = np.array([shared.value[p] for p in batch.column("pattern").to_pylist()])
                w = batch.column("count").to_numpy()
                p = 1 / (1 + np.exp(-np.clip(x @ now, -30, 30)))
                total[:, :-1] += x.T @ (x * (w * p * (1 - p))[:, None])
                total[:, -1] += x.T @ (w * (y - p))
            yield partial_sums({"slopes": total.ravel()})

        total = summed(rows.mapInArrow(slopes, SUMS))["slopes"].reshape(N_FEATURES, -1)
        many = sum(counts.values())
        ridge = RIDGE * np.sqrt(many) * np.eye(N_FEATURES)
        step = np.linalg.solve(total[:, :-1] + ridge, total[:, -1] - ridge @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``spans``: kind, start and end (code points, end
    exclusive) and whether it is a base span, by start, then kind."""
    names = [c for c in keep or docs.columns if c != "spans"]
    found = staged(candidates(docs, text_col, names), "candidates")
    weights = train(found)
    span = F.transform(
        F.filter(
            "__found",
            lambda s: (s["kind"] < len(BASE))
            | (
                F.aggregate(
                    s["features"],
                    F.lit(0.0),
                    lambda total, k: total
                    + F.element_at(F.array(*[F.lit(float(w)) for w in weights]), k + 1),
                )
                >= float(np.log(ACCEPT / (1 - ACCEPT)))
            ),
        ),
        # In this order an array sort is by start, then by kind.
        lambda s: F.struct(s["start"], s["kind"], s["end"]),
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        F.array_sort(span),
        lambda s: F.struct(
            F.element_at(kinds, s["kind"] + 1).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            (s["kind"] < len(BASE)).alias("base"),
        ),
    )
    return found.select(*names, spans.alias("spans"))
