"""Personal data by weak supervision.

Base spans come from fixed patterns and checks and always stay. Wider patterns propose further spans.
Labelers (pattern, gazetteer, context, borders, shape, digits) vote for or against each proposal;
expectation-maximisation over the counts of the vote patterns estimates how far each labeler can be
trusted; its posteriors train a span classifier, which decides about the proposals.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import hash_unit, quoted, stored, without

KINDS = ("email", "ip", "card", "phone")
#: Bound of the classifier's training sample, in proposed spans.
SAMPLE_SPANS = 20000
#: Characters of context on either side.
CONTEXT = 40
#: Buckets of the classifier's context words.
WORD_BUCKETS = 256

# Gazetteers (fixed values): top-level domains, calling codes, leading digits of payment cards.
TLDS = frozenset(
    "com org net edu gov mil int info biz io co de fr es it nl be at ch uk eu us ca au nz in jp cn "
    "br mx ar cl pt pl cz se no dk fi ie ru ua tr gr ro hu example test invalid".split()
)
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
    "65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 356 357 358 359 370 371 372 380 385 386 "
    "420 421".split()
)
CARD_HEADS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|30[0-5]|3[68]")
# Context words (fixed values) for and against each kind, in the languages of the corpora.
CONTEXT_FOR = {
    "email": "email mail e-mail contact kontakt correo courriel write schreiben adresse address",
    "ip": "ip host server address adresse dirección client login from addr",
    "card": "card visa mastercard amex credit kredit karte carte tarjeta payment zahlung",
    "phone": "phone tel telephone telefon teléfono téléphone mobile mobil fax call handy cell",
}
CONTEXT_AGAINST = "token sha hash isbn issn serial version order invoice id key build ref uuid doi"
_FOR = {k: frozenset(v.split()) for k, v in CONTEXT_FOR.items()}
_AGAINST = frozenset(CONTEXT_AGAINST.split())

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Proposals. Bounded repeats keep them linear.
_AT = re.compile(r"\x20?[(\[]\x20?at\x20?[)\]]\x20?|\x20at\x20|@")
_AFTER_AT = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[(\[]\x20?dot\x20?[)\]]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,4}"
)
_MORE_IP = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_MORE_CARD = re.compile(
    r"(?<![0-9])(?:[0-9]{4}([\x20.-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])"
)
_MORE_PHONE = re.compile(
    r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
    r"|(?<![0-9])[0-9]{9,11}(?![0-9])"
)
_WORDS = re.compile(r"[^\W_][\w-]*")


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _octets(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then by kind; time is linear in the text."""
    spans, floor = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append(Span(0, start, match.end()))
            floor = match.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    if _DIGIT.search(text):
        spans += [Span(1, *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
        spans += [
            Span(2, *m.span())
            for m in _CARD.finditer(text)
            if m.end() - m.start() >= 12 and _card(m[0])
        ]
        if "+" in text:
            spans += [
                Span(3, *m.span())
                for m in _PHONE.finditer(text)
                if 9 <= len(_digits(m[0])) <= 15
            ]
    return sorted(spans, key=lambda s: (s.start, s.kind, s.end))


def proposed_spans(text: str, base: list[Span]) -> list[Span]:
    """Further candidates, by start and then by kind; none overlaps a base span."""
    found: list[Span] = []
    if "dot" in text or "@" in text:
        floor = 0
        for match in _AT.finditer(text):
            start = match.start()
            while start > max(floor, match.start() - 64) and text[start - 1] in _LOCAL:
                start -= 1
            domain = _AFTER_AT.match(text, match.end()) if start < match.start() else None
            if domain and (match[0] == "@" or "dot" in domain[0]):
                found.append(Span(0, start, domain.end()))
                floor = domain.end()
    if _DIGIT.search(text):
        found += [Span(1, *m.span()) for m in _MORE_IP.finditer(text)]
        found += [Span(2, *m.span()) for m in _MORE_CARD.finditer(text) if _card(m[0])]
        found += [
            Span(3, *m.span())
            for m in _MORE_PHONE.finditer(text)
            if 9 <= len(_digits(m[0])) <= 15
        ]
    taken = Taken(base)
    return [s for s in sorted(found, key=lambda s: (s.start, s.kind)) if taken.leaves(s)]


class Taken:
    """The parts of a text that spans cover, as disjoint intervals in order."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((s.start, s.end) for s in spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def leaves(self, span: Span) -> bool:
        """Whether the span is free."""
        i = bisect_right(self.ends, span.start)
        return i == len(self.starts) or span.end <= self.starts[i]

    def add(self, span: Span) -> None:
        i = bisect_right(self.ends, span.start)
        self.starts.insert(i, span.start)
        self.ends.insert(i, span.end)


def votes(text: str, span: Span) -> tuple[int, ...]:
    """1 for, -1 against, 0 abstains: pattern, gazetteer, context, borders, shape, digits."""
    kind, body = KINDS[span.kind], text[span.start : span.end]
    digits = _digits(body)
    before, after = text[max(0, span.start - 1) : span.start], text[span.end : span.end + 1]
    words = [w.lower() for w in _WORDS.findall(text[max(0, span.start - CONTEXT) : span.start])[-4:]]
    strict = {0: "@" in body, 1: "." in body, 2: len(digits) >= 13, 3: body.startswith("+")}[span.kind]
    if span.kind == 0:
        tail = re.split(r"[^A-Za-z0-9-]+", body.strip(")]"))[-1].lower()
        listed = 1 if tail in TLDS else -1
        shape = 1 if re.search(r"[A-Za-z]", body.split("@")[0]) else -1
        spread = 0
    elif span.kind == 1:
        listed = 1 if ":" in body or body.split(".")[0] not in {"0", "255"} else -1
        shape = 1 if not re.search(r"(?:^|\.)0[0-9]", body) else -1
        spread = 1 if len(set(digits)) >= 3 else -1
    elif span.kind == 2:
        listed = 1 if CARD_HEADS.match(digits) else -1
        shape = 1 if len(digits) in {13, 15, 16, 19} else -1
        spread = 1 if len(set(digits)) >= 4 else -1
    else:
        code = body.startswith("+") and any(digits[:k] in CALLING_CODES for k in (1, 2, 3))
        listed = 1 if code else (-1 if body.startswith("+") else 0)
        shape = 1 if re.search(r"[(\x20.-]", body) else -1
        spread = 1 if len(set(digits)) >= 4 else -1
    context = 0
    if any(w in _FOR[kind] for w in words):
        context = 1
    elif any(w in _AGAINST for w in words):
        context = -1
    joined = (before.isalnum() or before == "_") or (after.isalnum() or after == "_")
    return (1 if strict else -1, listed, context, -1 if joined else 1, shape, spread)


def features(text: str, span: Span, given: tuple[int, ...]) -> list[int]:
    """Active feature numbers of the classifier: votes, length class and hashed words around."""
    out = [span.kind]
    out += [4 + 3 * i + v + 1 for i, v in enumerate(given)]
    out.append(22 + min(span.end - span.start, 39) // 5)
    left = _WORDS.findall(text[max(0, span.start - CONTEXT) : span.start])[-2:]
    right = _WORDS.findall(text[span.end : span.end + CONTEXT])[:1]
    for place, words in (("l", left), ("r", right)):
        out += [30 + zlib.crc32(f"{place}{w.lower()}".encode()) % WORD_BUCKETS for w in words]
    return sorted(set(out))


DIM = 30 + WORD_BUCKETS


def dawid_skene(
    patterns: list[tuple[int, ...]], counts: np.ndarray, steps: int = 200
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the patterns and reliabilities ``[labeler, class, vote]`` by EM.

    Votes are independent given the class. It starts from the share of votes in favour; counts are
    smoothed, each labeler starting as rather right than wrong.
    """
    table = np.array(patterns)
    one_hot = np.stack([(table == v) for v in (-1, 0, 1)], axis=2).astype(float)
    posterior = 1 / (1 + np.exp(-table.sum(axis=1).astype(float)))
    prior = np.array([[[2.0, 1.0, 1.0], [1.0, 1.0, 2.0]]])
    reliability = np.zeros((table.shape[1], 2, 3))
    for _ in range(steps):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        reliability = np.einsum("cp,plv->lcv", weight, one_hot) + prior
        reliability /= reliability.sum(axis=2, keepdims=True)
        share = np.clip((weight.sum(axis=1) + 1) / (weight.sum() + 2), 1e-6, 1)
        logs = np.einsum("plv,lcv->pc", one_hot, np.log(reliability)) + np.log(share)
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            posterior = new
            break
        posterior = new
    return posterior, reliability


def train_classifier(
    rows: list[list[int]], targets: np.ndarray, numbers: np.ndarray | None = None, steps: int = 300
) -> np.ndarray:
    """Logistic regression on soft targets with an L2 penalty; the last weight is the bias.

    ``numbers`` says how often each row occurs, by default once.
    """
    numbers = np.ones(len(rows)) if numbers is None else numbers
    flat = np.array([f for r in rows for f in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    theta = np.zeros(DIM + 1)
    n = max(float(numbers.sum()), 1.0)
    for step in range(steps):
        logit = np.bincount(owner, theta[flat], len(rows)) + theta[-1]
        wrong = (1 / (1 + np.exp(-logit)) - targets) * numbers
        gradient = np.bincount(flat, wrong[owner], DIM + 1) / n
        gradient[-1] = wrong.sum() / n
        theta -= (4.0 / (1 + step / 100)) * (gradient + 1e-4 * theta)
    return theta


@dataclass(frozen=True)
class PiiModel:
    """Reliabilities of the labelers by kind, and the classifier's weights."""

    reliabilities: dict[str, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM + 1))

    def accepts(self, text: str, span: Span) -> float:
        """The probability of a proposed span."""
        active = features(text, span, votes(text, span))
        return float(1 / (1 + np.exp(-(self.weights[active].sum() + self.weights[-1]))))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans and added spans; of added spans that overlap, the likelier stays."""
        base = base_spans(text)
        scored = [(self.accepts(text, s), s) for s in proposed_spans(text, base)]
        added: list[Span] = []
        taken = Taken([])
        for _, span in sorted(((-p, s) for p, s in scored if p > 0.5), key=lambda x: (x[0], x[1])):
            if taken.leaves(span):
                taken.add(span)
                added.append(span)
        return base, sorted(added, key=lambda s: (s.start, s.kind))


def fit(docs: DataFrame, text: str = "text", sample_spans: int = SAMPLE_SPANS) -> PiiModel:
    """Labeler reliabilities from the proposals and base spans of all texts, and the classifier.

    The vote patterns of all spans are counted on the cluster; only the counts (at most 3 to the number
    of labelers for each kind) reach the driver. The classifier trains on about ``sample_spans`` spans
    at most, chosen by hash. Without spans, nothing is added to the base.
    """

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [("kind", pa.int32()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))]
        )
        for array in arrays:
            out = []
            for cell in array:
                body = cell.as_py() or ""
                base = base_spans(body)
                rows = []
                for span in [*base, *proposed_spans(body, base)]:
                    given = votes(body, span)
                    rows.append(
                        {
                            "kind": span.kind,
                            "votes": ",".join(map(str, given)),
                            "features": features(body, span, given),
                        }
                    )
                out.append(rows)
            yield pa.array(out, pa.list_(kind))

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(convert, "array<struct<kind: int, votes: string, features: array<int>>>")
    spans = stored(docs.select(F.explode(found(F.col(text))).alias("s")).select("s.*"))
    counted = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in counted)
    if not total:
        return PiiModel()
    reliabilities, posteriors = {}, {}
    for kind, name in enumerate(KINDS):
        rows = sorted((r["votes"], r["n"]) for r in counted if r["kind"] == kind)
        if rows:
            patterns = [tuple(map(int, v.split(","))) for v, _ in rows]
            posterior, reliability = dawid_skene(patterns, np.array([float(n) for _, n in rows]))
            reliabilities[name] = reliability
            posteriors.update({(kind, v): p for (v, _), p in zip(rows, posterior, strict=True)})
    # Equal spans train once, with their number as weight: copies of a document cost nothing.
    different = spans.groupBy("kind", "votes", "features").agg(F.count("*").alias("n"))
    key = F.concat_ws("|", F.col("votes"), F.array_join("features", ","))
    kinds = different.count()
    if kinds > sample_spans:
        different = different.where(hash_unit(key) < sample_spans / kinds)
    sample = sorted((r["kind"], r["votes"], r["features"], r["n"]) for r in different.collect())
    targets = np.array([posteriors[k, v] for k, v, _, _ in sample])
    numbers = np.array([float(n) for *_, n in sample])
    return PiiModel(reliabilities, train_classifier([f for _, _, f, _ in sample], targets, numbers))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def find(docs: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """``docs`` with the number of base spans of each kind, a digest of them, and all spans.

    Adds ``n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256`` (of ``kind:start:end`` joined
    by commas, by start and then kind), ``spans`` (base and added ones, joined likewise) and
    ``n_added``. Offsets are code points, ends exclusive. NULL counts as empty: no spans, the digest of
    the empty string. One row per input row; output names replace input columns.
    """
    numbers = ["n_email", "n_ip", "n_card", "n_phone"]
    names = [*numbers, "base_sha256", "spans", "n_added"]

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            rows = [model.spans(x.as_py() or "") for x in array]
            columns = [
                pa.array([sum(s.kind == k for s in base) for base, _ in rows], pa.int64())
                for k in range(len(KINDS))
            ]
            columns.append(
                pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in rows])
            )
            merged = [sorted([*a, *b], key=lambda s: (s.start, s.kind, s.end)) for a, b in rows]
            columns.append(pa.array([listed(m) for m in merged], pa.string()))
            columns.append(pa.array([len(b) for _, b in rows], pa.int64()))
            yield pa.StructArray.from_arrays(columns, names=names)

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    schema = ", ".join(f"{n} {'string' if n in ('base_sha256', 'spans') else 'long'}" for n in names)
    base = without(docs, names)
    columns = [F.col(quoted(c)) for c in base.columns]
    udf = F.arrow_udf(convert, schema).asNondeterministic()
    return base.withColumn("__found", udf(F.col(text))).select(
        *columns, *[f"__found.{n}" for n in names]
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span of a ``spans`` list replaced by its kind in angle brackets."""

    def convert(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in arrays:
            out = []
            for body, given in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
                if body is None or not given:
                    out.append(body)
                    continue
                parts, end = [], 0
                for item in given.split(","):
                    kind, a, b = item.split(":")
                    if int(a) >= end:
                        parts += [body[end : int(a)], f"<{kind}>"]
                    end = max(end, int(b))
                out.append("".join([*parts, body[end:]]))
            yield pa.array(out, pa.string())

    convert.__annotations__ = {
        "arrays": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(convert, "string")(text, spans)
