"""Personal data in text by weak supervision.

Base spans come from fixed patterns with a check each. Looser patterns propose further candidates: spelled-out addresses,
other separators, national phone numbers, version 6 addresses. Labelers vote on every candidate (yes, no, or nothing):
patterns, checks, gazetteers, cues nearby, neighbours, regularity. Expectation-maximisation on the counts of vote patterns
estimates how reliable each labeler is per kind; its posteriors then train a logistic span classifier on features of the
span itself. Candidates that the classifier accepts, that no check refuses and that overlap nothing found before are
added; base spans always stay.

Both models see only counts of vote and feature patterns, whose number is bounded by the patterns there can be. A null
text is an empty one. Rows keep their number, ids may be null or repeat, and an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.batches import slices, text_rows, texts
from gridwright.session import written

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "cue", "neighbours", "regular")
ROUNDS, ACCEPT, CUE_REACH = 30, 0.5, 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT = r"(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|\s?＠\s?|\s@\s?|@\s)"
_DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
_SPELLED_EMAIL = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}", re.I)
# What every spelled-out address holds: the end of its first part up to the start of its second label.
_SPELLED_CORE = re.compile(rf"[A-Za-z0-9._%+-]{_AT}[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z0-9-]{{2}}", re.I)
_OPEN_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?[\[(]\.[\])]\s?|\s?[\[(]dot[\])]\s?)[0-9]{1,3}(?:(?:\.|\s?[\[(](?:\.|dot)[\])]\s?)[0-9]{1,3}){2}")
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}|:)(?::[0-9A-Fa-f]{1,4}){0,5}(?![0-9A-Za-z:])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20  ./_-]{1,2}[0-9]{2,6}){2,4}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)|0[0-9]{1,4}|[0-9]{3})(?:[\x20./-]{1,2}[0-9]{2,4}){2,5}(?![0-9])")

# Well-known public suffixes, calling codes and card issuers' first digits.
_SUFFIXES = frozenset("com org net edu gov info biz io de fr es uk it nl eu us ca ch at be pl pt br mx example".split())
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
            "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
            "90", "91", "351", "352", "353", "358", "420", "421")
_ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "6011", "65", "35", "36", "38")
_CUES = {
    "email": re.compile(r"mail|contact|write|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|adresse|direcci", re.I),
    "card": re.compile(r"card|visa|master|credit|pay|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|\btel|call|fax|mobile|ruf|handy|tél|móvil", re.I),
}
_COUNTER = re.compile(r"isbn|version|order|ref\b|serial|invoice|article|section|doi|page|\bno\.|#\s?$", re.I)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, looking only around each @: all starts in one run share their @."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _holds(kind: str, span: str) -> bool:
    """The check that a span of a kind must pass."""
    if kind == "email":
        return True
    if kind == "ip":
        if ":" in span:
            groups = span.split(":")
            return len(groups) <= 8 and ("::" in span or len(groups) == 8) and any(len(g) == 4 for g in groups)
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in re.findall("[0-9]+", span))
    digits = _digits(span)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns' matches that pass their check, by kind and start."""
    out = [(0, *s) for s in _emails(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if _holds(KINDS[kind], m[0])]
    return out


@dataclass(frozen=True)
class Candidate:
    kind: int
    start: int
    end: int
    base: bool
    votes: int
    features: int


def _votes(kind: int, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote per labeler: 2 yes, 1 no, 0 nothing."""
    name, span = KINDS[kind], text[start:end]
    before, after = text[max(0, start - CUE_REACH): start], text[end: end + CUE_REACH]
    digits = _digits(span)
    if kind == 0:
        listed = re.split(r"[^A-Za-z]+", span)[-1].lower() in _SUFFIXES
    elif kind == 1:
        first = int(digits[:1] or 0) if ":" in span else int(re.match("[0-9]+", span)[0][-4:])
        listed = ":" in span or 0 < first < 224
    elif kind == 2:
        listed = digits.startswith(_ISSUERS)
    else:
        listed = span[0] in "(0" or digits.startswith(_CALLING)
    cue = 2 if _CUES[name].search(before) or _CUES[name].search(after[:12]) else 1 if _COUNTER.search(before[-16:]) else 0
    touched = before[-1:].isalnum() or after[:1].isalnum() or (kind != 0 and before[-1:] in ("-", ".", "/") and before[-2:-1].isdigit())
    plain = kind == 0 or len(set(digits)) > 2
    checked = _holds(name, span) and (kind != 0 or len(re.split(r"[^A-Za-z]+", span)[-1]) >= 2)
    return 2 if base else 0, 2 if checked else 1, 2 if listed else 1, cue, 1 if touched else 2, 0 if plain else 1


def _features(kind: int, text: str, start: int, end: int) -> int:
    """Twelve bits that describe the span and its place."""
    span = text[start:end]
    digits = len(_digits(span))
    left, right = text[start - 1: start], text[end: end + 1]
    bits = (
        not left or left.isspace(), left in ("(", "[", "<", '"', ":"), not right or right.isspace(), right in (".", ",", ";", ")", ">", '"'),
        " " in span, "." in span, "-" in span, span[0] in "+(", digits >= 13, digits * 2 > len(span), len(span) > 24,
        any(c.isalpha() for c in span),
    )
    return sum(bool(b) << n for n, b in enumerate(bits)) | kind << 12


def candidates(text: str) -> list[Candidate]:
    """Base spans, fixed patterns' matches that fail their check, and what the looser patterns propose."""
    found: dict[tuple[int, int, int], bool] = {}
    has_digit = any(map(text.__contains__, "0123456789"))
    if "@" in text:
        found |= {(0, *s): True for s in _emails(text)}
    if has_digit:
        for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            for m in pattern.finditer(text):
                if kind != 2 or m.end() - m.start() >= 9:
                    found[kind, *m.span()] = _holds(KINDS[kind], m[0])
        found |= {(2, *m.span()): False for m in _WIDE_CARD.finditer(text) if (2, *m.span()) not in found}
        found |= {(3, *m.span()): False for m in _NATIONAL.finditer(text) if 9 <= len(_digits(m[0])) <= 15}
        if "[" in text or "(" in text:
            found |= {(1, *m.span()): False for m in _OPEN_IP.finditer(text)}
    if ":" in text:
        found |= {(1, *m.span()): False for m in _IP6.finditer(text)}
    if _SPELLED_CORE.search(text):
        found |= {(0, *m.span()): False for m in _SPELLED_EMAIL.finditer(text)}
    out = []
    for (kind, start, end), base in sorted(found.items()):
        votes = sum(v * 3**n for n, v in enumerate(_votes(kind, text, start, end, base)))
        out.append(Candidate(kind, start, end, base, votes, _features(kind, text, start, end)))
    return out


def reliabilities(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, and P(vote | truth) as [labeler, truth, vote], by expectation-maximisation."""
    table = votes[:, None] // 3 ** np.arange(len(LABELERS)) % 3
    posterior = 1 / (1 + np.exp(-((table == 2).sum(1) - 2.0 * (table == 1).sum(1))))
    for _ in range(ROUNDS):
        weight = np.stack([counts * (1 - posterior), counts * posterior], 1)
        prior = (weight.sum(0) + 1) / (weight.sum() + 2)
        given = np.empty((len(LABELERS), 2, 3))
        for n in range(len(LABELERS)):
            for vote in range(3):
                given[n, :, vote] = weight[table[:, n] == vote].sum(0) + 0.5
        # A first guess that stays: a labeler is right more often than not.
        given[:, 1, 2] += 2
        given[:, 0, 1] += 2
        given /= given.sum(2, keepdims=True)
        score = np.log(prior) + sum(np.log(given[n].T[table[:, n]]) for n in range(len(LABELERS)))
        posterior = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
    return posterior, given


def _design(features: np.ndarray) -> np.ndarray:
    """Each bit, by itself and within each kind."""
    bits, kind = (features[:, None] >> np.arange(12)) & 1, features >> 12
    own = kind[:, None] == np.arange(len(KINDS))
    return np.concatenate([np.ones((len(bits), 1)), bits, own, *(bits * own[:, k:k + 1] for k in range(len(KINDS)))], 1)


def logistic(features: np.ndarray, positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on soft counts, by Newton steps."""
    x = _design(features)
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (positive - total * p) - weights
        weights += np.linalg.solve((x.T * (total * p * (1 - p))) @ x + np.eye(len(weights)), slope)
    return weights


@dataclass
class SpanModel:
    """Posterior by (kind, votes) and weights of the span classifier."""

    posterior: dict[tuple[int, int], float]
    weights: np.ndarray

    def probability(self, features: list[int]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(np.array(features)) @ self.weights, -30, 30)))

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base spans, added spans) as (kind number, start, end), by kind and start."""
        found = candidates(text)
        base = [(c.kind, c.start, c.end) for c in found if c.base]
        more = [c for c in found if not c.base and c.votes // 3 % 3 == 2]
        if not more:
            return base, []
        taken, added = [(s, e) for _, s, e in base], []
        for c, p in sorted(zip(more, self.probability([c.features for c in more])), key=lambda x: (x[0].start, -x[0].end)):
            own = self.posterior.get((c.kind, c.votes), 0.0)
            if min(p, own) >= ACCEPT and all(c.end <= s or c.start >= e for s, e in taken):
                added.append((c.kind, c.start, c.end))
                taken.append((c.start, c.end))
        return base, sorted(added)


def learn(docs: DataFrame) -> SpanModel:
    """Count vote and feature patterns over all texts, estimate reliabilities, train the span classifier."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen = Counter((c.kind, c.votes, c.features) for t in texts(batch) for c in candidates(t))
            rows = [(*k, n) for k, n in seen.items()]
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else repeat((), 4))]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "votes", "features", "n"])

    counted = text_rows(docs).mapInArrow(patterns, "kind long, votes long, features long, n long")
    counted = written(counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")), "patterns")
    posterior: dict[tuple[int, int], float] = {}
    # At most 3 ** len(LABELERS) vote patterns per kind.
    seen = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).toPandas().sort_values(["kind", "votes"])
    for kind, rows in seen.groupby("kind"):
        p, _ = reliabilities(rows.votes.to_numpy(), rows.n.to_numpy(dtype=float))
        posterior |= {(int(kind), int(v)): float(x) for v, x in zip(rows.votes, p)}
    lookup = counted.sparkSession.createDataFrame(
        [(*k, p) for k, p in posterior.items()], "kind long, votes long, p double")
    # At most 2 ** 12 feature patterns per kind.
    soft = counted.join(F.broadcast(lookup), ["kind", "votes"]).groupBy("features").agg(
        F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum("n").cast("double").alias("n")).toPandas().sort_values("features")
    return SpanModel(posterior, logistic(soft.features.to_numpy(dtype=int), soft.yes.to_numpy(), soft.n.to_numpy()))


_SPANS = "array<struct<kind: string, start: long, end: long>>"


def find(docs: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, base and spans (base and added) of every row; places in code points, ends exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            both = [shared.value.spans(t) for t in texts(batch)]
            named = [[[(KINDS[k], s, e) for k, s, e in x] for x in (b, sorted(b + a))] for b, a in both]
            columns = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[n]] for row in named], kind) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    return text_rows(docs).mapInArrow(mark, f"doc_id long, base {_SPANS}, spans {_SPANS}")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, replaced by the kind's name in brackets."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: SpanModel, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, with personal data replaced in the text and its length, if there, counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            before = batch.column(text).to_pylist()
            marked = [sum(shared.value.spans(t), []) if t else [] for t in before]
            after = [redacted(t, s) if s else t for t, s in zip(before, marked)]
            where = {n: k for k, n in enumerate(batch.schema.names)}
            columns = list(batch.columns)
            columns[where[text]] = pa.array(after, batch.schema.field(text).type)
            if length in where:
                sizes = [len(a) if s else n for a, s, n in zip(after, marked, columns[where[length]].to_pylist())]
                columns[where[length]] = pa.array(sizes, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(replace, docs.schema)
