"""Personal data by weak supervision.

One pass over the texts finds base spans by pattern, and further candidates: base matches that failed their test,
and values assigned to secret-like names. Regex, gazetteer and context labelers vote on every candidate. A candidate
is then no more than its kind, its votes and a few yes/no features, so the counts of these patterns over the whole
corpus are a small table. Expectation-maximisation on it estimates how reliable each labeler is for each kind; its
beliefs train the final span classifier, a logistic regression. The classifier can add spans; base spans always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from slotledger.llm.common import id_and_text, stored, with_text

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = 6
ACCEPT = 0.5
TEST_WEIGHT = 3
TEST_PRIOR = 0.98

# The base patterns.
_DIGIT_ZONE = re.compile(r"[0-9][0-9\x20().-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ASSIGNED = re.compile(
    r"(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\x20?[:=]{1,2}\x20?[\"']?([A-Za-z0-9+/_=.-]{12,}+)"
)

# Gazetteers.
_TOP_LEVEL = frozenset("com org net edu gov int mil info biz name io co us uk de fr es it nl eu ch at be pt pl".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38")
_CALLING_CODES = re.compile(r"1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|37[0-9]|38[0-9]|42[013]")
_CUES = {
    "email": re.compile(r"mail|contact|write|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|addr", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|kredit|tarjeta|carte", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|cell", re.I),
    "secret": re.compile(r"token|secret|passw|key", re.I),
}
_CONTRARY = re.compile(r"isbn|version|issn|order|invoice|example|sample|test|dummy|placeholder|serial|total|sum\b", re.I)
CONTEXT = 32


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    pattern: int


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that a long run without one is never scanned twice."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            yield start, free
        at = text.find("@", at + 1)


def numbers(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether its test is passed) of ip, card and phone matches, by kind and then by start."""
    ips, cards, phones = [], [], []
    for zone in _DIGIT_ZONE.finditer(text):
        if zone.end() - zone.start() >= 7:
            for m in _IP.finditer(text, *zone.span()):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                ips.append(("ip", *m.span(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)))
            for m in _CARD.finditer(text, *zone.span()):
                digits = m[0].replace(" ", "").replace("-", "")
                if len(digits) >= 12:
                    cards.append(("card", *m.span(), 13 <= len(digits) <= 19 and luhn(digits)))
    for m in _PHONE.finditer(text):
        phones.append(("phone", *m.span(), 9 <= sum(c.isdecimal() for c in m[0]) <= 15))
    yield from ips
    yield from cards
    yield from phones


def votes_and_features(text: str, kind: str, start: int, end: int, passed: bool) -> int:
    """The labelers' votes (0 no opinion, 1 personal, 2 not), three to the power of each, and then yes/no features."""
    value, before = text[start:end], text[max(0, start - CONTEXT) : start]
    after = text[end : end + 1]
    digits = sum(c.isdigit() for c in value)
    glued = (before[-1:].isalnum() and value[0].isalnum()) or (after.isalnum() and text[end - 1].isalnum())
    # regex labelers: the kind's own test, and its usual shape
    votes = [1 if passed else 2]
    if kind == "email":
        shape = end - start <= 254 and value.count("..") == 0
        listed = value.rsplit(".", 1)[-1].lower() in _TOP_LEVEL
    elif kind == "ip":
        shape = not value.startswith("0")
        listed = not value.startswith(("0.", "127.", "255."))
    elif kind == "card":
        shape = 13 <= digits <= 19
        listed = bool(_ISSUERS.match(value))
    elif kind == "phone":
        shape = 9 <= digits <= 15
        listed = bool(_CALLING_CODES.match(value, 1))
    else:
        shape = len(set(value)) >= 8
        listed = 3 <= digits < len(value)
    votes.append(1 if shape else 2)
    votes.append(1 if listed else 2)  # gazetteer labeler
    votes.append(1 if _CUES[kind].search(before) else 0)  # context labelers
    votes.append(2 if _CONTRARY.search(before) else 0)
    votes.append(2 if glued else 0)
    features = (passed, shape, listed, glued, digits * 2 >= len(value), after in ("", " ", "\n", ".", ",", '"', "'"))
    code = 0
    for vote in votes:
        code = code * 3 + vote
    for feature in features:
        code = code * 2 + bool(feature)
    return code * len(KINDS) + KINDS.index(kind)


def candidates(text: str) -> list[Candidate]:
    """Base spans, and candidates that overlap neither them nor each other; by kind as listed, then by start."""
    found = [("email", a, b, True) for a, b in emails(text)] + list(numbers(text))
    base = [x for x in found if x[3]]
    taken = sorted((a, b) for _, a, b, _ in base)
    # base spans of different kinds can overlap; the reach so far tells whether a gap is free
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    more = [x for x in found if not x[3]]
    if "=" in text or ":" in text:
        more += [("secret", *m.span(1), len(m[1]) >= 16) for m in _ASSIGNED.finditer(text)]
    last = -1
    for x in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
        k = bisect_right(starts, x[2] - 1)
        if x[1] >= last and (k == 0 or reach[k - 1] <= x[1]):
            base.append(x[:3] + ((x[3] and x[0] == "secret"),))
            last = x[2]
    out = []
    for kind, start, end, passed in base:
        own = kind != "secret" and passed
        out.append(Candidate(KINDS.index(kind), start, end, own, votes_and_features(text, kind, start, end, passed)))
    return sorted(out, key=lambda c: (c.kind, c.start))


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("pattern", pa.int64())])
_SPAN_SQL = "array<struct<kind: int, start: long, end: long, base: boolean, pattern: long>>"


def _spans_of(texts: pa.Array) -> pa.Array:
    rows = [[c._asdict() for c in candidates(t)] if t else [] for t in (x.as_py() for x in texts)]
    return pa.array(rows, pa.list_(_SPAN))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _spans_of(batch.column(1))], ["doc_id", "found"])


def decode_pattern(pattern: int) -> tuple[int, list[int], list[int]]:
    pattern, kind = divmod(pattern, len(KINDS))
    features, votes = [], []
    for _ in range(6):
        pattern, bit = divmod(pattern, 2)
        features.insert(0, bit)
    for _ in range(LABELERS):
        pattern, vote = divmod(pattern, 3)
        votes.insert(0, vote)
    return kind, votes, features


def label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM for labelers that are independent given the truth: beliefs for each pattern, and vote tables [class, labeler, vote].

    It starts from a majority in which a kind's own test (the first labeler) has TEST_WEIGHT votes, so class 1 keeps
    the meaning "personal". The prior says that this test is right in TEST_PRIOR of all cases, and counts as
    TEST_WEIGHT times the data; for the other labelers, counts of one smooth every table.
    """
    say = np.array([TEST_WEIGHT] + [1] * (votes.shape[1] - 1))
    for_, against = (votes == 1) @ say, (votes == 2) @ say
    belief = (for_ + 1) / (for_ + against + 2)
    tables = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        prior = (counts @ belief + 1) / (counts.sum() + 2)
        for cls, weight in ((0, counts * (1 - belief)), (1, counts * belief)):
            for j in range(votes.shape[1]):
                seen = np.bincount(votes[:, j], weight, 3) + 1
                if j == 0:
                    right, wrong = TEST_WEIGHT * weight.sum() * np.array([TEST_PRIOR, 1 - TEST_PRIOR])
                    seen += np.array([0, wrong, right] if cls == 0 else [0, right, wrong])
                tables[cls, j] = seen / seen.sum()
        logs = [np.log(tables[c, np.arange(votes.shape[1]), votes]).sum(1) for c in (0, 1)]
        odds = logs[1] - logs[0] + np.log(prior / (1 - prior))
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return belief, tables


def span_classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps on soft labels, with a small ridge; probabilities for the rows of x."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (target - p)) - weights
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def accepted_patterns(counted: list[tuple[int, int]]) -> list[int]:
    """The patterns that the trained classifier takes for personal data; ``counted``: (pattern, count) over the corpus."""
    accepted = []
    decoded = [(p, n, *decode_pattern(p)) for p, n in sorted(counted)]
    for kind in range(len(KINDS)):
        own = [x for x in decoded if x[2] == kind]
        if not own:
            continue
        votes, counts = np.array([x[3] for x in own]), np.array([x[1] for x in own], float)
        belief, _ = label_model(votes, counts)
        shown = np.concatenate([votes == 1, votes == 2, np.array([x[4] for x in own])], 1).astype(float)
        chance = span_classifier(shown, belief, counts)
        accepted += [x[0] for x, p in zip(own, chance, strict=True) if p >= ACCEPT]
    return accepted


def trained(found: DataFrame, column: str = "found") -> list[int]:
    """Count the patterns over all documents; there are no more of them than votes and features allow, so few are collected."""
    counts = found.select(F.explode(column).alias("c")).groupBy("c.pattern").count()
    return accepted_patterns([(r["pattern"], r["count"]) for r in counts.collect()])


def kept_spans(found: Column, accepted: list[int]) -> Column:
    listed = F.array(*map(F.lit, accepted)).cast("array<bigint>") if accepted else F.array().cast("array<bigint>")
    return F.filter(found, lambda c: c["base"] | F.array_contains(listed, c["pattern"]))


def personal_spans(docs: DataFrame) -> DataFrame:
    """All spans of personal data in every whole text: doc_id and an array of (kind, start, end, base, pattern).

    Offsets are code points, end exclusive; kind is an index in KINDS, and spans are ordered by kind, then start.
    Null and empty texts have no spans; repeated documents are treated one by one; further columns are not read; an
    empty table gives an empty one. The candidates of the whole corpus are stored once, without the texts.
    """
    found = stored(id_and_text(docs).mapInArrow(_scan, f"doc_id long, found {_SPAN_SQL}"), "pii")
    return found.select("doc_id", kept_spans(F.col("found"), trained(found)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _is(kind: int) -> Callable[[Column], Column]:
    return lambda other: other == kind


def digest(spans: DataFrame) -> DataFrame:
    """Counts and the digest of base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all columns are kept, n_chars follows the text.

    Texts without spans, null and empty ones are returned as they are; repeated rows are replaced each, and an empty table
    gives an empty one. Two passes over the texts: the first counts
    patterns (nothing but counts leaves the tasks), the second finds the same candidates again and replaces them.
    """
    found = docs.select(F.lit(0).cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    accepted = frozenset(trained(found.mapInArrow(_scan, f"doc_id long, found {_SPAN_SQL}")))

    @F.arrow_udf(StringType())
    def replaced(texts: pa.Array) -> pa.Array:
        new = []
        for text in (x.as_py() for x in texts):
            spans = [c for c in candidates(text) if c.base or c.pattern in accepted] if text else []
            new.append(redacted(text, spans) if spans else None)
        return pa.array(new, pa.string())

    return with_text(docs, replaced("text"))  # only texts that change come back from Python


def redacted(text: str, spans: list[Candidate]) -> str:
    """Spans of different kinds can overlap; what they cover together is replaced once, by the first one's kind."""
    out, at = [], 0
    for span in sorted(spans, key=lambda c: (c.start, -c.end)):
        if span.start >= at:
            out += [text[at : span.start], f"[{KINDS[span.kind].upper()}]"]
        at = max(at, span.end)
    return "".join([*out, text[at:]])
