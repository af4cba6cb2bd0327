"""Operator 1, personal data: candidates from high-recall generators, scored by boosted trees, selected by a calibrated threshold.

:func:`base_spans` finds what formats and check digits alone decide (email, ip, card, phone). :func:`candidates` proposes more,
overlapping spans: long tokens with letters and digits, runs of digits with separators, and every value of six characters or
more assigned to a name, whatever its characters, its length and the name's. :func:`fit` learns from candidates of a bounded sample of texts (:data:`SAMPLE` texts, those with the smallest hash): a candidate is positive if
it is a base span or the value of a credential name; features describe its format and surroundings, not the rules that label it.
The probability is calibrated on held-out candidates; the threshold is the least that keeps :data:`PRECISION` there. Candidates
above it become ``secret`` or ``number`` spans unless they meet a base span, lie inside another of them or meet a better one.

A quoted value ends at its closing quote on the same line, any other at white space or a quote; a value inside a value (a query
string's, say) is proposed too.

Defined results: null is the empty text, without spans; repeated rows get equal spans; where the sample has no positive or no
negative candidate only the base spans are found; very long texts are searched whole, in linear time; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import boosting
from tableferry.llm.textkit import read_table

SAMPLE = 4000
PRECISION = 0.98
KINDS = ("email", "ip", "card", "phone", "secret", "number")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_SOME = re.compile(r"[0-9=:]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{8,}+=*+")
_DIGITS = re.compile(r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){5,}+")
_SET = r"(?<=[A-Za-z0-9_-])[\x20]?[=:][\x20]?"
_VALUE = re.compile(_SET + r"(?:\"((?:[^\"\\\n]|\\.){6,}+)\"|'((?:[^'\\\n]|\\.){6,}+)'|[\"']?([^\s\"']{6,}+))")
_INNER = re.compile(_SET + r"[\"']?([^\s\"'&;,?#]{6,}+)")
_ASSIGNED = re.compile(r"[=:][\x20]?[\"']?$")
_NAME = re.compile(r"[A-Za-z0-9_-]")
_CREDENTIAL = re.compile(r"passw|passwd|pwd|secret|token|api|key|auth|credential", re.I)
_CONTACT = re.compile(r"tel|phone|mobil|call|fax|mail|contact", re.I)
_PAYMENT = re.compile(r"card|visa|iban|account|konto|cuenta|compte|bank", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, in linear time: each @ with the run of local characters before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # The last label may be shorter than the run of domain characters, never longer: the match ends where the run of labels does.
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind as listed, then start; code points."""
    if not _ANY.search(text):
        return []
    out: list[Span] = [("email", *x) for x in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def _name(text: str, start: int) -> str:
    """The whole name that the value at ``start`` is assigned to, or an empty string."""
    sign = _ASSIGNED.search(text[max(0, start - 3) : start])
    if not sign:
        return ""
    end = start - len(sign[0])
    end -= text[end - 1 : end] == " "
    at = end
    while at and _NAME.match(text, at - 1):
        at -= 1
    return text[at:end].lstrip("0123456789_-")


def candidates(text: str) -> list[Span]:
    """(kind, start, end), overlapping: tokens with digits and letters, values assigned to a name, runs of six digits or more."""
    if not _SOME.search(text):
        return []
    out = {("secret", *m.span()) for m in _TOKEN.finditer(text)}
    out = {x for x in out if re.search("[0-9]", text[x[1] : x[2]]) and re.search("[A-Za-z]", text[x[1] : x[2]])}
    values = {m.span(m.lastindex) for pattern in (_VALUE, _INNER) for m in pattern.finditer(text)}
    out |= {("secret", *x) for x in values if _name(text, x[0])}
    return sorted(out | {("number", *m.span()) for m in _DIGITS.finditer(text)}, key=lambda x: (x[1], x[2], x[0]))


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    value, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 2]
    n, digits = len(value), sum("0" <= c <= "9" for c in value)
    letters, hexes = sum(c.isalpha() for c in value), sum(c in "0123456789abcdef" for c in value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    changes = sum(value[i].isdigit() != value[i - 1].isdigit() for i in range(1, n))
    name = f"{before.rstrip(' \"\'=:')[-16:]} {_name(text, start)}"
    return [
        float(kind == "number"), float(_luhn(re.sub("[^0-9]", "", value))), n, digits, digits / n, letters / n, hexes / n, sum(c.isupper() for c in value) / n, entropy, len(counts) / n, changes / n,
        value.count("."), value.count("-"), value.count(" "), value.count("("), float(value[0] == "+" or before[-1:] == "+"), float(value[0] == "0"),
        max((len(x) for x in re.findall("[0-9]+", value)), default=0), float(before[-1:] in "\"'"), float(bool(re.search(r"[=:]\s?[\"']?$", before))),
        float(bool(_CREDENTIAL.search(name))), float(bool(_CONTACT.search(name))), float(bool(_PAYMENT.search(name))),
        float(after[:1].isalnum()), float("@" in before[-2:] + after), float(bool(re.search(r"https?://\S*$", before))),
    ]


def _label(text: str, span: Span, base: list[Span]) -> bool:
    if any(min(e, span[2]) - max(s, span[1]) >= 0.8 * (max(e, span[2]) - min(s, span[1])) for _, s, e in base):
        return True
    return bool(span[0] == "secret" and _CREDENTIAL.search(_name(text, span[1])))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> tuple[boosting.Trees, float] | None:
    """(trees, threshold) from the candidates of at most ``sample`` texts with a digit, an @ or a sign of assignment."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, fold = [], [], []
            for value in batch.column(0).to_pylist():
                base = base_spans(value)
                for span in candidates(value):
                    x.append(features(value, span))
                    y.append(_label(value, span, base))
                    fold.append(int.from_bytes(hashlib.blake2b(value[span[1] : span[2]].encode("utf-8", "replace"), digest_size=2).digest()) % 5)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.bool_()), pa.array(fold, pa.int32())], ["x", "y", "fold"])

    named = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@=:]"))
    # The texts with the smallest hashes; a bound on the hash keeps about twice as many as wanted, so that neither the
    # shuffle of distinct texts nor the task that merges the smallest grows with the corpus.
    share = 2 * sample / max(1, named.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0])
    if share < 1:
        named = named.where(F.xxhash64("text") < F.lit(int(share * 2**64) - 2**63))
    some = named.distinct().orderBy(F.xxhash64("text"), "text").limit(sample)
    learned = some.mapInArrow(rows, "x array<double>, y boolean, fold int").toPandas()
    y = learned["y"].to_numpy(bool)
    if not len(y) or y.all() or not y.any():
        return None
    x, held = np.array(learned["x"].tolist()), learned["fold"].to_numpy() == 0
    if y[~held].all() or not y[~held].any():
        held = np.zeros(len(y), bool)
    trees = boosting.fit(x, y, held)
    chance, truth = (trees.probability(x[held]), y[held]) if held.any() else (trees.probability(x), y)
    order = np.argsort(-chance, kind="stable")
    right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= precision)
    return trees, max(0.5, float(chance[order[good[-1]]])) if len(good) else 1.0


def _meets(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether the span overlaps one of ``taken``, which are sorted and disjoint."""
    i = bisect_left(taken, (end, 0))
    return i > 0 and taken[i - 1][1] > start


def all_spans(text: str, model: tuple[boosting.Trees, float] | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by kind as listed, then start."""
    base = base_spans(text)
    taken: list[tuple[int, int]] = []
    for start, end in sorted(x[1:] for x in base):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    proposed = [x for x in candidates(text) if not _meets(taken, *x[1:])] if model else []
    chosen = list(base)
    if proposed:
        chance = model[0].probability(np.array([features(text, x) for x in proposed]))
        good, outer = [], (-1, -1)
        for i in sorted((i for i in range(len(proposed)) if chance[i] >= model[1]), key=lambda i: (proposed[i][1], -proposed[i][2])):
            if proposed[i][2] > outer[1] or proposed[i][1:] == outer:  # a part of another would leave the rest of it in the text
                good.append(i)
                outer = proposed[i][1:]
        for i in sorted(good, key=lambda i: (-chance[i], proposed[i][1], -proposed[i][2], proposed[i][0])):
            if not _meets(taken, *proposed[i][1:]):
                chosen.append(proposed[i])
                insort(taken, proposed[i][1:])
    return base, sorted(chosen, key=lambda x: (KINDS.index(x[0]), x[1]))


def find(docs: DataFrame, model: tuple[boosting.Trees, float] | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, base and spans (arrays of kind, start, stop) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1])
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(x or "", shared.value) for x in batch.column(batch.num_columns - 1).to_pylist()]
            lists = [pa.array([[dict(zip(("kind", "start", "stop"), x, strict=True)) for x in row[i]] for row in found], pa.list_(span)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*batch.schema.names[:-1], "base", "spans"])

    entry = "array<struct<kind: string, start: int, stop: int>>"
    return named.mapInArrow(run, f"{schema}{', ' if schema else ''}base {entry}, spans {entry}")


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    return found.select("doc_id", *map(count, KINDS[:4]), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
