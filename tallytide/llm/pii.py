"""Personal data by weak supervision.

Candidates come from patterns: the base kinds, which are always reported, and looser ones
(numbers without a plus sign, spelled-out addresses, identity numbers, longer addresses). Labelers
vote on every candidate: a strict pattern, a check of its digits or domain, gazetteer and
context words, its form and its neighbours. The votes are counted over the whole corpus, and
expectation-maximisation estimates how far each labeler can be trusted. With the labels that
come out of it a logistic span classifier is trained on the same counts; it decides on the
looser candidates.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready

KINDS = ("email", "ip", "card", "phone", "id")  # base kinds first
ACCEPT = 0.9
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match of these starts at the head of a run of digits, so a long run is read once
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_LOOSE = (
    ("card", re.compile(r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])")),
    ("id", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("phone", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])[0-9]{7,15}(?![0-9A-Za-z-])")),
)
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}"
                      r"(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,8}", re.IGNORECASE)
_LONG_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

# words near a candidate that speak for its kind, and words that speak against any
_CUES = {
    "email": {"email", "mail", "contact", "correo", "courriel", "kontakt"},
    "ip": {"ip", "host", "server", "address", "login"},
    "card": {"card", "visa", "credit", "debit", "tarjeta", "carte", "karte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"},
    "id": {"ssn", "social", "security", "passport", "id"},
}
_AGAINST = {"isbn", "version", "page", "issue", "order", "item", "invoice", "total", "eur", "usd", "license", "doi"}
_ENDINGS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu"}
_WORD = re.compile(r"[^\W\d_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from their @ signs; each character is read a few times at most."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            floor = domain.end()
        floor = max(floor, at + 1)
        at = text.find("@", floor)
    return out


def _number(digits: str) -> int:
    """The value of a run of digits, or a large one if it has more than three behind leading zeros."""
    digits = digits.lstrip("0")
    return int(digits or "0") if len(digits) <= 3 else 1000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    first = _DIGIT.search(text)
    if first is None:
        return out
    at = max(first.start() - 1, 0)  # no number starts before, but a plus sign may
    for m in _IP.finditer(text, first.start()):
        if all(_number(part) <= 255 for part in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text, first.start()):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if text.find("+", at) >= 0:
        for m in _PHONE.finditer(text, at):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates beyond the base patterns."""
    out = []
    lowered_at = "at)" in text or "at]" in text or "AT)" in text or "AT]" in text or "at )" in text or "at ]" in text
    if lowered_at:
        out += [(0, *m.span()) for m in _SPELLED.finditer(text)]
    first = _DIGIT.search(text)
    if first is None:
        return out
    begin = max(first.start() - 1, 0)
    if text.count(":") >= 7:
        out += [(1, *m.span()) for m in _LONG_IP.finditer(text)]
    for kind, pattern in _LOOSE:
        out += [(KINDS.index(kind), *m.span()) for m in pattern.finditer(text, begin)]
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> str:
    """One sign per labeler (+ for, - against, 0 abstains), then the bucket of the length."""
    span, name = text[start:end], KINDS[kind]
    digits = [c for c in span if c.isdigit()]
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])[-4:]]
    if name == "email":
        ending = re.split(r"[^A-Za-z0-9]+", span.rstrip(")] "))[-1].lower()
        valid = "+" if ending in _ENDINGS else "0"
    elif name == "card":
        valid = "+" if 16 <= len(digits) <= 19 and _luhn("".join(digits)) else "-"
    elif name == "ip":
        valid = "+" if len(span) >= 7 else "-"
    elif name == "id":
        valid = "-" if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" else "+"
    else:
        valid = "+" if 10 <= len(digits) <= 13 and not base and span[0] == "(" else "+" if base else "0"
    cue = "+" if _CUES[name] & set(before) else "-" if _AGAINST & set(before) else "0"
    marks = sum(not c.isalnum() for c in span)
    form = "+" if marks >= (1 if name == "email" else 2) or (name == "card" and len(digits) == 16) else "-" if not marks else "0"
    beside = text[start - 1 : start] + text[end : end + 1]
    near = "-" if any(c.isalnum() or c in "#$%_/=" for c in beside) else "0"
    tell = "-" if digits and len(set(digits)) <= 2 and name != "ip" else "0"
    return ("+" if base else "0") + valid + cue + form + near + tell + str(min(len(span) // 4, 9))


LABELERS = 6


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and those looser ones that overlap none of them nor an earlier looser one."""
    base = base_spans(text)
    rest: list[tuple[int, int, int]] = []
    taken = sorted(base, key=lambda s: s[1])
    starts = np.array([s[1] for s in taken])
    ends = np.maximum.accumulate([s[2] for s in taken]) if taken else np.empty(0, int)
    last = -1
    for span in sorted(loose_spans(text), key=lambda s: (s[1], -s[2], s[0])):
        k = int(np.searchsorted(starts, span[2]))  # base spans that start before this one ends
        if span[1] >= last and not (k and ends[k - 1] > span[1]):
            rest.append(span)
            last = span[2]
    return base, rest


def vote_counts(docs: DataFrame, text: str) -> dict[tuple[int, str], int]:
    """(kind, votes) -> candidates in the whole corpus: at most kinds x 3^labelers x 10 entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    base, rest = candidates(value)
                    seen.update((k, votes(value, k, a, b, True)) for k, a, b in base)
                    seen.update((k, votes(value, k, a, b, False)) for k, a, b in rest)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.int64()), pa.array([v for _, v in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], names=["kind", "votes", "n"])

    counted = docs.select(text).mapInArrow(count, "kind long, votes string, n long")
    rows = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    return {(r["kind"], r["votes"]): r["n"] for r in rows}


def estimate(counts: dict[tuple[int, str], int], rounds: int = 50) -> dict[tuple[int, str], float]:
    """Chance that a candidate with these votes is personal data, by expectation-maximisation.

    A labeler that votes is right with some chance, one for votes for and one for votes against,
    never taken below a half, so that the two classes cannot change places.
    """
    keys = list(counts)
    n = np.array([counts[k] for k in keys], float)
    kind = np.array([k for k, _ in keys])
    plus = np.array([[c == "+" for c in v[:LABELERS]] for _, v in keys])
    minus = np.array([[c == "-" for c in v[:LABELERS]] for _, v in keys])
    p = 1 / (1 + np.exp(-(1.5 * (plus.sum(1) - minus.sum(1)) - 1.0)))
    for _ in range(rounds):
        share = np.array([(2 + (n * p)[kind == k].sum()) / (4 + n[kind == k].sum()) for k in range(len(KINDS))])
        up = np.clip((8 + plus.T @ (n * p)) / (10 + plus.T @ n), 0.55, 0.99)
        down = np.clip((8 + minus.T @ (n * (1 - p))) / (10 + minus.T @ n), 0.55, 0.99)
        z = np.log(share[kind] / (1 - share[kind])) + plus @ np.log(up / (1 - up)) - minus @ np.log(down / (1 - down))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return dict(zip(keys, p))


def _design(keys: list[tuple[int, str]]) -> np.ndarray:
    rows = np.zeros((len(keys), 1 + len(KINDS) + 2 * LABELERS + 10))
    for i, (kind, v) in enumerate(keys):
        rows[i, 0] = rows[i, 1 + kind] = 1
        for j in range(LABELERS):
            rows[i, 1 + len(KINDS) + 2 * j] = v[j] == "+"
            rows[i, 2 + len(KINDS) + 2 * j] = v[j] == "-"
        rows[i, 1 + len(KINDS) + 2 * LABELERS + int(v[LABELERS])] = 1
    return rows


def span_classifier(counts: dict[tuple[int, str], int], steps: int = 40) -> dict[tuple[int, str], float]:
    """Logistic regression on the estimated labels, weighted by counts; its score for each key seen."""
    if not counts:
        return {}
    soft = estimate(counts)
    keys = list(counts)
    x, y, n = _design(keys), np.array([soft[k] for k in keys]), np.sqrt(np.array([counts[k] for k in keys], float))
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(hess, x.T @ (n * (y - p)) - 0.1 * w)
    return dict(zip(keys, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))


def find_pii(docs: DataFrame, text: str = "text", name: str = "pii", redact: bool = False) -> DataFrame:
    """Add ``name``: spans (kind, start, end, base) in code points, by kind as in KINDS, then start.

    Base spans are all matches of the base patterns; the rest are those the classifier takes.
    NULL and empty texts have no spans. With ``redact`` the text is returned with every span
    replaced by its kind in brackets (overlapping spans become one, named after the first). A
    column ``name`` of ``docs`` is replaced, the other columns are returned as they are.
    """
    ready(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(span_classifier(vote_counts(docs, text)))
    kept = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in kept]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
    schema = T.StructType([*kept, T.StructField(name, T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            texts, found = columns[names.index(text)].to_pylist(), []
            for i, value in enumerate(texts):
                base, rest = candidates(value) if value else ([], [])
                more = [s for s in rest if model.value.get((s[0], votes(value, *s, False)), 0.0) >= ACCEPT]
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in more], key=lambda s: (s[0], s[1], s[2]))
                found.append([{"kind": KINDS[k], "start": a, "end": b, "base": is_base} for k, a, b, is_base in spans])
                if redact and spans:
                    texts[i] = redacted(value, spans)
            if redact:
                columns[names.index(text)] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow)], names=[*names, name])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple]) -> str:
    out, at, last = [], 0, 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = last = max(last, end)
    return "".join(out) + text[at:]


def report(found: DataFrame, doc_id: str = "doc_id", name: str = "pii") -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(name, lambda s: s["base"])
    counts = [of_kind(k) for k in KINDS[:4]]
    return found.select(doc_id, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(name)).alias("spans"))
