"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from patterns with checks (octet range, Luhn, digit counts). The field then labels
tokens of the same document: a linear chain over the candidate tokens (those with a digit or an @),
with unary potentials from a token's shape, and skip edges between tokens that are equal or similar
in what identifies them (the same digits, one number ending with the other, the same mailbox).
Loopy sum-product over both kinds of edge carries the label of a token that the patterns found to
its distant repetitions that they cannot see: a number without its plus sign, an address with its
dots or @ spelt out. Documents without any base span are inferred too: there the shapes and the repetitions
decide. Tokens of base spans are clamped; base spans always stay.

Tokens with neither a digit nor an @ have a hard zero for every label but ``other``: they cut the
chain, so a document without candidates needs no inference, and results are the same.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, least_hashed, settled

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails at the start of a run of digits fails at each later digit of it too.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SPELT = re.compile(r"[\[({]at[\])}]")
_CANDIDATE = re.compile(r"[0-9@]")
#: A candidate token: a run of digits with single separators inside, or a word with a digit, an @ or an
#: @ spelt out in brackets. Words are entered at their start only, which keeps long ones linear.
_TOKEN = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])+|(?<![^\s,;<>\"])[^\s,;<>\"]*(?:[0-9@]|[\[({]at[\])}])[^\s,;<>\"]*")
ROWS_OUT = 1024
#: Rows whose base spans fit the field: those of least hash (a bounded sample).
TRAIN_ROWS = 4000
#: Chain neighbours farther apart than this many characters have no edge.
NEAR = 80
SWEEPS, TOLERANCE, ACCEPT = 200, 1e-4, 0.6
#: What the log potential of a label loses where the token fails that label's own check: more than one skip edge gives.
CHECK = 6.0
#: Weight of a skip edge where the sample shows none.
SKIP = 4.0


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ so that long runs of letters cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _CANDIDATE.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def failed_check(token: str) -> int:
    """The label whose form a token has and whose check it fails: 14 to 19 digits against Luhn, four dotted numbers with one over 255; 0 for none."""
    body = token.strip(".:!?#*$%&|)(' ")
    digits = _NOT_DIGIT.sub("", body)
    if _IP.fullmatch(body):
        return 0 if all(int(p) <= 255 for p in body.split(".")) else LABELS.index("ip")
    if _CARD.fullmatch(body) and 14 <= len(digits) <= 19 and not luhn(digits):
        return LABELS.index("card")
    return 0


def shape(token: str) -> tuple[int, int, int, int, int]:
    """What the unary potentials see: digits (bucketed), separators, letters, @ (also spelt out), the check that fails."""
    digits = sum(c.isdigit() and c.isascii() for c in token)
    bucket = 0 if digits == 0 else 1 if digits < 7 else 2 if digits < 10 else 3 if digits < 14 else 4 if digits < 20 else 5
    return bucket, min(3, sum(c in ".-() " for c in token)), int(any(c.isalpha() for c in token)), int("@" in token or _SPELT.search(token) is not None), failed_check(token)


def identity(token: str) -> tuple[str, str]:
    """(digits, mailbox) by which tokens are compared; too short ones are ''."""
    digits = _NOT_DIGIT.sub("", token)
    box = ""
    if any(c.isalpha() for c in token):
        box = re.sub(r"[\[({<]?(?:@|\bat\b)[\])}>]?", "@", token.lower()).strip(".:!?#*$%&|")
        box = box if "@" in box and len(box) >= 6 else ""
    return (digits if len(digits) >= 7 else ""), box


@dataclass
class Field:
    """Log potentials: unary by shape, chain transitions, and the weight of a skip edge."""

    unary: dict[tuple[int, int, int, int, int], np.ndarray]
    unseen: np.ndarray
    chain: np.ndarray
    skip: float = SKIP

    def of(self, token: str) -> np.ndarray:
        seen = shape(token)
        potential = self.unary.get(seen, self.unseen)
        if not seen[-1]:
            return potential
        less = potential.copy()
        less[seen[-1]] -= CHECK
        return less


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def labelled_tokens(text: str, base: list[tuple[str, int, int]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Candidate tokens and their labels by the base spans that overlap them (0: none)."""
    spans = sorted({(a, b) for a, b in tokens_of(text)} | {(a, b) for _, a, b in base})
    labels, out, k = [], [], 0
    ordered = sorted(base, key=lambda s: s[1])
    for a, b in spans:
        while k < len(ordered) and ordered[k][2] <= a:
            k += 1
        over, at = [], k
        while at < len(ordered) and ordered[at][1] < b:
            if a < ordered[at][2]:
                over.append(ordered[at])
            at += 1
        exact = next((s for s in over if (s[1], s[2]) == (a, b)), None)
        if over and exact is None:
            continue  # the span itself stands for what it overlaps
        out.append((a, b))
        labels.append(LABELS.index(exact[0]) if exact else 0)
    return out, labels


def skip_edges(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges between equal or similar tokens: each token to the last earlier one of the same identity
    (a path connects all of a group without pairing it), and to the longer number that it ends."""
    last: dict[object, int] = {}
    edges, numbers = set(), {}
    for i, (a, b) in enumerate(spans):
        digits, box = identity(text[a:b])
        for key in (("d", digits), ("b", box)):
            if key[1]:
                if key in last:
                    edges.add((last[key], i))
                last[key] = i
        if digits:
            numbers.setdefault(digits, i)
    ends: dict[str, int] = {}
    for digits, i in numbers.items():
        for n in range(7, len(digits)):
            if len(digits) - n <= 3:
                ends.setdefault(digits[-n:], i)
    for digits, i in numbers.items():
        if digits in ends and ends[digits] != i:
            edges.add((min(i, ends[digits]), max(i, ends[digits])))
    return sorted(edges)


def marginals(unary: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray, pots: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loopy sum-product with damping over many documents at once; unary potentials and ``pots`` are logarithms.

    Edge e joins tokens left[e] and right[e] by the table pots[kind[e]], and belongs to document part[e] (sorted).
    Each document stops when its own messages rest, so results do not depend on what else is in the batch. Also given are the
    documents whose messages have not come to rest in ``SWEEPS`` sweeps.
    """
    k = unary.shape[1]
    tables = np.exp(pots)
    forth, back = np.full((len(left), k), -np.log(k)), np.full((len(left), k), -np.log(k))
    open_ = np.arange(len(left))
    for _ in range(SWEEPS):
        if not len(open_):
            break
        i, j, t = left[open_], right[open_], tables[kind[open_]]
        was_f, was_g = forth[open_], back[open_]
        belief = unary.copy()
        np.add.at(belief, j, was_f)
        np.add.at(belief, i, was_g)
        a, b = belief[i] - was_g, belief[j] - was_f
        f = np.log(np.einsum("ei,eij->ej", np.exp(a - a.max(axis=1, keepdims=True)), t) + 1e-300)
        g = np.log(np.einsum("ej,eij->ei", np.exp(b - b.max(axis=1, keepdims=True)), t) + 1e-300)
        f -= np.logaddexp.reduce(f, axis=1, keepdims=True)
        g -= np.logaddexp.reduce(g, axis=1, keepdims=True)
        moved = np.maximum(np.abs(f - was_f).max(axis=1), np.abs(g - was_g).max(axis=1))
        forth[open_], back[open_] = 0.5 * was_f + 0.5 * f, 0.5 * was_g + 0.5 * g
        firsts = np.flatnonzero(np.r_[True, part[open_][1:] != part[open_][:-1]])
        sizes = np.diff(np.r_[firsts, len(open_)])
        open_ = open_[np.repeat(np.maximum.reduceat(moved, firsts) >= TOLERANCE, sizes)]
    belief = unary.copy()
    np.add.at(belief, right, forth)
    np.add.at(belief, left, back)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), np.unique(part[open_])


def consistent_spans(texts: list[str | None], bases: list[list[tuple[str, int, int]]], model: Field) -> tuple[list[list[tuple[str, int, int]]], list[bool]]:
    """Of each text its base spans and the spans that the field adds, by start, then kind; and whether its messages came to rest.

    Every text with an unlabelled candidate token is inferred, with or without base spans or skip edges;
    any unlabelled token may be accepted by its marginal.
    """
    out, found, unary, edges = [list(b) for b in bases], [], [], []
    clamped = np.where(np.eye(len(LABELS), dtype=bool), 0.0, -50.0)
    for d, (text, base) in enumerate(zip(texts, bases)):
        if not text:
            continue
        spans, labels = labelled_tokens(text, base)
        if all(labels):
            continue
        at = len(unary)
        unary += [clamped[y] if y else model.of(text[a:b]) for (a, b), y in zip(spans, labels)]
        edges += [(at + i, at + i + 1, 0, d) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= NEAR]
        edges += [(at + i, at + j, 1, d) for i, j in skip_edges(text, spans)]
        found += [(d, a, b, y) for (a, b), y in zip(spans, labels)]
    rested = [True] * len(texts)
    if not found:
        return out, rested
    agree = np.where(np.eye(len(LABELS), dtype=bool), model.skip, 0.0)
    e = np.array(edges, np.int64).reshape(-1, 4)
    p, restless = marginals(np.stack(unary), e[:, 0], e[:, 1], e[:, 2], np.stack([model.chain, agree]), e[:, 3])
    for d in restless.tolist():
        rested[d] = False
    best = p.argmax(axis=1)
    for i in np.flatnonzero((best > 0) & (p[np.arange(len(p)), best] >= ACCEPT)):
        d, a, b, label = found[i]
        if not label:
            body = texts[d][a:b].rstrip(".:!?#*$%&|)'")
            out[d].append((LABELS[best[i]], a, a + len(body)))
    return [sorted(set(x), key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if len(x) > len(b) else list(b) for x, b in zip(out, bases)], rested


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Field:
    """Potentials from the base spans of a bounded sample (rows of least hash), counted on executors.

    Unary ones are smoothed log frequencies of labels given the shape, chain ones those of label pairs
    of neighbours, and a skip edge's weight is the log odds that two labelled tokens on one agree
    (``SKIP`` where the sample has no such pair). A token without a label that has a skip edge to a
    labelled one is taken as unobserved, not as ``other``: it is what the field is there to find.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], int] = defaultdict(int)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans, labels = labelled_tokens(text, base_spans(text))
                unseen = set()
                for i, j in skip_edges(text, spans):
                    if labels[i] and labels[j]:
                        counts["s:", str(int(labels[i] == labels[j]))] += 1
                    elif labels[i] or labels[j]:
                        unseen.add(j if labels[i] else i)
                for k, (a, b) in enumerate(spans):
                    if k in unseen or k - 1 in unseen:
                        continue
                    counts["u:" + ",".join(map(str, shape(text[a:b]))), str(labels[k])] += 1
                    if k and a - spans[k - 1][1] <= NEAR:
                        counts["c:" + str(labels[k - 1]), str(labels[k])] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["what", "label", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("t"), F.xxhash64(F.col(id_col).cast("string")).alias("__h"), F.lit("").alias("__all")).filter("t is not null and t rlike '[0-9@]'")
    sample = settled(least_hashed(texts, "__all", ["t"], rows).select("t"), "pii-sample")
    found = in_arrow(sample, run, "what string, label string, n bigint").groupBy("what", "label").agg(F.sum("n").alias("n")).collect()
    unary: dict[str, np.ndarray] = {}
    agree = [0.5, 0.5]
    chain, overall = np.ones((len(LABELS), len(LABELS))), np.ones(len(LABELS))
    for r in found:
        if r["what"] == "s:":
            agree[int(r["label"])] += r["n"]
        elif r["what"].startswith("c:"):
            chain[int(r["what"][2:]), int(r["label"])] += r["n"]
        else:
            unary.setdefault(r["what"][2:], np.ones(len(LABELS)))[int(r["label"])] += r["n"]
            overall[int(r["label"])] += r["n"]
    # Damped, as base labels of a shape say little about what the patterns miss.
    soft = 0.5
    pairs = np.log(chain / chain.sum(axis=1, keepdims=True)) - np.log(overall / overall.sum())
    return Field({tuple(map(int, k.split(","))): soft * np.log(v / v.sum()) for k, v in unary.items()}, soft * np.log(overall / overall.sum()), 0.25 * pairs, SKIP if sum(agree) == 1 else float(np.log(agree[1] / agree[0])))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans), base, spans, rested (false where messages did not come to rest).

    base and spans are ``kind:start:end`` in code points, end exclusive, comma-joined by start, then
    kind. Null and empty texts have none. Equal spans of two kinds are listed as both. Texts are read whole,
    whatever their length; repeated rows and ids are judged each; other columns, whatever their names, are not
    read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) if t else [] for t in texts]
                every, rested = consistent_spans(texts, base, shared.value)
                counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, pa.array(map(written, base), pa.string()), pa.array(map(written, every), pa.string()), pa.array(rested)], ["__id", *(f"n_{k}" for k in KINDS), "base", "spans", "rested"])

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(rows, run, f"__id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string, rested boolean").withColumnRenamed("__id", id_col)
