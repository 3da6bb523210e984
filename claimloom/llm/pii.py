"""Operator 6: personal data by fixed patterns and a skip-chain conditional random field.

Base spans are what four fixed patterns match (see ``base_spans``); they always stay. The field adds spans that the patterns
miss but that the rest of the document gives away: a telephone number written a second time without its plus, a card number
with other separators, an e-mail address with "(at)".

Nodes are the candidates of a text in order: runs of digits and separators with seven digits or more, and addresses.
Labels are ``none`` and the four kinds. Potentials: of a node, from counts of its features (how many digits, which
separators, what word stands before) by label; of neighbours in order, from counts of label pairs; of distant candidates
that repeat each other or end in the same nine digits (skip edges, each to the occurrence before it), from how often such
pairs agree. Counts come from a bounded sample, in which base spans are the labels. A base span fixes its node's label; for
other nodes ``none`` leads by MARGIN at least, so only what other places of the same document say can add a span.
Sum-product messages are passed along all edges, with damping, until they settle (ROUNDS rounds at most, or one per node up
to a thousand: a chain's ends hardly reach each other beyond that); a node whose most likely label is not
``none`` with MARGINAL or more becomes a span. Edges grow with the number of candidates, not with its square.

Defined cases: null text counts as empty and has no spans; positions are code points, ends are exclusive; a text's result
depends on the text and the fitted counts alone; an empty sample gives flat potentials. Repeated rows give repeated rows.
Only the named columns are read; others pass through ``redacted`` unchanged.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import bounded, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
FIT_ROWS, MARGIN, MARGINAL, ROUNDS, DAMPING, AGREE = 20_000, 1.0, 0.5, 60, 0.3, 50
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().0-9/-]*[0-9])?")
AT = re.compile(r"(?:@|\(at\)|\[at\])")
WRITTEN_DOMAIN = re.compile(r"\x20?([A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*+)")
WORD_BEFORE = re.compile(r"(\w+)\W*$")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Local part, ``@``, and a domain with a dot. The local part reaches back as far as its characters go, but not into the match before."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at) if begin < at else None
        if found:
            end = found.end()
            out.append((begin, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, from the left and without overlap within a kind; matches that fail their kind's check are dropped."""
    out = [("email", *x) for x in _emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def _addresses(text: str) -> list[tuple[int, int, int, int]]:
    """Written addresses: where the local part begins and ends, where the sign ends, and where the domain ends.

    Every sign is looked at once, with the local part straight in front of it and the domain straight behind it, so the time grows
    with the length of the text, whatever it holds."""
    out, end = [], 0
    for sign in AT.finditer(text):
        if sign.start() < end:
            continue
        local_end = begin = sign.start() - (sign.start() > end and text[sign.start() - 1] == " ")
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        domain = WRITTEN_DOMAIN.match(text, sign.end()) if begin < local_end else None
        if domain:
            end = domain.end()
            out.append((begin, local_end, sign.end(), end))
    return out


class Node:
    """A candidate: where it is, what it is compared by, its features, and its base label if it has one."""

    def __init__(self, text: str, begin: int, end: int, key: str, kind: str):
        self.begin, self.end, self.key = begin, end, key
        word = WORD_BEFORE.search(text, max(0, begin - 40), begin)
        digits = sum(c.isdigit() for c in text[begin:end]) if kind == "number" else 0
        marks = "".join(sorted(set(text[begin:end]) - set("0123456789"))) if kind == "number" else "@" * ("@" in text[begin:end])
        size = "none" if not digits else "few" if digits < 9 else "some" if digits < 13 else "many" if digits < 20 else "most"
        hashed = int.from_bytes(hashlib.blake2b((word.group(1).lower() if word else "").encode(), digest_size=2).digest(), "little") % 4096
        self.features = (f"size {size}", f"marks {marks[:8]}", f"before {hashed}")
        self.label = 0


def nodes(text: str, base: list[tuple[str, int, int]]) -> list[Node]:
    """All candidates in order, without overlap; those that a base span touches carry its label."""
    found = []
    if "@" in text or "(at)" in text or "[at]" in text:
        for begin, local_end, at_end, end in _addresses(text):
            domain = re.sub(r"\x20?(?:\(dot\)|\[dot\])\x20?", ".", text[at_end:end].lstrip(" "))
            found.append(Node(text, begin, end, f"{text[begin:local_end]}@{domain}".lower(), "address"))
    taken = [(n.begin, n.end) for n in found]
    k = 0
    for m in NUMBER.finditer(text):
        if m.end() - m.start() < 4 or sum(c.isdigit() for c in m.group()) < 4:
            continue
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        digits = "".join(DIGIT.findall(m.group()))
        if len(digits) >= 7 or m.group().count(".") == 3:
            found.append(Node(text, m.start(), m.end(), digits[-9:] if len(digits) >= 9 else digits, "number"))
    found.sort(key=lambda n: n.begin)
    spans, k = sorted((b, e, LABELS.index(kind)) for kind, b, e in base), 0
    for node in found:
        while k < len(spans) and spans[k][1] <= node.begin:
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < node.end and spans[j][1] <= node.begin:
            j += 1
        if j < len(spans) and spans[j][0] < node.end:
            node.label = spans[j][2]
    return found


def edges(found: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Neighbours in order; and each candidate with the last one before it that has the same key."""
    chain = [(k, k + 1) for k in range(len(found) - 1)]
    last: dict[str, int] = {}
    skip = []
    for k, node in enumerate(found):
        if node.key in last:
            skip.append((last[node.key], k))
        last[node.key] = k
    return chain, skip


class Field:
    """Log potentials from counts."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        n = len(LABELS)
        feature: dict[str, np.ndarray] = {}
        self.prior, pairs, agree = np.ones(n), np.ones((n, n)), np.array([1.0, float(AGREE)])
        for (name, label), count in counts.items():
            if name == "label":
                self.prior[int(label)] += count
            elif name == "pair":
                a, b = map(int, label.split())
                pairs[a, b] += count
            elif name == "same":
                agree[int(label)] += count
            else:
                feature.setdefault(name, np.zeros(n))[int(label)] += count
        total = self.prior.copy()
        self.prior = np.log(self.prior / self.prior.sum())
        self.features = {name: np.log((c + 1) / (total + 100)) for name, c in feature.items()}
        self.unseen = np.log(1 / (total + 100))
        p = pairs / pairs.sum()
        self.chain = np.log(p / np.outer(p.sum(1), p.sum(0)))
        self.skip = np.full((n, n), 0.0)
        np.fill_diagonal(self.skip, np.log(agree[1] / agree[0]))

    def unary(self, node: Node) -> np.ndarray:
        if node.label:
            return np.where(np.arange(len(LABELS)) == node.label, 0.0, -50.0)
        score = self.prior + sum(self.features.get(f, self.unseen) for f in node.features)
        score[0] = max(score[0], score[1:].max() + MARGIN)
        return score - score.max()

    def marginals(self, found: list[Node]) -> np.ndarray:
        chain, skip = edges(found)
        return propagate(np.array([self.unary(n) for n in found]), [(*e, self.chain) for e in chain] + [(*e, self.skip) for e in skip])


def propagate(unary: np.ndarray, links: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Marginals by sum-product message passing over all links at once; exact where they form no cycle."""
    if not links:
        shifted = np.exp(unary - unary.max(1, keepdims=True))
        return shifted / shifted.sum(1, keepdims=True)
    a, b = np.array([x[0] for x in links]), np.array([x[1] for x in links])
    source, target = np.concatenate((a, b)), np.concatenate((b, a))
    table = np.array([x[2] for x in links] + [x[2].T for x in links])
    back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
    message = np.zeros((len(source), unary.shape[1]))
    for _ in range(max(ROUNDS, min(len(unary), 1000))):
        belief = unary.copy()
        np.add.at(belief, target, message)
        inner = belief[source] - message[back]
        new = _log_sum(inner[:, :, None] + table, 1)
        new -= _log_sum(new, 1)[:, None]
        new = DAMPING * message + (1 - DAMPING) * new
        moved = np.abs(new - message).max()
        message = new
        if moved < 1e-9:
            break
    belief = unary.copy()
    np.add.at(belief, target, message)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def drawn(share: float) -> Column:
    """Whether a row belongs to a sample of this share: 63 bits of its hash are compared, so the share may be as small as it likes."""
    if share >= 1:
        return F.lit(True)
    hashed = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.xxhash64("text"))
    return F.shiftrightunsigned(hashed, 1) < int(share * (1 << 63))


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Field:
    """Counts over about ``rows`` rows, chosen by a hash of the id (of the text, for rows without one); the driver gets one sum per feature and label (features are hashed, so they are bounded)."""
    sample = docs.where(drawn(rows / max(1, docs.count()))).select("text").where("text is not null")

    def run(batches):
        counts: dict[tuple[str, str], int] = {}

        def add(name: str, label: str) -> None:
            counts[name, label] = counts.get((name, label), 0) + 1

        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                found = nodes(text, base_spans(text))
                known = {n.key for n in found if n.label}
                sure = [bool(n.label) or n.key not in known for n in found]
                for node in itertools.compress(found, sure):
                    add("label", str(node.label))
                    for f in node.features:
                        add(f, str(node.label))
                chain, skip = edges(found)
                for i, j in chain:
                    if sure[i] and sure[j]:
                        add("pair", f"{found[i].label} {found[j].label}")
                for i, j in skip:
                    if found[i].label and found[j].label:
                        add("same", str(int(found[i].label == found[j].label)))
        names, labels = zip(*counts) if counts else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(labels, pa.string()), pa.array(counts.values(), pa.int64())], ["name", "label", "n"])

    sums = sample.transform(bounded).mapInArrow(run, "name string, label string, n long").groupBy("name", "label").agg(F.sum("n").alias("n")).toArrow()
    return Field({(r["name"], r["label"]): r["n"] for r in sums.to_pylist()})


def added_spans(text: str, base: list[tuple[str, int, int]], field: Field) -> list[tuple[str, int, int]]:
    """What the field finds beside the base spans."""
    found = nodes(text, base)
    if len(found) < 2 or all(n.label for n in found):
        return []
    return [
        (LABELS[k], node.begin, node.end)
        for node, p in zip(found, field.marginals(found))
        if not node.label and (k := int(p.argmax())) and p[k] >= MARGINAL
    ]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def found(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, the digest of the base spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    counted = [f"n_{k}" for k in KINDS]

    def run(batches):
        for batch in slices(batches):
            numbers, digests, spans = [], [], []
            for text in batch["text"].to_pylist():
                base = base_spans(text or "")
                numbers.append([sum(s[0] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + added_spans(text or "", base, shared.value)))
            columns = np.array(numbers, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, columns), pa.array(digests, pa.string()), pa.array(spans, pa.string())], ["doc_id", *counted, "base_sha256", "spans"])

    return docs.select("doc_id", "text").transform(bounded).mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in counted)}, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced together, by the kind that begins first."""
    out, at, ordered = [], 0, sorted(spans, key=lambda s: (s[1], -s[2]))
    k = 0
    while k < len(ordered):
        kind, begin, end = ordered[k]
        while k < len(ordered) and ordered[k][1] < end:
            end = max(end, ordered[k][2])
            k += 1
        out += text[at:begin], f"[{kind.upper()}]"
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with all spans of its texts replaced, and ``n_chars``, where there is one, counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    kinds = docs.schema

    def run(batches):
        for batch in slices(batches):
            columns = list(batch.columns)
            texts = []
            for text in columns[at].to_pylist():
                base = base_spans(text or "")
                spans = base + added_spans(text or "", base, shared.value)
                texts.append(masked(text, spans) if spans else text)
            columns[at] = pa.array(texts, columns[at].type)
            if size is not None:
                columns[size] = pa.array([None if t is None else len(t) for t in texts], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.transform(bounded).mapInArrow(run, kinds)
