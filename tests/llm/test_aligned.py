"""Operator 11 against whole texts encoded at once and all pairs of tokens compared."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest

from claimloom.llm import aligned, catalog
from tests.llm.conftest import invented, table

public_tokenizers = pytest.importorskip("public_tokenizers")
FILES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(catalog.vocabulary())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=FILES[2])


def letters():
    """The byte of each letter that a byte-level vocabulary writes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def plain_row(text, libraries):
    """Tokens of A and B, links as index pairs and groups; None without tokens."""
    if not text:
        return None
    a, b = libraries
    table = letters()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_bytes = [bytes(table[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return None

    def spans(tokens):
        out, at = [], 0
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    of_a, of_b = spans(a_bytes), spans(b_bytes)
    links = [(i, j) for i, (p, q) in enumerate(of_a) for j, (r, s) in enumerate(of_b) if p < s and r < q]
    cuts = sorted({e for _, e in of_a} & {e for _, e in of_b})
    groups, at = [], 0
    for cut in cuts:
        inside = [",".join(str(i) for i, (p, q) in zip(ids, where) if at <= p and q <= cut) for ids, where in ((a_ids, of_a), (b_ids, of_b))]
        groups.append("|".join(inside))
        at = cut
    return a_ids, b_ids, [(a_ids[i], b_ids[j]) for i, j in links], ";".join(groups), len(cuts)


def plain_result(docs, libraries):
    rows = [(i, plain_row(t, libraries)) for i, t in docs]
    count = Counter(p for _, r in rows if r for p in set(r[2]))
    top = Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for i, r in rows:
        if r is None:
            out.append((i, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        a, b, links, groups, n = r
        best = sum(count[p] == top[p[0]] for p in links)
        out.append((i, len(a), len(b), n, len(links), best, sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest(), groups))
    return Counter(out)


def strange(rng, n):
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "\r", ";\r", "'s", "\x1c", "\x85", "\xa0", "é", "ß", "日本", "\U0001f642", "́", "²", "====", "<s>", "<|endoftext|>", "<0x0A>", "12", "\x00", "x" * 60, "　", "﻿"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_rows_equal_plain_alignment(spark, libraries):
    rng = random.Random(1)
    texts = [strange(rng, rng.randint(0, 25)) for _ in range(250)] + [invented(rng, rng.randint(1, 60)) for _ in range(60)]
    texts += [None, "", " ", "\n", " \t ", "a▁b", "▁", "a ", " a", "a\n", "word", "word", "word", "x" * 700, "= " * 200]
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, "null id")]
    df = table(spark, [(i, t, "en") for i, t in docs]).repartition(3)
    want = plain_result(docs, libraries)
    for head in (aligned.HEAD, 200, 0):
        assert Counter(tuple(r) for r in aligned.aligned(df, *FILES, head=head).collect()) == want
    assert [c for c in aligned.aligned(df, *FILES, groups=False).columns] == ["doc_id", *aligned.COUNTED, "groups_sha256"]


def test_small_bounds_change_nothing(spark, libraries, monkeypatch):
    """The memo, the blocks and the sums are compacted and emptied all the time."""
    rng = random.Random(2)
    texts = [strange(rng, 30) for _ in range(40)] + [invented(rng, 300)]
    pair = aligned.Pair(*FILES)
    plain = aligned.Memo(pair)
    want = [sum((plain.counts[n].sum(0) for _, n, _ in plain.texts([t])), np.zeros(4, int)).tolist() for t in texts]
    monkeypatch.setattr(aligned, "MEMO", 5)
    monkeypatch.setattr(aligned, "BLOCK", 40)
    small = aligned.Memo(pair)
    assert [sum((small.counts[n].sum(0) for _, n, _ in small.texts([t])), np.zeros(4, int)).tolist() for t in texts] == want
    sums, all_keys = aligned.Sums(7), rng.choices(range(20), k=200)
    for k in range(0, 200, 9):
        sums.add(np.array(all_keys[k : k + 9], np.uint64))
    keys, counts = sums.compact()
    assert dict(zip(keys.tolist(), counts.tolist())) == Counter(all_keys)


def test_galloping():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 200)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n - 1)), n})) for _ in range(2))
        i, j, i_ends, j_ends = aligned.align(a, b, np.array([0, n]))
        begin_a, begin_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        assert sorted(zip(i.tolist(), j.tolist())) == [(x, y) for x in range(len(a)) for y in range(len(b)) if begin_a[x] < b[y] and begin_b[y] < a[x]]
        assert a[i_ends - 1].tolist() == b[j_ends - 1].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_odd_tables_and_long_texts(odd, nothing, libraries):
    got = aligned.aligned(odd, *FILES, groups=False).collect()
    assert len(got) == odd.count() and aligned.aligned(nothing, *FILES).count() == 0
    rows = {r.doc_id: r for r in got}
    assert rows[1][1:] == rows[2][1:] == (0, 0, 0, 0, 0, 0, "") and rows[7].n_links == rows[7].n_a + rows[7].n_b - rows[7].n_groups
    start = time.time()
    memo = aligned.Memo(aligned.Pair(*FILES))
    for text in ("x" * 300_000, "ab" * 100_000, "日" * 100_000, "word\n" * 100_000, "\n" * 300_000, " " * 300_000, "a\t" * 100_000):
        total = sum(n.sum() for _, k, _ in memo.texts([text]) for n in [memo.counts[k]])
        assert total > 0
    assert time.time() - start < 60
