"""Operators on single texts: languages, personal data, encoding, packing, licences."""

import hashlib
import itertools
import math
import random
import re
import time
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import bpe, catalog, licenses, lid, packing, pii
from tests.llm.conftest import invented, table

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.vocabulary())


def strange(rng, n):
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "\x1c", "\x85", "\xa0", "​", " ", "é", "ß", "日本", "\U0001f642", "́", "²", "Ⅷ", "====", "aaaa", "<|endoftext|>", "<|", "12", "İ", "\x00", "0"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_transducer_equals_library(library):
    rng, codec = random.Random(3), bpe.Codec(catalog.vocabulary())
    texts = [strange(rng, rng.randint(0, 40)) for _ in range(1500)] + [invented(rng, 200).replace(" ", "") for _ in range(20)]
    texts += ["a" * 4000, "=" * 3000, " " * 2500, "ab" * 1500, "-" * 900 + "=" * 900]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        data = codec.encode(text)
        assert np.frombuffer(data, "<u4").tolist() == want, repr(text)
        assert "".join(codec.decode(data, block=3)) == library.decode(want, skip_special_tokens=False)


def test_transducer_with_few_states(library, monkeypatch):
    for states, passing in ((1, 50), (40, 10**9)):
        monkeypatch.setattr(bpe, "STATES", states)
        monkeypatch.setattr(bpe, "PASSING", passing)
        monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
        codec, text = bpe.Codec(catalog.vocabulary()), invented(random.Random(states), 300)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_pairs_apart_as_merging_says():
    merges, rng = bpe.Merges(catalog.vocabulary()), random.Random(5)
    tokens = rng.sample(sorted(merges.ids.values()), 4000)
    for a, b in zip(tokens, tokens[1:] + tokens[:1]):
        assert merges.apart(a, b) == (merges.merged(merges.bytes[a] + merges.bytes[b]) == [merges.bytes[a], merges.bytes[b]])


def test_decoding_any_ids(library):
    rng, codec = random.Random(6), bpe.Codec(catalog.vocabulary())
    ids = [rng.randrange(50257) for _ in range(3000)]
    for block in (1, 7, 5000):
        assert "".join(codec.decode(np.array(ids, "<u4").tobytes(), block)) == library.decode(ids, skip_special_tokens=False)


def test_encoded_rows(odd, nothing, library):
    got = [r.asDict() for r in bpe.encoded(odd, catalog.vocabulary()).collect()]
    assert len(got) == odd.count() and bpe.encoded(nothing, catalog.vocabulary()).count() == 0
    want = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    for row, (doc, text) in zip(sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"])), sorted(want, key=lambda x: (x[0], len(library.encode(x[1], add_special_tokens=False).ids)))):
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert (str(row["doc_id"]), row["n_tokens"], row["ids"]) == (doc, len(ids) // 4, ids)
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest() and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def plain_grams(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return sum(3 * len(w) for w in words)


def test_languages(spark, odd, nothing):
    rng = random.Random(1)
    kinds = {"aa": "ka lo mi ten", "bb": "sch zu ung ver", "cc": "ção não lh que"}
    docs = table(spark, [(i, invented(rng, rng.randint(8, 60), kinds[g]), g) for i, g in enumerate(itertools.islice(itertools.cycle(kinds), 600))])
    learned = docs.where(~lid.held_out(F.col("doc_id")))
    got = lid.predict(docs, lid.fit(learned)).join(docs.select("doc_id", "lang"), "doc_id").where(lid.held_out(F.col("doc_id"))).collect()
    assert len(got) > 100 and sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.99 and all(0 <= r.score <= 1 for r in got)
    model = lid.fit(docs)
    out = {(r.doc_id, r.lang_pred) for r in lid.predict(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= out and all(p != "und" for i, p in out if i in (4, 7, 8))
    kept = lid.identified(odd, model, 0.5)
    assert kept.columns == odd.columns and {r.lang for r in kept.collect()} <= set(kinds) and not {1, 2, 3} & {r.doc_id for r in kept.collect()}
    assert lid.predict(nothing, model).count() == 0
    none = lid.fit(nothing)
    assert {r.lang_pred for r in lid.predict(odd, none).collect()} == {"und"} and lid.identified(odd, none, 0.5).count() == 0


def plain_bayes(train, texts):
    """Naive Bayes with dictionaries: (label, probability) of each text, learned from (text, label) rows."""

    def grams(text):
        low = [c.lower()[0] if unicodedata.category(c)[0] == "L" else " " for c in text]
        for k, c in enumerate(low):
            if c != " ":
                before, after = low[k - 1] if k else " ", low[k + 1] if k + 1 < len(low) else " "
                yield from ((c,), (c, after), (before, c, after))

    labels = sorted({g for _, g in train})
    counts = {g: Counter(x for t, own in train if own == g for x in grams(t)) for g in labels}
    out = []
    for text in texts:
        logs = {}
        for g in labels:
            total = sum(counts[g].values()) + lid.ALPHA * lid.BUCKETS
            steps = sum(round(math.log((counts[g][x] + lid.ALPHA) / total) * lid.SCALE) for x in grams(text))
            logs[g] = steps / lid.SCALE + math.log(sum(own == g for _, own in train) / len(train))
        best = max(labels, key=lambda g: (logs[g], [-ord(c) for c in g]))
        found = any(unicodedata.category(c)[0] == "L" for c in text)
        out.append((best, round(1 / sum(math.exp(v - logs[best]) for v in logs.values()), 6)) if found else ("und", 0.0))
    return out


def test_languages_equal_plain_bayes(spark):
    """Labels and scores of a Naive Bayes without hashing, on letters so few that no two n-grams share a column."""
    rng = random.Random(3)
    kinds = {"aa": "ka lo mi", "bb": "ko la mo", "cc": "éa lé m"}
    train = [(invented(rng, rng.randint(1, 9), kinds[g]), g) for g in kinds for _ in range(12)] + [("K4-lo\nMI", "aa")]
    texts = [invented(rng, rng.randint(1, 6), rng.choice(list(kinds.values()))) for _ in range(150)] + ["", "12 ?", "ÉA", "k", "kalo" * 50, None]
    h, _ = lid.grams([t for t, _ in train] + [t or "" for t in texts])
    letters = {c.lower()[0] for t in [*(t for t, _ in train), *(t or "" for t in texts)] for c in t if c.isalpha()}
    seen = {x for t in [*(t for t, _ in train), *(t or "" for t in texts)] for x in plain_grams_of(t)}
    assert len(letters) < 12 and len(np.unique(h)) == len(seen)
    model = lid.fit(table(spark, [(i, t, g) for i, (t, g) in enumerate(train)]))
    got = {r.doc_id: (r.lang_pred, r.score) for r in lid.predict(table(spark, [(i, t, None) for i, t in enumerate(texts)]), model).collect()}
    want = plain_bayes(train, [t or "" for t in texts])
    assert [got[i][0] for i in range(len(texts))] == [w[0] for w in want]
    assert max(abs(got[i][1] - w[1]) for i, w in enumerate(want)) <= 1e-6


def plain_grams_of(text):
    low = [c.lower()[0] if unicodedata.category(c)[0] == "L" else " " for c in text]
    padded = [" ", *low, " "]
    return {x for k, c in enumerate(low) if c != " " for x in ((c,), (c, padded[k + 2]), (padded[k], c, padded[k + 2]))}


def test_score_does_not_depend_on_neighbours(spark):
    rng = random.Random(2)
    texts = [invented(rng, rng.randint(0, 30)) for _ in range(50)] + ["", "a", "á" * 10]
    model = lid.fit(table(spark, [(i, t, "xy"[i % 2]) for i, t in enumerate(texts)]))
    together = lid.scored(texts, model)
    for k, text in enumerate(texts):
        label, score = lid.scored([text], model)
        assert (label[0], score[0]) == (together[0][k], together[1][k])
    h, begins = lid.grams(texts)
    assert [3 * n for n in np.diff(begins)] == [plain_grams(t) for t in texts] and h.shape == (begins[-1], 3)


#: The fixed patterns as a plain search has them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [c for c in m.group() if c in "0123456789"]
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn("".join(digits)), "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(4)
    parts = ["1", "2", "42", "255", "256", ".", "-", " ", "@", "a", "b.c", "@x.y", "+", "+1 (98", "(", ")", "%", "é", "4111111111111111", "ab@c.d", "1.2.3.4", "\n", "٣"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("1" * 100_000, "1." * 50_000, "+1" * 30_000, "a@" * 20_000):
        pii.base_spans(text)


#: The written addresses as a plain search has them.
WRITTEN = r"([A-Za-z0-9._%+-]+)\x20?(?:@|\(at\)|\[at\])\x20?([A-Za-z0-9-]+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]+)*)"


def test_written_addresses():
    rng = random.Random(8)
    parts = ["a", "b.c", "x-1", " ", "@", "(at)", "[at]", "(dot)", "[dot]", ".", "é", "\n", "%", "(", "at)"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        want = [(m.start(), m.end(1), m.start(2), m.end()) for m in re.finditer(WRITTEN, text)]
        got = [(b, e, a + (text[a] == " "), end) for b, e, a, end in pii._addresses(text)]
        assert got == want, text


def test_long_runs_take_linear_time(spark):
    million = 1_000_000
    texts = ["x" * million + "@" + "y" * million, "a@b " + "x" * million, "x" * million + " (at) y", "@" * million, "a@" * (million // 2), "a (at) " * 50_000, "1" * million + "@", "+1" * (million // 2), "x@y." * 100_000]
    field = pii.Field({})
    for text in texts:
        start = time.process_time()
        pii.nodes(text, pii.base_spans(text))
        assert time.process_time() - start < (1.0 if text[:2] not in ("a@", "a ", "x@") else 8.0), text[:20]  # the others hold many candidates
    start = time.process_time()
    for text in texts[:3]:
        pii.added_spans(text, pii.base_spans(text), field)
    assert time.process_time() - start < 3
    docs = table(spark, [(i, t, "en") for i, t in enumerate(texts[:3])])
    assert pii.found(docs, field).count() == 3 and pii.redacted(docs, field).select("text").distinct().count() == 3


def test_sample_of_any_share(spark):
    rows = spark.range(200_000).selectExpr("id doc_id", "'x' text")
    for share in (1.0, 0.25, 0.001):
        assert abs(rows.where(pii.drawn(share)).count() - share * 200_000) <= 5 * (share * 200_000) ** 0.5
    tiny = rows.select(F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("h")).agg(F.min("h")).first()[0] / (1 << 63)
    assert 0 < tiny < 1e-3 and rows.where(pii.drawn(tiny * 1.5)).count() >= 1 and pii.drawn(1e-12) is not None
    nameless = spark.range(20_000).selectExpr("cast(null as long) doc_id", "cast(id as string) text")
    assert 4000 < nameless.where(pii.drawn(0.25)).count() < 6000


def test_label_of_the_span_that_touches():
    text = ", ".join(f"10.0.0.{k}" for k in range(40)) + ", +1 (988) 555-2485"
    labels = [n.label for n in pii.nodes(text, pii.base_spans(text))]
    assert labels[-1] == 4 and set(labels[:-1]) == {2}


def test_messages_are_exact_without_cycles():
    rng = np.random.default_rng(0)
    unary, links = rng.normal(size=(5, 3)), [(a, b, rng.normal(size=(3, 3))) for a, b in ((0, 1), (1, 2), (1, 3), (3, 4))]
    want = np.zeros((5, 3))
    for y in itertools.product(range(3), repeat=5):
        weight = np.exp(sum(unary[i, y[i]] for i in range(5)) + sum(t[y[a], y[b]] for a, b, t in links))
        want[np.arange(5), y] += weight
    assert np.allclose(pii.propagate(unary, links), want / want.sum(1, keepdims=True), atol=1e-7)
    loop = [*links, (0, 4, np.eye(3))]
    assert np.allclose(pii.propagate(unary, loop).sum(1), 1)


def test_field_adds_what_the_document_repeats(odd, nothing, spark):
    field = pii.Field({})
    text = "call +1 (988) 555-2485 or a.b@mail.example.com. again (988) 555-2485; card 4111 1111 1111 1111, 4111.1111.1111.1111, a.b(at)mail.example.com, order 20240102"
    base = pii.base_spans(text)
    assert {(k, text[a:b]) for k, a, b in pii.added_spans(text, base, field)} == {("phone", "(988) 555-2485"), ("card", "4111.1111.1111.1111"), ("email", "a.b(at)mail.example.com")}
    clean = "on 2024-01-02 10:30 we counted 1234567 and 1234567 rows, (988) 555-2485 was 5 of 12.5.3"
    assert pii.added_spans(clean, pii.base_spans(clean), field) == []
    assert pii.masked("a b@c.de f", [("email", 2, 8)]) == "a [EMAIL] f"
    docs = table(spark, [(i, text if i % 2 else clean, "en") for i in range(40)])
    rows = {r.doc_id: r for r in pii.found(docs, pii.fit(docs)).collect()}
    assert (rows[1].n_email, rows[1].n_ip, rows[1].n_card, rows[1].n_phone) == (1, 0, 1, 1) and len(rows[1].spans.split(",")) == 6
    assert rows[1].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest() and rows[0].spans == ""
    out = pii.redacted(odd, pii.fit(odd))
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert pii.found(nothing, pii.fit(nothing)).count() == 0
    one = pii.redacted(docs, field).where("doc_id = 1").first()
    assert "555" not in one.text and one.n_chars == len(one.text)


def plain_best_fit(lengths, most):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(most - n)
    return sorted(room)


def test_best_fit():
    rng = random.Random(8)
    for _ in range(200):
        most = rng.choice([1, 7, 16, 100])
        lengths = np.array([rng.randint(1, most) for _ in range(rng.randint(0, 80))], int)
        got = packing.best_fit(lengths, most)
        assert sorted(k for r in got for k in r) == list(range(len(lengths)))
        assert sorted(most - sum(lengths[k] for k in r) for r in got) == plain_best_fit(lengths.tolist(), most)


def test_packed_rows(odd, nothing, spark, library, tmp_path):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    packed = packing.packed(docs, RANKS, public_tokenizers.PATTERN, 64)
    rows = [r.asDict(True) for r in packed.collect()]
    assert len({r["row_id"] for r in rows}) == len(rows)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 64 and r["cu_seqlens"][-1] == r["n_tokens"] <= 64 and r["resets"] == r["cu_seqlens"][:-1] and (ids[r["n_tokens"] :] == 50256).all()
    together = packing.unpacked(rows)
    for r in docs.collect():
        # the rank file has no special tokens, so their strings are ordinary text here
        parts = re.split(r"(<\|endoftext\|>)", r.text or "")
        if len(parts) == 1:
            assert together[r.doc_id].tolist() == [*library.encode(r.text or "", add_special_tokens=False).ids, 50256]
    assert set(together) == {r.doc_id for r in docs.collect()}
    assert packing.packed(nothing, RANKS, public_tokenizers.PATTERN).count() == 0
    assert sum(len(r.segments) for r in packing.packed(odd, RANKS, public_tokenizers.PATTERN, 1 << 17).collect()) == odd.count() + 1  # one text is longer than a row
    packing.write(packed, str(tmp_path / "m"))
    read = spark.read.parquet(str(tmp_path / "m")).collect()
    assert sum(r.n_rows for r in read) == len(rows)
    first = min(read, key=lambda r: r.first_row_id)
    assert np.frombuffer(first.ids, "<u2").reshape(first.n_rows, 64).shape == (first.n_rows, 64) and len(first.resets) == first.n_rows * 8


def test_licenses(spark, odd, nothing):
    mit = next(t for n, u, t in licenses.KNOWN if n == "MIT" and u == "text")
    changed = "Copyright (c) 2021 Some Body\n\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ,").replace("\n", "\n\n") + "\nAll rights reserved."
    rows = [(1, mit, None), (2, changed, None), (3, mit + " more", None), (4, "Some text.\nReleased under the MIT licence!\n(licensed under CC BY 4.0)\nReleased under the MIT License.", None), (4, mit, None)]
    got = licenses.scan(table(spark, rows), licenses.known(spark)).orderBy("doc_id", "license").collect()
    assert [(r.doc_id, r.license, r.n_notices, r.notices) for r in got] == [(1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 0, ""), (4, None, 3, "CC-BY-4.0,MIT"), (4, "MIT", 0, "")]
    assert got[0].text_digest == got[1].text_digest != got[2].text_digest
    out = licenses.scan(odd, licenses.known(spark))
    assert out.count() == odd.count() and {r.text_digest for r in out.where("doc_id in (1, 2, 3)").collect()} == {None}
    assert licenses.scan(nothing, licenses.known(spark)).count() == 0
    assert licenses.scan(odd, licenses.known(spark).limit(0)).where("license is not null or n_notices > 0").count() == 0


def test_licenses_in_usual_wordings(spark):
    file = lambda name: (licenses.TEXTS / f"{name}.txt").read_text()
    body = next(t for n, u, t in licenses.SHORT if n == "MIT" and u == "text").split("\n", 1)[1]
    isc = next(t for n, u, t in licenses.SHORT if n == "ISC" and u == "text").split("\n", 1)[1]
    bsd = "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + licenses._BSD.format("* ", "* ", "", *licenses._BSD_WHO[0])
    apache = file("Apache-2.0")
    rows = [
        ("MIT", "Copyright (c) 2020 Jane Doe\n\n" + body), ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n" + body), ("ISC", isc),
        ("BSD-2-Clause", bsd), ("BSD-2-Clause", "BSD 2-Clause License\n" + bsd), ("BSD-3-Clause", licenses._BSD.format("1. ", "2. ", "3. " + licenses._BSD_THIRD[0], *licenses._BSD_WHO[2])),
        ("Apache-2.0", apache), ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Jane Doe")), ("Apache-2.0", apache[: apache.index("APPENDIX")]),
        ("GPL-2.0", file("GPL-2.0").replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")),
        *((name, file(name)) for name in ("MPL-2.0", "Unlicense", "BSL-1.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")),
        *(("MIT", f"{line}\n\n{body}") for line in ("Copyright Jane Doe", "Copyright (c) Jane Doe", "Copyright © The Regents of X", "Portions copyright 2020 X", "Portions Copyright (c) Jane Doe & Co.",
          "Copyright (C) 2020-present Jane Doe, all of them, and everybody else who has ever helped", "SPDX-License-Identifier: MIT\nSPDX-FileCopyrightText: 2020 Jane Doe")),
        *(("MIT", re.sub(r"(.{1,%d}) " % width, r"\1\n", body)) for width in (20, 33, 60)), *((name, re.sub(r"(.{1,41})\s+", r"\1\n", text)) for name, text in (("Apache-2.0", apache[: apache.index("APPENDIX")]), ("MPL-2.0", file("MPL-2.0")), ("CC0-1.0", file("CC0-1.0")))),
        (None, "Copyright law is a sentence of its own\n" + body), (None, "Copyright notice\n" + body),
        (None, bsd + " too"), (None, apache.replace("perpetual", "yearly")),
    ]
    got = licenses.scan(table(spark, [(k, t, None) for k, (_, t) in enumerate(rows)]), licenses.known(spark)).orderBy("doc_id").collect()
    assert [r.license for r in got] == [name for name, _ in rows]
