"""Kneser-Ney models about given contexts alone, counted in packed arrays.

A model that answers for some contexts needs every n-gram once, for the shares of words, but only few of them by name. So the
n-grams aren't rows: each task packs those of about a million tokens, by order and by a range of hashes of the context, and a range
is summed and asked in one task. What is sent are a few bytes an n-gram, words as numbers in a list sent along; what is stored
are the answers.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.ngram_lm import NgramModel, shares, suffix_orders
from claimloom.operators.packed import ranges
from claimloom.session import materialize

# Tokens packed together, positions of a range (about), rows given on at once.
GROUP, RANGE, ROWS = 1_000_000, 2_000_000, 100_000
PACKED = "part int, n int, letters binary, lengths binary, ids binary, cnt binary"
KINDS = {"part": pa.int32(), "n": pa.int32()} | dict.fromkeys(("letters", "lengths", "ids", "cnt"), pa.binary())
ANSWERS = {"n": pa.int32(), "context": pa.string(), "word": pa.string(), "cnt": pa.int64(), "followers": pa.int64()}


def fit_for(docs: DataFrame, asked: DataFrame, n: int = 3, discount: float = 0.75, by: Sequence[str] = (), tokens: str = "tokens") -> NgramModel:
    """The model of ``docs`` as far as ``asked(context)`` or ``asked(context, word)`` needs it: the same answers about these.

    Contexts are the suffixes of the asked ones and the empty one. Counts are those of all words after them, or, where words are
    asked for, of these alone; single words are all there, and so are the shares of words. ``docs`` is read twice and should be
    stored. Its tokens hold no null and no blank; null in place of the tokens is no text.
    """
    by, docs = list(by), docs.select(*by, tokens)
    positions = docs.agg(F.sum(F.size(tokens) + 1).alias("s")).first()["s"]
    parts = 1 + (positions or 0) // RANGE
    of = {c: docs.schema[c].dataType.simpleString() for c in by}
    more = "".join(f", {c} {kind}" for c, kind in of.items())
    both, pairs = docs.mapInArrow(lambda batches: _packed(batches, n, parts, by, tokens), PACKED + more), "word" in asked.columns
    if n > 1:
        suffixes = asked.select(*["word"] * pairs, F.inline(suffix_orders(F.col("context"), n)))
        both = both.unionByName(suffixes.mapInArrow(lambda batches: _requests(batches, parts), PACKED), allowMissingColumns=True)
    answers = both.repartitionById(parts, "part").mapInArrow(lambda batches: _answers(batches, by, pairs), "n int, context string, word string, cnt long, followers long" + more)
    answers = materialize(answers, "lm-answers")
    counts = answers.where("context is not null and word is not null").select(*by, "n", "context", "word", "cnt")
    singles = counts.where("n = 1")
    empty = singles.groupBy(*by, "n", "context").agg(F.sum("cnt").alias("total"), F.count("*").alias("followers"))
    contexts = answers.where("word is null").select(*by, "n", "context", F.col("cnt").alias("total"), "followers").unionByName(empty)
    continued = answers.where("context is null").groupBy(*by, "n", "word").agg(F.sum("cnt").alias("continuations"))
    continued = continued.unionByName(singles.select(*by, "n", "word", F.lit(1).cast("long").alias("continuations")))
    return NgramModel(n, discount, tuple(by), counts, materialize(contexts, "lm-contexts"), materialize(shares(continued, *by), "lm-words"))


def _pack(numbers: np.ndarray) -> bytes:
    """The bytes of ``numbers``, the first of each, then the second of each, and so on, compressed."""
    planes = np.ascontiguousarray(numbers, "uint32").view("uint8").reshape(numbers.size, -1).T
    return _squeezed(planes.tobytes())


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(packed: pa.Scalar) -> pa.Buffer:
    raw = packed.as_buffer()
    return pa.decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8).to_pybytes(), "little"), codec="zstd")


def _unpack(packed: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(_spread(packed), "uint8").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("uint32").reshape(-1).astype("int64")


def _list(words: pa.Array, some: np.ndarray) -> dict[str, bytes]:
    """Some words as their letters one after another, and their lengths."""
    words = pa.concat_arrays([words.take(pa.array(some))])
    lengths = pc.binary_length(words).to_numpy()
    letters = words.buffers()[2]
    return {"letters": _squeezed(letters.slice(0, int(lengths.sum())).to_pybytes() if letters else b""), "lengths": _pack(lengths)}


def _listed(row: dict) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(_unpack(row["lengths"])))).astype("int32")
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), _spread(row["letters"]))


def _codes(words: pa.Array, places: int) -> np.ndarray:
    """A number for each word at each of ``places``; the sum of its words' numbers tells the range of a context."""
    out = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), "uint64", len(words))
    out = out + np.arange(1, places + 1, dtype="uint64")[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(by)
    return out ^ (out >> np.uint64(31))


def _part(context: list[np.ndarray], codes: np.ndarray, parts: int) -> np.ndarray:
    """The range of each context, given as the words at each place."""
    code = sum(codes[j][ids] for j, ids in enumerate(context))
    return ((code >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("int32")


def _key(columns: list[np.ndarray], size: int) -> np.ndarray:
    """One number for each row of ``columns``, which hold numbers below ``size``: equal for equal rows, and in their order."""
    key, bound = columns[0].astype("int64"), size
    for c in columns[1:]:
        if bound * size >= 2**63:
            known, key = np.unique(key, return_inverse=True)
            bound = len(known)
        key, bound = key * size + c, bound * size
    return key


def _edges(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))


def _row(row: dict, kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row.get(c)], kind) for c, kind in kinds.items()], list(kinds))


def _packed(batches: Iterator[pa.RecordBatch], n: int, parts: int, by: list[str], tokens: str) -> Iterator[pa.RecordBatch]:
    """The n-grams of each ``GROUP`` of tokens: a row for each order and range (and value of ``by``)."""
    held, size, kinds = [], 0, KINDS
    for batch in batches:
        kinds = KINDS | {c: batch.schema.field(c).type for c in by}
        batch = batch.filter(batch[tokens].is_valid())
        ends = np.cumsum(pc.list_value_length(batch[tokens]).to_numpy(zero_copy_only=False) + 1)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + GROUP - size, "right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - before)
            at = to
            if size >= GROUP or at < batch.num_rows:
                yield from _group(pa.Table.from_batches(held), n, parts, by, tokens, kinds)
                held, size = [], 0
    if held:
        yield from _group(pa.Table.from_batches(held), n, parts, by, tokens, kinds)


def _group(docs: pa.Table, n: int, parts: int, by: list[str], tokens: str, kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    if not by:
        yield from _ngrams(docs[tokens], n, parts, {}, kinds)
        return
    rows = defaultdict(list)
    for i, values in enumerate(zip(*(docs[c].to_pylist() for c in by))):
        rows[values].append(i)
    for values, some in rows.items():
        yield from _ngrams(docs[tokens].take(pa.array(some)), n, parts, dict(zip(by, values)), kinds)


def _ngrams(texts: pa.ChunkedArray, n: int, parts: int, values: dict, kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """A row for each order and range of the n-grams of ``texts``, each n-gram once with its count."""
    flat = pa.concat_arrays([pa.array(["<s>", "</s>"]), *(c.cast(pa.string()) for c in pc.list_flatten(texts).chunks)]).dictionary_encode()
    words, ids = flat.dictionary, flat.indices.to_numpy()
    lengths = pc.list_value_length(texts).to_numpy().astype("int64")
    # n - 1 start marks, the tokens, an end mark; every place but those of the start marks ends one n-gram of each order
    begins = np.cumsum(lengths + n) - (lengths + n)
    sequence = np.full(int((lengths + n).sum()), ids[0])
    place = ranges(begins + n - 1, lengths + 1)
    sequence[ranges(begins + n - 1, lengths)] = ids[2:]
    sequence[begins + lengths + n - 1] = ids[1]
    codes = _codes(words, max(1, n - 1))
    for k in range(1, n + 1):
        columns = [sequence[place - j] for j in range(k - 1, -1, -1)]
        key = _key(columns, len(words))
        order = np.argsort(key)
        first = _edges(key[order])
        cnt = np.diff(first, append=len(key))
        columns = [c[order[first]] for c in columns]
        part = _part(columns[:-1] or columns, codes, parts)  # single words are dealt by themselves
        by_part = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[by_part], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            yield _row({"part": int(p), "n": k, "cnt": _pack(cnt[by_part[edges[p] : edges[p + 1]]])} | _grams(columns, by_part[edges[p] : edges[p + 1]], words) | values, kinds)


def _grams(columns: list[np.ndarray], some: np.ndarray, words: pa.Array) -> dict:
    """The words at each place of ``some`` rows, as numbers in a list of their own."""
    known, ids = np.unique(np.stack([c[some] for c in columns]), return_inverse=True)
    return {"ids": _pack(ids), **_list(words, known)}


def _requests(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """What is asked of each range: contexts, each with a word if words are asked for. ``GROUP`` of them are packed together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch.filter(batch["context"].is_valid()))
        size += batch.num_rows
        if size >= GROUP:
            yield from _wanted(pa.Table.from_batches(held), parts)
            held, size = [], 0
    if held:
        yield from _wanted(pa.Table.from_batches(held), parts)


def _wanted(rows: pa.Table, parts: int) -> Iterator[pa.RecordBatch]:
    pairs = "word" in rows.schema.names
    for k in pc.unique(rows["n"]).to_pylist():
        some = rows.filter(pc.equal(rows["n"], k)).combine_chunks()
        cut = pc.split_pattern(some["context"].combine_chunks(), " ")
        whole = pc.equal(pc.list_value_length(cut), k - 1)  # another number of words is in no text
        some, cut = some.filter(whole), cut.filter(whole)
        if not some.num_rows:
            continue
        asked = [pc.fill_null(some["word"].combine_chunks(), "")] if pairs else []  # no word is empty
        flat = pa.concat_arrays([cut.flatten(), *asked]).dictionary_encode()
        words, ids = flat.dictionary, flat.indices.to_numpy()
        columns = [*ids[: some.num_rows * (k - 1)].reshape(-1, k - 1).T, *([ids[some.num_rows * (k - 1) :]] if pairs else [])]
        once = np.unique(_key(columns, len(words)), return_index=True)[1]
        columns = [c[once] for c in columns]
        part = _part(columns[: k - 1], _codes(words, k - 1), parts)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            yield _row({"part": int(p), "n": k} | _grams(columns, order[edges[p] : edges[p + 1]], words), KINDS)


def _answers(batches: Iterator[pa.RecordBatch], by: list[str], pairs: bool) -> Iterator[pa.RecordBatch]:
    """Of each range: all single words with their counts; for the longer orders words with the number of contexts in front of them
    (no ``context``), asked contexts with their total and number of followers (no ``word``), and counts of what is asked for."""
    asked, given, kinds = defaultdict(list), defaultdict(list), ANSWERS
    for batch in batches:
        kinds = ANSWERS | {c: batch.schema.field(c).type for c in by}
        for i in range(batch.num_rows):
            row = {c: batch[c][i] for c in batch.schema.names}
            part, k = row["part"].as_py(), row["n"].as_py()
            if row["cnt"].is_valid:
                given[part, k, tuple(row[c].as_py() for c in by)].append(row)
            else:
                asked[part, k].append(row)
    for part, k, values in [*given]:
        for columns in _answered(k, given.pop((part, k, values)), asked[part, k], pairs):
            rows = len(columns["cnt"])
            columns |= {c: pa.repeat(pa.scalar(v, kinds[c]), rows) for c, v in zip(by, values)} | {"n": pa.repeat(pa.scalar(k, pa.int32()), rows)}
            table = pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(rows, kind) for c, kind in kinds.items()], list(kinds))
            for at in range(0, rows, ROWS):
                yield table.slice(at, ROWS)


def _placed(rows: list[dict], listed: list[pa.Array], places: np.ndarray, columns: int) -> list[np.ndarray]:
    """The words at each place of all rows. ``listed`` are the rows' own words, ``places`` the numbers these have in one list."""
    base = np.cumsum([0, *map(len, listed)])
    return [*np.concatenate([places[b + _unpack(r["ids"])].reshape(columns, -1) for r, b in zip(rows, base)], axis=1)]


def _answered(k: int, given: list[dict], asked: list[dict], pairs: bool) -> Iterator[dict[str, pa.Array]]:
    listed = [_listed(r) for r in given]
    coded = pa.concat_arrays(listed).dictionary_encode()
    words = coded.dictionary
    columns = _placed(given, listed, coded.indices.to_numpy().astype("int64"), k)
    cnt = np.concatenate([_unpack(r["cnt"]) for r in given])
    if k == 1:
        yield {"context": pa.repeat("", len(words)), "word": words, "cnt": pa.array(np.bincount(columns[0], cnt, len(words)).astype("int64"))}
        return
    wanted = [np.empty(0, "int64")] * (k - 1 + pairs)
    if asked:
        listed = [_listed(r) for r in asked]
        wanted = _placed(asked, listed, pc.fill_null(pc.index_in(pa.concat_arrays(listed), words), -1).to_numpy().astype("int64"), k - 1 + pairs)
    known = np.all([c >= 0 for c in wanted[: k - 1]], axis=0)  # a context with an unknown word was never seen
    wanted = [c[known] for c in wanted]
    context, n = _key([np.concatenate(x) for x in zip(columns[:-1], wanted)], len(words)), len(cnt)
    context, wanted_context = context[:n], context[n:]
    begin_of, context = np.unique(context, return_inverse=True)
    gram = context * len(words) + columns[-1]
    order = np.argsort(gram)
    first = _edges(gram[order])
    cnt, gram = np.add.reduceat(cnt[order], first), gram[order[first]]
    context, word = np.divmod(gram, len(words))
    fronts = np.bincount(word, minlength=len(words))
    some = np.flatnonzero(fronts)
    yield {"word": words.take(pa.array(some)), "cnt": pa.array(fronts[some])}
    at = np.minimum(np.searchsorted(begin_of, wanted_context), len(begin_of) - 1)
    hit = np.flatnonzero(begin_of[at] == wanted_context)
    if not len(hit):
        return
    at, wanted = at[hit], [c[hit] for c in wanted]
    begin = _edges(context)
    size, total = np.diff(begin, append=len(context)), np.add.reduceat(cnt, begin)
    one = np.unique(at, return_index=True)[1]
    named = lambda rows: pc.binary_join_element_wise(*(words.take(pa.array(c[rows])) for c in wanted[: k - 1]), " ")
    yield {"context": named(one), "cnt": pa.array(total[at[one]]), "followers": pa.array(size[at[one]])}
    if pairs:
        there = np.flatnonzero(wanted[-1] >= 0)
        ask, of = np.unique(at[there] * len(words) + wanted[-1][there], return_index=True)
        there = there[of]
        found = np.minimum(np.searchsorted(gram, ask), len(gram) - 1)
        ok = gram[found] == ask
        yield {"context": named(there[ok]), "word": words.take(pa.array(word[found[ok]])), "cnt": pa.array(cnt[found[ok]])}
    else:
        found = ranges(begin[at[one]], size[at[one]])
        yield {"context": named(np.repeat(one, size[at[one]])), "word": words.take(pa.array(word[found])), "cnt": pa.array(cnt[found])}
