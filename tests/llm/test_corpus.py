"""Operators on whole tables: near duplicates, embeddings, scores, shards, benchmark items, and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimloom.llm import backoff, bagminhash, caps, decontaminate, kdshards
from claimloom.llm.common import components
from claimloom.llm.words import word_hashes
from tests.llm.conftest import invented, table
from tests.llm.plain import plain_classes, plain_components, plain_jaccard, plain_shingles, plain_words

SMALL = "/root/testdata/sf0.001"


def test_words(monkeypatch):
    from claimloom.llm import words

    rng = random.Random(1)
    texts = ["", "a", "A b-c", "é̀ ́ß 日本語 x1y2 ²", "ONE one One", *(invented(rng, rng.randint(0, 50)) for _ in range(30)), "q" * 300]
    for piece in (1 << 19, 40):
        monkeypatch.setattr(words, "PIECE", piece)
        words._powers.cache_clear()
        hashes, begins = word_hashes(texts)
        by_word: dict = {}
        for text, a, b in zip(texts, begins, begins[1:]):
            own = plain_words(text)
            assert len(own) == b - a
            for w, h in zip(own, hashes[a:b]):
                assert by_word.setdefault(w, h) == h
        assert len(set(by_word.values())) == len(by_word)
    words._powers.cache_clear()


def test_signatures_estimate_weighted_similarity():
    texts = ["a b c d e f g h i j", "a b c d e f g h x j", "z " * 200, "z " * 230, "z", "z z", "a b c d e f g h i j " * 3]
    row, shingle, count = bagminhash.multisets(texts)
    sig = bagminhash.signatures(row, shingle, count, len(texts), 4096)
    for i in range(len(texts)):
        for j in range(i):
            assert abs((sig[i] == sig[j]).mean() - plain_jaccard(plain_shingles(texts[i]), plain_shingles(texts[j]))) < 0.04
    assert np.isinf(bagminhash.signatures(*bagminhash.multisets(["", "?"]), 2, 8)).all()
    alone = bagminhash.signatures(*bagminhash.multisets([texts[3]]), 1, 4096)
    assert (alone[0] == sig[3]).all()


def test_signatures_do_not_depend_on_other_texts():
    rng = random.Random(12)
    few = [invented(rng, n) for n in range(5, 65)]
    others = [invented(rng, rng.randint(5, 300)) for _ in range(2_000)]

    def signed(texts):
        row, shingle, count = bagminhash.multisets(texts)
        return bagminhash.signatures(row, shingle, count, len(texts), bagminhash.BANDS * bagminhash.ROWS)

    alone = np.concatenate([signed([t]) for t in few])
    among = [np.concatenate([signed([t, *others[:n]])[:1] for t in few]) for n in (1, 50)] + [signed(few + others)[: len(few)]]
    for sig in among:
        assert (bagminhash.band_keys(sig) == bagminhash.band_keys(alone)).all()
        assert (sig.view(np.uint64) == alone.view(np.uint64)).all()


@pytest.mark.parametrize(("block", "size"), [(1024, 32_000_000), (4, 32_000_000), (1024, 10_000)])
def test_near_copies(spark, monkeypatch, block, size):
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", size)
    rng, rows = random.Random(5), []
    for family in range(6):
        base = invented(rng, 150).split()
        for k in range(12):
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(words), "en"))
    rows += [(1000 + k, rows[0][1], "en") for k in range(20)] + [(2000, invented(rng, 100), "en")]
    got = {r.doc_id: r.class_id for r in bagminhash.classes(table(spark, rows)).collect()}
    want = plain_classes([(i, t) for i, t, _ in rows])
    assert got == want and len(set(want.values())) > 6


def test_near_copies_of_odd_rows(spark, odd, nothing):
    got = bagminhash.classes(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r.class_id for r in got}
    assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, None: None, 9: 9, 10: 9, 11: 11, 12: 9, 13: 13, 14: 14}
    assert {r.doc_id for r in got if r.kept} == {1, 2, 3, 4, 7, 8, 9, 11, 13, 14}
    assert bagminhash.classes(nothing).count() == 0


def test_near_copies_of_long_texts(spark, monkeypatch):
    """Two blocks of a bucket hold few bytes however long its texts are, and texts larger than a block still meet."""
    rng, held = random.Random(6), []
    links = bagminhash.Bucket.links
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", 400_000)
    base = invented(rng, 5_000).split()
    rows = [(k, " ".join([*base[:k], f"x{k}", *base[k + 1 :]]), "en") for k in range(40)]
    longer = invented(rng, 40_000)
    rows += [(100, longer, "en"), (101, f"{longer} y", "en"), (102, f"{longer} y z", "en")]
    got = {r.doc_id: r.class_id for r in bagminhash.classes(table(spark, rows)).collect()}
    assert got == {**dict.fromkeys(range(40), 0), 100: 100, 101: 100, 102: 100}

    row, shingle, count = bagminhash.multisets([t for _, t, _ in rows])
    bucket = bagminhash.Bucket()
    for k in range(2):
        own = row == k
        bucket.add(k, 0, int(own.sum()), shingle[own].tobytes() + count[own].astype("<u4").tobytes(), b"\0" * 240)
        held.append(sum(x.nbytes for x in bucket.sets[k]) / own.sum())
    assert links(bucket, 0.8) == [(1, 0)] and set(held) == {bagminhash.SHINGLE_BYTES}


def test_rows_of_one_id_are_one_document(spark):
    rng = random.Random(8)
    a, b, c, d = (invented(rng, 80) for _ in range(4))
    rows = [(5, a, "en"), (5, b, "en"), (5, b, "en"), (6, f"{b} more", "en"), (3, a, "en"), (7, c, "en"), (7, c, "en"), (8, f"{c} more", "en"), (9, d, "en"), (9, None, "en"), (10, f"{d} more", "en"), (10, "?", "en")]
    got = [(r.doc_id, r.class_id, r.kept) for r in bagminhash.classes(table(spark, rows)).collect()]
    want = {5: 3, 6: 3, 3: 3, 7: 7, 8: 7, 9: 9, 10: 9}
    assert sorted(got) == sorted((i, want[i], want[i] == i) for i, _, _ in rows)
    many = [(1, invented(rng, 30), "en") for _ in range(300)] + [(2, a, "en")] * 300 + [(4, f"{a} more", "en")]
    got = {(r.doc_id, r.class_id) for r in bagminhash.classes(table(spark, many)).collect()}
    assert got == {(1, 1), (2, 2), (4, 2)}


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100)] + [(200, 201 + k) for k in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == plain_components({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_hubs(spark):
    """Stars around ids that are the smallest, the greatest and neither, with far more neighbours than a task takes."""
    star = spark.range(1, 30_001)
    edges = star.selectExpr("0L a", "id b").union(star.selectExpr("id + 40000 a", "100000L b")).union(star.selectExpr("if(id < 15000, id, id + 1) + 200000 a", "215000L b"))
    edges = edges.union(spark.createDataFrame([(5, 40_007)], "a long, b long"))
    got = components(edges).groupBy("component").count().collect()
    assert {(r["component"], r["count"]) for r in got} == {(0, 60_002), (200_001, 30_001)}


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    near = x[:150] + 0.25 * rng.normal(size=(150, 64)) * np.linalg.norm(x[:150], axis=1, keepdims=True) / 8
    hot = x[399] + 0.02 * rng.normal(size=(60, 64))
    every = np.vstack((x, near, hot)).astype(np.float32)
    rows = [(k, [float(v) for v in r], "c", 1) for k, r in enumerate(every)]
    odd_rows = [(1000, None, "c", 1), (1001, [0.0] * 64, "c", 1), (1002, [float("nan")] * 64, "c", 1), (1003, [1.0, None], "c", 1), (1004, [1.0, 2.0], "c", 1), (1005, [1.0, 2.0], "c", 1), (None, rows[0][1], "c", 1), (5, rows[5][1], "c", 1), (1006, [], "c", 1), (1007, [float("inf"), 1.0], "c", 1)]
    schema = "vec_id long, embedding array<float>, filters string, length int"
    got = caps.links(spark.createDataFrame(rows + odd_rows, schema)).collect()
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    found = sum(r.n_links for r in got if r.vec_id is not None and r.vec_id < 1000)
    by = {r.vec_id: r for r in got}
    assert len(got) == len(rows) + len(odd_rows)
    assert all(by[k].n_links <= n for k, n in enumerate(near.sum(1))) and found >= 0.98 * near.sum()
    assert all(by[k].n_links == n for k, n in enumerate(near.sum(1)) if k >= 550)
    assert (by[1004].n_links, by[1005].component_id, by[1000].n_links, by[1001].component_id, by[None].component_id) == (1, 1004, 0, 1001, None)
    want = plain_components(range(len(every)), [(int(a), int(b)) for a, b in zip(*near.nonzero())])
    assert sum(by[k].component_id != want[k] for k in want) <= 3
    assert caps.links(spark.createDataFrame([], schema)).count() == 0


def test_equal_vectors_count_as_many(spark, monkeypatch):
    """Many copies of a few vectors, some only a multiple of each other: compared once, counted all."""
    monkeypatch.setattr(caps, "BLOCK", 8)
    monkeypatch.setattr(caps, "COLUMNS", 16)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6, 32)).astype(np.float32)
    x[1] = x[0] + 0.01 * rng.normal(size=32)
    every = [x[0]] * 200 + [x[0] * 4] * 50 + [x[1]] * 30 + [x[2]] * 7 + list(x[3:])
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(len(every)), every)], "vec_id long, embedding array<float>")
    ids = [r.vec_id for r in df.collect()]
    by = {r.vec_id: r for r in caps.links(df).collect()}
    first, second = ids[:280], ids[280:287]
    assert all((by[i].n_links, by[i].component_id, by[i].kept) == (279, min(first), i == min(first)) for i in first)
    assert all((by[i].n_links, by[i].component_id) == (6, min(second)) for i in second) and all(by[i].n_links == 0 and by[i].kept for i in ids[287:])


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    for n, least in ((500, 0.99), (50_000, 0.99), (10**8, 0.9)):
        code = caps.Code(64, n)
        shared = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.filters(x), code.filters(y))]
        assert np.mean(shared) >= least
    vector = x[0]
    code = caps.Code(64, 1000)
    turned = vector @ code.turn
    sums = np.zeros(1)
    for (a, b), list_ in zip(zip(code.cuts, code.cuts[1:]), code.lists):
        sums = np.add.outer(sums, list_ @ turned[a:b]).ravel()
    assert set(np.argsort(-sums)[: caps.PASSED]) == set(code.filters(x[:1])[0].tolist())


def plain_scores(texts):
    words = [plain_words(t) for t in texts]
    counts = [Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in range(4)]
    total, out = sum(map(len, words)), []
    for own in words:
        mine = [Counter(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) for n in range(4)]
        rest = lambda g: counts[len(g)][g] - mine[len(g)][g]
        score, levels, n = 0.0, [0, 0, 0, 0], max(1, total - len(own))
        for i in range(len(own)):
            for k in (3, 2, 1, 0):
                g = tuple(own[i - k + 1 : i + 1])
                if k == 0 or (i + 1 >= k and rest(g) > 0):
                    break
            levels[k] += 1
            score += math.log((rest(g) if k else 1) / (rest(g[:-1]) if k > 1 else n)) + math.log(0.4) * (3 - k if k > 1 else 2)
        out.append((len(own), levels[3], levels[2], levels[1], levels[0], round(score, 4)))
    return out


@pytest.mark.parametrize("size", [2_000_000, 50])
def test_backoff(spark, odd, nothing, monkeypatch, size):
    rng = random.Random(11)
    texts = [invented(rng, rng.randint(0, 60), "ka lo") for _ in range(60)]
    monkeypatch.setattr(backoff, "RANGE_KEYS", size)
    got = backoff.scores(table(spark, [(i, t, None) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_three, r.n_two, r.n_one, r.n_new, r.log_score) for r in got] == plain_scores(texts)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)
    rows = odd.select("doc_id", "text").collect()
    want = Counter((i, *s) for (i, _), s in zip(rows, plain_scores([t for _, t in rows])))
    found = Counter((r.doc_id, r.n_words, r.n_three, r.n_two, r.n_one, r.n_new, r.log_score) for r in backoff.scores(odd).collect())
    assert Counter({k[:-1]: n for k, n in want.items()}) == Counter({k[:-1]: n for k, n in found.items()})
    assert backoff.scores(nothing).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("backoff")]


def test_backoff_in_relational_steps(spark, odd, nothing):
    rng = random.Random(13)
    texts = [invented(rng, rng.randint(0, 60), "ka lo") for _ in range(60)]
    docs = table(spark, [(i, t, None) for i, t in enumerate(texts)])
    assert Counter(map(tuple, backoff.relational(docs).collect())) == Counter(map(tuple, backoff.scores(docs).collect()))
    whole = lambda rows: Counter((*r[:6], None if r[7] is None else round(r[7], 4)) for r in rows)
    assert whole(backoff.relational(odd).collect()) == whole(backoff.scores(odd).collect()) and backoff.relational(nothing).count() == 0


def test_blocks_of_numbers():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (backoff.unpacked_sorted(backoff.packed_sorted(keys)) == keys).all() and len(backoff.unpacked(backoff.packed(keys[:0]))) == 0


def test_shards(spark, odd, nothing):
    rng = random.Random(12)
    rows = [(i, invented(rng, rng.randint(0, 80)), None) for i in range(700)] + [(1000 + i, "same " * 40, None) for i in range(300)]
    docs = table(spark, rows)
    for n in (40, 7, 1):
        got = kdshards.assigned(docs, n).collect()
        assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
        size, slots = Counter(), {}
        for r in got:
            size[r.shard] += r.size
            slots.setdefault(r.shard, []).append(r.slot)
        assert set(size) == set(range(n)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        most = max(r.size for r in got)
        assert max(size.values()) - min(size.values()) <= 3 * most
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    out = kdshards.assigned(odd)
    assert out.count() == odd.count() and {r.size for r in out.where("doc_id in (1, 2)").collect()} == {16} and {r.text_crc32 for r in out.where("doc_id in (1, 2)").collect()} == {0}
    assert out.select("shard", "slot").distinct().count() == odd.count()
    assert kdshards.assigned(nothing).count() == 0
    groups = kdshards.assigned(table(spark, [(i, f"{i // 5} text", None) for i in range(400)]), 8).groupBy("text_crc32").agg(F.countDistinct("shard").alias("k"))
    assert groups.where("k > 1").count() <= 7


def plain_leaks(docs, items):
    out = set()
    for item, text in items:
        question, answer = decontaminate.halves(text or "")
        asked, said = set(plain_shingles(question)), set(plain_words(answer))
        n = min(5, max(1, len(plain_words(question))))
        for doc, body in docs:
            words = plain_words(body)
            have = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
            if asked and len(asked & have) >= 0.8 * len(asked) and len(said & set(words)) >= 0.8 * len(said):
                out.add((doc, item))
    return out


@pytest.mark.parametrize("bins", [512, 4])
def test_shards_are_leaves_of_the_plain_tree(spark, monkeypatch, bins):
    """Recursive splits of sorted lists give the same shards, with repeated texts and one that holds a third of the rows."""
    monkeypatch.setattr(kdshards, "BINS", bins)
    monkeypatch.setattr(kdshards, "TOLERANCE", 0.0)
    rng = random.Random(21)
    texts = [invented(rng, rng.choice([3, 30, 200])) + "\n" * rng.randint(0, 5) + "\u00e9" * rng.randint(0, 9) for _ in range(50)]
    docs = table(spark, [(i, texts[0] if i % 3 == 0 else None if i % 41 == 0 else rng.choice(texts), "en") for i in range(300)])
    meta = kdshards.metadata(docs)
    rows = [r.asDict() for r in meta.collect()]
    assert all(0 <= r[c] <= 1 for r in rows for c in kdshards.DIMENSIONS)
    scale = {c: np.std([r[c] for r in rows]) or 1.0 for c in kdshards.DIMENSIONS}
    want = {}

    def split(part, first, n):
        if n == 1 or not part:
            want.update({r["doc_id"]: first for r in part})
            return
        widest = max(kdshards.DIMENSIONS, key=lambda c: round(np.std([r[c] for r in part]) / scale[c], 9))
        part = sorted(part, key=lambda r: (r[widest], r["h"], r["i"]))
        goal, sums, k = sum(r["size"] for r in part) * (n // 2) / n, 0, 0
        while sums + part[k]["size"] < goal:
            sums, k = sums + part[k]["size"], k + 1
        if goal - sums > sums + part[k]["size"] - goal:
            k += 1
        split(part[:k], first, n // 2)
        split(part[k:], first + n // 2, n - n // 2)

    split(rows, 0, 7)
    assert {r.doc_id: r.node for r in kdshards.leaves(meta, 7).collect()} == want


def test_decontamination(spark, odd, nothing, monkeypatch):
    rng = random.Random(13)
    items = [(k, ". ".join(invented(rng, rng.randint(6, 20)) for _ in range(rng.randint(1, 3))) + ".") for k in range(60)]
    items += [(100, invented(rng, 300)), (101, None), (102, " ?"), (103, items[0][1])]
    rows = [(i, invented(rng, rng.randint(0, 300)), "en") for i in range(150)]
    for i in range(60):
        words = invented(rng, 150).split()
        words.insert(rng.randrange(len(words)), items[i][1])
        rows.append((1000 + i, " ".join(words), "en"))
    rows.append((2000, "x " + items[60][1].upper() + " y", "en"))
    tests = spark.createDataFrame([(*x, "z", 1) for x in items], "item_id long, text string, score string, chunk int")
    docs = table(spark, rows)
    want = plain_leaks([r[:2] for r in rows], items)
    assert len(want) >= 62
    for size in (16_000_000, 900):
        monkeypatch.setattr(decontaminate, "CHUNK_BYTES", size)
        assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, tests).collect()} == want
        kept = decontaminate.without_leaks(docs, tests)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in want}
    assert decontaminate.leaks(odd, tests.limit(0)).count() == 0 and decontaminate.leaks(nothing, tests).count() == 0
    assert decontaminate.without_leaks(odd, tests).count() == odd.count() == decontaminate.without_leaks(odd, tests.limit(0)).count()


def test_bounds_lose_no_item():
    rng = random.Random(14)
    texts = [invented(rng, 25, "ka lo mi ten") for _ in range(80)]
    words = [word_hashes([t])[0] for t in texts]
    frequency = Counter(x for w in words for x in set(w.tolist()))
    index = decontaminate.Index(list(range(80)), texts, words, frequency, 80, float(np.mean([len(w) for w in words])))
    dense = np.zeros((len(index.terms), 80))
    dense[np.repeat(np.arange(len(index.terms)), np.diff(index.begin)), index.item] = index.impact
    window, terms = [], []
    for w in range(200):
        own = np.sort(rng.sample(range(len(index.terms)), rng.randint(1, len(index.terms))))
        window += [w] * len(own)
        terms += own.tolist()
    window, terms = np.array(window), np.array(terms)
    got = {(int(w), int(k)): s for w, k, s in zip(*index.retrieve(window, terms))}
    want = {(w, k): s for w in range(200) for k, s in enumerate(dense[terms[window == w]].sum(0)) if s >= decontaminate.THRESHOLD}
    assert got.keys() == want.keys() and want and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs.collect()
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "benchmark_leaks", "personal_data", "tokens"]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    classes = plain_classes([(r.doc_id, r.text) for r in kept])
    first = [r for r in kept if classes[r.doc_id] == r.doc_id]
    leaked = {d for d, _ in plain_leaks([(r.doc_id, r.text) for r in first], items)}
    got = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in first} - leaked
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == columns


def test_pipeline_on_odd_rows(spark, odd, nothing, tmp_path):
    for docs, n in ((odd, 8), (nothing, 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.write.parquet(str(tmp_path / f"{n}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{name}"))
        assert docs.count() == n
