"""Files of any size, raw files as a stream, nested runs, nearest vectors, curves in ranges."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.operators import evaluate, neighbours, vectors
from claimloom.plans import experiments
from claimloom.session import fresh_path
from claimloom.sources import files, lake
from claimloom.sources.uris import opened
from claimloom.streaming import jobs


def paths(spark, *names):
    return spark.createDataFrame([(str(n),) for n in names], "path string")


def test_headers_read_the_beginning_only(spark, tmp_path, monkeypatch):
    big, empty, bare = tmp_path / "b ig+%1.csv", tmp_path / "empty.csv", tmp_path / "bare.tsv"
    with open(big, "wb") as file:
        file.write(b'\xef\xbb\xbfid,"a, b",c\r\nx')
        file.truncate(3 << 30)  # three sparse gigabytes: reading them all would take a while, and a task's memory
    empty.write_text("")
    bare.write_text("x\ty")
    table = files.headers(paths(spark, big, empty, bare, tmp_path / "none.csv"), ",")
    got = {r["path"].rsplit("/", 1)[1]: (r["header"], r["names"], r["error"] is None) for r in table.collect()}
    assert got["b ig+%1.csv"][1:] == (["id", "a, b", "c"], True) and got["empty.csv"] == ("", None, True)
    assert got["bare.tsv"] == ("x\ty", ["x\ty"], True) and got["none.csv"] == (None, None, False)
    plan = table._jdf.queryExecution().toString()
    assert "Scan text" not in plan and "FileScan" not in plan and "MapInArrow" in plan
    read = []
    real = opened(str(big))[0]

    class Counting:
        def open_input_stream(self, name, compression=None):
            stream = real.open_input_stream(name, compression=compression)

            class Stream:
                __enter__, __exit__ = (lambda s: s), (lambda s, *a: None)

                def read(self, n):
                    read.append(n)
                    return stream.read(n)

            return Stream()

    monkeypatch.setattr(files, "opened", lambda p: (Counting(), p))
    assert files._first_line(str(big), 1 << 20)[0].endswith('"a, b",c') and sum(read) <= 4096


def test_raw_copy_of_a_large_file(spark, tmp_path):
    """Beyond two gigabytes, which is more than a row can hold."""
    source, size = tmp_path / "in" / "large file.bin", (2 << 30) + 12_345
    source.parent.mkdir()
    with open(source, "wb") as file:
        file.truncate(size)
        for at in (0, lake.CHUNK - 2, (1 << 31) - 1, size - 4):
            file.seek(at)
            file.write(b"mark")
    (source.parent / "empty").write_bytes(b"")
    store = lake.Lake(spark, str(tmp_path / "lake"))
    store.put_raw(str(source.parent), name="files", version="20240101000000")
    rows = store.fetch("raw").select("path", "at", F.octet_length("content").alias("n"), F.md5("content").alias("digest")).collect()
    large = sorted((r["at"], r["n"], r["digest"]) for r in rows if "large" in r["path"])
    assert len(large) == -(-size // lake.CHUNK) and sum(n for _, n, _ in large) == size and max(n for _, n, _ in large) == lake.CHUNK
    with open(source, "rb") as file:
        for at, n, digest in large:
            if at in (0, lake.CHUNK) or at + 2 * lake.CHUNK > size or at <= (1 << 31) < at + n:
                file.seek(at)
                assert hashlib.md5(file.read(n)).hexdigest() == digest
    assert not [r for r in rows if r["path"].endswith("empty")]  # nothing to keep


def test_a_file_that_shrinks_is_an_error(tmp_path):
    import pyarrow as pa

    (tmp_path / "x").write_bytes(b"abc")
    batch = pa.RecordBatch.from_pylist([{"path": str(tmp_path / "x"), "length": 5, "at": 0}])
    with pytest.raises(OSError, match="shorter"):
        list(lake._ranges([batch]))


def test_arrivals(spark, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "cp")
    (raw / "deep").mkdir(parents=True)
    run = lambda: jobs.clean_arrivals(spark, str(raw), ["id", "tweet"], "tweet", target, checkpoint, files_per_batch=2)
    rows = lambda: sorted((r["id"], r["cleaned_text"]) for r in spark.read.parquet(f"{target}/rows").collect())
    status = lambda: {r["path"].rsplit("/", 1)[1]: (r["status"], r["rows"], r["skipped"], r["detail"]) for r in spark.read.parquet(f"{target}/files").collect()}
    (raw / "a b+1%.csv").write_text('id,tweet\n1,"Hello, <b>World</b>!!\nagain"\n2,too,many,fields\n3\n')
    (raw / "deep" / "c.csv").write_text("id,tweet\n4,Fourth @you\n")
    run()
    first = [("1", "hello, world! again"), ("3", "nan"), ("4", "fourth")]
    assert rows() == first and status() == {"a b+1%.csv": ("cleaned", 2, 1, None), "c.csv": ("cleaned", 1, 0, None)}
    (raw / "other.csv").write_text("url,body\nx,y\nz,w,v\n")
    (raw / "late.csv").write_text("id,tweet\n5,Fifth\n")
    (raw / "none.csv").write_text("id,tweet\n")
    (raw / "note.txt").write_text("ignored")
    run()
    assert rows() == [*first, ("5", "fifth")]
    assert status()["other.csv"] == ("failed", 0, 0, "other columns") and status()["late.csv"] == ("cleaned", 1, 0, None) and len(status()) == 4
    run()  # nothing new
    assert len(rows()) == 4 and len(status()) == 4


def test_nested_runs(spark):
    path = fresh_path(spark, "runs")
    log = lambda *a, **k: experiments.log_runs(experiments.new_run(spark, *a, **k), path)
    log("top", {}, {}, run_id="top")
    log("mid", {}, {"f1": 0.1}, parent="top", run_id="mid")
    log("a", {}, {"f1": 0.5, "loss": 3.0}, parent="mid", run_id="a", step=0)
    log("a", {}, {"f1": 0.7, "loss": 2.0}, parent="mid", run_id="a", step=1)
    log("b", {}, {"f1": 0.7}, parent="mid", run_id="b", step=5)
    log("loop", {}, {"f1": 0.0}, parent="loop", run_id="loop")
    runs = experiments.read_runs(spark, path)
    last = {(r["run_id"], r["metric"]): (r["step"], r["value"]) for r in experiments.last_values(runs).collect()}
    assert last["a", "f1"] == (1, 0.7) and last["a", "loss"] == (1, 2.0) and last["mid", "f1"] == (None, 0.1)
    assert {tuple(r) for r in experiments.ancestors(runs).collect()} == {("mid", "top"), ("a", "mid"), ("a", "top"), ("b", "mid"), ("b", "top"), ("loop", "loop")}
    got = {(r["run_id"], r["metric"]): tuple(r)[2:] for r in experiments.nested_summary(runs).collect()}
    assert got["mid", "f1"] == (2, "a", 0.7, 0.7, "b", 0.7) and got["top", "f1"] == (3, "a", 0.7, 0.1, "b", 0.7)
    assert got["mid", "loss"] == (1, "a", 2.0, 2.0, "a", 2.0) and experiments.nested_summary(runs.limit(0)).count() == 0


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(150)]
    rows += [(150 + i, rows[i][1]) for i in range(10)] + [(170, [0.0] * 8), (171, None), (172, [math.nan] * 8), (173, [1.0, None, *[0.0] * 6])]
    table = spark.createDataFrame(rows, "id long, v array<double>")
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:160]}
    asked = [*range(0, 60), 152, 170, 171, 172]
    want = {}
    for q in asked:
        if q in good:
            order = sorted(((round(float(good[q] @ good[x]), 9), x) for x in good if x != q), key=lambda t: (-t[0], t[1]))[:7]
            want[q] = [x for _, x in order]
    for block in (1000, 16):
        got: dict = {}
        for r in neighbours.neighbours(table, table.where(F.col("id").isin(asked)), "id", "v", 7, block).orderBy("query", "rank").collect():
            got.setdefault(r["query"], []).append(r["key"])
        assert got == want
    words = table.where("id < 160").select(F.concat(F.lit("w"), F.lpad("id", 3, "0")).alias("word"), F.col("v").alias("vector"))
    near = vectors.similar_words(words, spark.createDataFrame([("w005",), ("unknown",)], "word string"), 3).orderBy("rank").collect()
    assert [r["word"] for r in near] == [f"w{x:03d}" for x in want[5][:3]] and near[0]["word"] == "w155" and near[0]["similarity"] == 1.0
    assert neighbours.neighbours(table.limit(0), table.limit(0), "id", "v").count() == 0


def test_curve_in_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["real", "fake"]), round(rng.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label string, score double")
    curves = [sorted(tuple(round(x, 9) for x in r) for r in evaluate.roc_curve(df, F.col("label") == "real", "score", points).collect()) for points in (1000, 7, 1)]
    assert curves[0] == curves[1] == curves[2] and curves[0][0][3:] == (1.0, 1.0)
    plan = evaluate.roc_curve(df, F.col("label") == "real", "score", 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(array(" not in plan.lower()
    assert evaluate.roc_curve(df.limit(0), F.col("label") == "real", "score").count() == 0
