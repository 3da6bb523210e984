import pytest
from pyspark.sql import functions as F

from claimloom.operators import audit, linear, validate
from claimloom.plans import experiments, scoring
from claimloom.plans.preprocess import Preprocessing
from claimloom.session import fresh_path, materialize
from claimloom.sources import files
from claimloom.sources.lake import Lake
from claimloom.streaming import jobs

CLASSES = ("fake", "real")


@pytest.fixture(scope="module")
def claims(spark):
    fake = ["Secret cure kills the virus!", "Chips in vaccines are hidden", "Secret chips cure everything now"]
    real = ["Health ministry reports new cases", "Officials announced vaccine reports", "New health cases reported today"]
    rows = [(i, t, y) for i, (t, y) in enumerate([(t, "fake") for t in fake * 4] + [(t, "real") for t in real * 4])]
    return spark.createDataFrame(rows, "id long, text string, label string")


def test_file_job(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    (raw / "deep").mkdir(parents=True)
    (raw / "a.csv").write_text('id,tweet\n1,"Hello, <b>World</b>!!"\n2,too,many,fields\n3\n4,"line\nbreak"\n')
    (raw / "deep" / "b.tsv").write_text("k\tbody\nx1\ta much longer text @you\nx2\tother\n")
    (raw / "deep" / "note.txt").write_text("ignored")
    status = files.clean_folder(spark, str(raw), out)
    assert sorted((r["path"].rsplit("/", 1)[1], r["status"]) for r in status.collect()) == [("a.csv", "cleaned"), ("b.tsv", "cleaned")]
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    a = {r["id"]: r["cleaned_text"] for r in read.csv(f"{out}/schema=*/source_dir=__HIVE_DEFAULT_PARTITION__/source_name=cleaned_a").collect()}
    assert a == {"1": "hello, world!", "3": "nan", "4": "line break"}
    b = {r["k"]: r["cleaned_text"] for r in read.csv(f"{out}/schema=*/source_dir=deep/source_name=cleaned_b").collect()}
    assert b == {"x1": "a much longer text", "x2": "other"}
    again = files.clean_folder(spark, str(raw), out)
    assert {r["status"] for r in again.collect()} == {"skipped"}
    assert {r["id"] for r in files.drop_blank(spark.createDataFrame([(1, "x"), (2, ""), (3, None), (4, "nan")], "id int, cleaned_text string")).collect()} == {1}


def test_file_job_isolates_files(spark, tmp_path):
    raw, out = tmp_path / "raw data", str(tmp_path / "out")
    (raw / "a b").mkdir(parents=True)
    (raw / "a b" / "one two+3%.csv").write_text("id,tweet\n1,First claim\n2,too,many,fields\n")
    (raw / "x[1].csv").write_text("id,tweet\n3,Third claim\n")
    (raw / "t.tsv").write_text("id\ttweet\n4\tFourth, claim\n")
    (raw / "bad.csv").write_text("id,id\n5,Fifth claim\n")
    for at_once in (2, 100):
        status = {r["path"].rsplit("/", 1)[1]: r["status"] for r in files.clean_folder(spark, str(raw), out, files_at_once=at_once).collect()}
        good = "cleaned" if at_once == 2 else "skipped"
        assert status == {"one two+3%.csv": good, "x[1].csv": good, "t.tsv": good, "bad.csv": "failed"}
    rows = files.read_cleaned(spark, out).select("id", "cleaned_text", "source_dir", "source_name").collect()
    assert sorted((r["id"], r["cleaned_text"]) for r in rows) == [("1", "first claim"), ("3", "third claim"), ("4", "fourth, claim")]
    assert {r["source_name"] for r in rows} == {"cleaned_one two+3%", "cleaned_x[1]", "cleaned_t"} and {r["source_dir"] for r in rows} == {"a b", None}


def test_text_column(spark):
    df = spark.createDataFrame([(1, "short", "a longer body"), (2, None, "x")], "id int, a string, b string")
    assert files.text_column(df) == "b"
    assert files.text_column(df.withColumnRenamed("a", " Title ")) == " Title "


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = spark.range(3).withColumnRenamed("id", "x")
    lake.put_table(df, "claims", {"rows": 99, "note": True}, "20240101000000")
    lake.put_table(df.withColumn("y", F.lit("z")), "more", None, "20240102000000")
    with pytest.raises(Exception):
        lake.put_table(df, "claims", None, "20240101000000")
    assert lake.fetch("processed").count() == 6
    assert lake.fetch("processed", "20240101000000").columns == ["x", "version", "artifact"]
    assert lake.fetch("processed", pattern="m*").count() == 3
    assert lake.fetch("processed", "19990101000000") is None
    with pytest.raises(ValueError):
        lake.fetch("other")
    meta = {r["name"]: r["metadata"] for r in lake.manifest().collect()}
    assert meta["claims"]["rows"] == "3" and meta["claims"]["note"] == "true" and meta["claims"]["columns"] == "1"
    versions = {r["layer"]: r["versions"] for r in lake.list_versions().collect()}
    assert versions == {"raw": [], "processed": ["20240101000000", "20240102000000"], "embeddings": []}
    source = tmp_path / "src.csv"
    source.write_text("a,b\n1,2\n")
    lake.put_raw(str(source), version="20240103000000")
    assert bytes(lake.fetch("raw").first()["content"]) == b"a,b\n1,2\n"
    with pytest.raises(FileNotFoundError):
        lake.put_raw(str(tmp_path / "missing.csv"))
    lake.put_vectors(spark.createDataFrame([("w", [0.1])], "word string, vector array<double>"), "w2v", version="20240104000000")
    assert lake.fetch("embeddings").count() == 1


def test_validation(spark):
    rows = [("Short",), ("long enough text",), (None,), ("x" * 10001,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    checked = validate.with_reason(df, validate.text_reason(F.col("text"), "classify"))
    good, bad = validate.split_valid(checked)
    assert [r["text"] for r in good.collect()] == ["long enough text"]
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["text missing", "text too long", "text too short", "text too short"]
    batch = spark.createDataFrame([(["a"] * 101, 25), (["a"], 5), ([], 0)], "texts array<string>, k int")
    got = batch.select(validate.batch_reason(F.col("texts")).alias("b"), validate.top_k_reason(F.col("k")).alias("k")).collect()
    assert [tuple(r) for r in got] == [("batch too large", "top_k out of range"), (None, None), ("batch too small", "top_k out of range")]


def test_oov_rate(spark):
    docs = spark.createDataFrame([(1, ["A", "b", "b"]), (2, [])], "id int, tokens array<string>")
    vocab = spark.createDataFrame([("a",)], "term string")
    out = {r["id"]: r["oov_rate"] for r in audit.oov_rate(docs, vocab, "id").collect()}
    assert out == pytest.approx({1: 2 / 3, 2: 0.0})


@pytest.mark.parametrize("production, stage, old", [(0.88, "Production", "Archived"), (0.895, "Staging", "Production"), (None, "Production", None)])
def test_promotion(spark, production, stage, old):
    runs = [experiments.new_run(spark, "best", {}, {"f1_weighted": 0.90}, has_model=True, run_id="best"),
            experiments.new_run(spark, "no model", {}, {"f1_weighted": 0.99}, run_id="literal")]
    registry = spark.createDataFrame([], "model_name string, version int, stage string, run_id string")
    if production is not None:
        runs.append(experiments.new_run(spark, "prod", {}, {"f1_weighted": production}, has_model=True, run_id="prod"))
        registry = spark.createDataFrame([("m", 1, "Production", "prod")], registry.schema)
    table = runs[0]
    for r in runs[1:]:
        table = table.unionByName(r)
    out = {r["version"]: (r["stage"], r["run_id"]) for r in experiments.promotion(table, registry, "m").collect()}
    assert out[max(out)] == (stage, "best")
    if old:
        assert out[1] == (old, "prod")


def test_run_log(spark):
    path = fresh_path(spark, "runs")
    experiments.log_runs(experiments.new_run(spark, "a", {"stem": True, "k": 3}, {"f1_weighted": 0.5}, run_id="r1", step=2), path)
    experiments.log_runs(experiments.new_run(spark, "b", {"stem": "no"}, {}, parent="r1", run_id="r2"), path)
    runs = experiments.read_runs(spark, path)
    flat = {r["run_id"]: r for r in experiments.flatten_runs(runs, ["stem"], ["k"], ["f1_weighted"]).collect()}
    assert (flat["r1"]["stem"], flat["r1"]["k"], flat["r2"]["stem"], flat["r2"]["k"]) == (1, 3.0, 0, None)
    registry = spark.createDataFrame([("m", 1, "Production", "r2")], "model_name string, version int, stage string, run_id string")
    assert experiments.model_history(registry, runs).first()["f1_weighted"] == 0.0
    assert [tuple(r) for r in experiments.stepped_metrics(runs).collect()] == [("r1", 2, "f1_weighted", 0.5)]


def test_classify_and_retrieve(spark, claims):
    model = scoring.fit_claims(claims, "id")
    requests = spark.createDataFrame([(1, "Secret cure chips"), (2, "health cases reports"), (3, "zzz qqq")], "id long, text string")
    out = {r["id"]: r for r in scoring.classify(model, requests).collect()}
    assert (out[1]["prediction"], out[2]["prediction"]) == ("fake", "real")
    assert len(out) == 3 and out[3]["confidence"] == pytest.approx(0.5)
    assert sum(out[1]["class_probabilities"].values()) == pytest.approx(1)
    assert 0 < len(out[1]["top_contributing_features"]) <= 5
    batch = {r["id"]: (r["text"], r["prediction"]) for r in scoring.classify_batch(model, requests).collect()}
    assert batch[1] == ("Secret cure chips...", "fake")
    queries = spark.createDataFrame([(7, "secret virus cure"), (8, "zzz")], "q long, text string")
    top = scoring.retrieve(claims, queries, "id", "q", 3).orderBy("q", "rank").collect()
    assert [r["id"] for r in top if r["q"] == 8] == [0, 1, 2]
    assert top[0]["id"] == 0 and top[0]["similarity"] > top[2]["similarity"] - 1e-9
    assert scoring.retrieve(claims, queries, "id", "q", 20).count() == 40


def test_linear_models_and_stream(spark, claims):
    from claimloom.functions.clean import clean
    from claimloom.functions.tokens import word_tokens

    docs = materialize(claims.withColumn("terms", word_tokens(clean(F.col("text")))), "test-terms")
    pipeline = scoring.linear_pipeline(docs)
    batch = {r["id"]: tuple(r) for r in scoring.score_linear(pipeline, docs, "id").collect()}
    assert all(batch[r["id"]][1] == r["label"] for r in docs.collect())
    root = fresh_path(spark, "stream-test")
    claims.select("id", "text").write.parquet(f"{root}/in")
    stream = lambda: jobs.file_stream(spark, f"{root}/in", "id long, text string")
    jobs.run_available(jobs.scored_stream(stream(), pipeline, "id"), f"{root}/out", f"{root}/cp")
    assert {r["id"]: tuple(r) for r in spark.read.parquet(f"{root}/out").collect()} == batch
    # a second run finds nothing new
    jobs.run_available(jobs.scored_stream(stream(), pipeline, "id"), f"{root}/out", f"{root}/cp")
    assert spark.read.parquet(f"{root}/out").count() == len(batch)
    model = scoring.fit_claims(claims, "id", options=Preprocessing("standard"))
    jobs.score_batches(stream(), lambda df: scoring.classify_batch(model, df), f"{root}/nb", f"{root}/cp2")
    assert spark.read.parquet(f"{root}/nb").count() == len(batch)

    term_model = scoring.features.fit_terms(docs).materialized()
    table, _ = scoring.vector_table(docs, term_model, "label")
    models = linear.train_variants(table.select("features", "target").persist(), C=10.0)
    weights = linear.all_importances(models, term_model.vocabulary)
    nonzero = {r["variant"]: r["nonzero_weights"] for r in linear.weight_summary(weights).collect()}
    assert nonzero["l1"] <= nonzero["l2"]
    first = linear.feature_importance(models["l2"], term_model.vocabulary).first()
    assert first["abs_val"] == pytest.approx(abs(first["coefficient"]))
    poly = linear.train_polynomial(table.select("features", "target"), 2, selected=3)
    assert poly.transform(table).count() == 24


def test_ablation_row(spark, claims):
    more = claims.unionByName(claims.withColumn("id", F.col("id") + 100))
    runs = experiments.ablation(more, "id", experiments.CONFIGS[3:5])
    rows = runs.collect()
    assert len(rows) == 2 and all(0 <= r["metrics"]["accuracy"] <= 1 and r["metrics"]["training_time_seconds"] > 0 for r in rows)
    assert rows[0]["params"]["stem"] == "True"


def test_ablation_splits_texts_once(spark, claims, monkeypatch):
    from claimloom.functions import tokens

    calls, split = [], tokens.treebank_tokens
    monkeypatch.setattr(tokens, "treebank_tokens", lambda text: calls.append(1) or split(text))
    more = claims.unionByName(claims.withColumn("id", F.col("id") + 100))
    assert experiments.ablation(more, "id", (experiments.CONFIGS[0], experiments.CONFIGS[6])).count() == 2
    assert len(calls) == 1
