"""Experiment tables: ablation, run log, best run, promotion, model history."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.functions.clean import clean
from claimloom.functions.tokens import drop_short
from claimloom.operators import evaluate, features, linear
from claimloom.operators.sampling import with_split
from claimloom.plans.preprocess import Preprocessing, analyzer_terms, fit_counts, split_counts
from claimloom.plans.scoring import CLASSES, vector_table
from claimloom.session import materialize

RUN_SCHEMA = (
    "run_id string, parent_run_id string, run_name string, params map<string,string>, metrics map<string,double>, "
    "step int, has_model boolean, logged_at timestamp"
)


@dataclass(frozen=True)
class Config:
    name: str
    options: Preprocessing
    max_features: int = features.MAX_FEATURES


# The ablation configurations.
CONFIGS = (
    Config("Config 1 - Base", Preprocessing()),
    Config("Config 2 - Standard stop words", Preprocessing("standard")),
    Config("Config 2.5 - Domain stop words", Preprocessing("domain")),
    Config("Config 3 - Stemming", Preprocessing("standard", stem=True)),
    Config("Config 4 - Lemmatization", Preprocessing("standard", lemma=True)),
    Config("Config 5 - TF-IDF max 1000", Preprocessing("standard", lemma=True), 1000),
    Config("Config 6 - Min token length 3", Preprocessing("standard", lemma=True, min_len=3)),
)


def run_config(docs: DataFrame, key: str, config: Config, label: str = "label", fit_on: str = "train") -> DataFrame:
    """Train the L2 model of one configuration and score its test rows: one metrics row.

    The vocabulary is fitted on the training rows; ``fit_on="all"`` fits it on all.
    """
    return run_terms(config_terms(split_texts(docs, key, label), key, config.options, label), key, config, label, fit_on)


def split_texts(docs: DataFrame, key: str, label: str = "label") -> DataFrame:
    """``key, label, tokens``: the tokens of the cleaned texts, counted and stored for every way of preprocessing."""
    text = F.col("cleaned_text") if "cleaned_text" in docs.columns else clean(F.col("text"))
    cleaned = materialize(docs.select(key, label, text.alias("cleaned_text")), "ablation-texts")
    return materialize(split_counts(cleaned).select(key, label, "tokens"), "ablation-tokens")


def config_terms(
    split: DataFrame, key: str, options: Preprocessing, label: str = "label", fitted: dict[Preprocessing, DataFrame] | None = None
) -> DataFrame:
    """The stored ``terms`` of one way of preprocessing, counted, with the split.

    ``fitted`` keeps tokens with lemmas for ways that differ by the minimum length alone.
    """
    fitted = {} if fitted is None else fitted
    any_length = replace(options, min_len=0)
    if any_length not in fitted:
        tokens = fit_counts(split, key, any_length)
        fitted[any_length] = materialize(tokens, "ablation-lemmas") if options.lemma and not options.stem else tokens
    tokens = fitted[any_length].withColumn("tokens", drop_short(F.col("tokens"), options.min_len, counted=True))
    return materialize(with_split(analyzer_terms(tokens).select(key, label, "terms"), key), "ablation-terms")


def run_terms(terms: DataFrame, key: str, config: Config, label: str = "label", fit_on: str = "train") -> DataFrame:
    """The same from stored terms."""
    fit_rows = terms if fit_on == "all" else terms.where(~F.col("is_test"))
    term_model = features.fit_terms(fit_rows, config.max_features).materialized()
    vectors, _ = vector_table(terms, term_model, label)
    vectors = vectors.select(key, label, "is_test", "features", "target").persist()
    train = vectors.where(~F.col("is_test"))
    model = linear.train_variants(train, variants=("l2",))["l2"]
    scored = score_vectors(model, vectors.where("is_test"), label)
    scored = materialize(scored.withColumn("config", F.lit(config.name)), "ablation-scores")
    vectors.unpersist()
    metrics = evaluate.summary_metrics(scored, label, CLASSES, ["config"])
    auc = evaluate.roc_auc(scored, F.col(label) == CLASSES[1], "score").withColumn("config", F.lit(config.name))
    return metrics.join(auc, "config")


def score_vectors(model, vectors: DataFrame, *keep: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    names = F.array(*[F.lit(c) for c in CLASSES])
    return model.transform(vectors).select(
        *keep,
        F.get(names, F.col("prediction").cast("int")).alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
    )


def ablation(docs: DataFrame, key: str, configs: Sequence[Config] = CONFIGS, fit_on: str = "train") -> DataFrame:
    """One row per configuration, in the shape of the run log. Each fit is its own distributed job.

    Texts are cleaned and split once, and configurations that preprocess alike share their terms.
    """
    split = split_texts(docs, key)
    stored: dict[Preprocessing, DataFrame] = {}
    fitted: dict[Preprocessing, DataFrame] = {}
    out = None
    for config in configs:
        started = time.monotonic()
        if config.options not in stored:
            stored[config.options] = config_terms(split, key, config.options, fitted=fitted)
        row = run_terms(stored[config.options], key, config, fit_on=fit_on)
        params = {
            **config.options.params(), "max_features": str(config.max_features), "test_size": "0.2", "model": "lr-l2",
        }
        metrics = [c for c in row.columns if c != "config"]
        record = run_record(
            row,
            F.lit(uuid.uuid4().hex),
            F.col("config"),
            F.create_map(*[F.lit(x) for kv in sorted(params.items()) for x in kv]),
            F.create_map(
                *[x for m in metrics for x in (F.lit(m), F.col(m))],
                F.lit("training_time_seconds"), F.lit(time.monotonic() - started),
            ),
        )
        out = record if out is None else out.unionByName(record)
    return out


def run_record(
    df: DataFrame, run_id: Column, name: Column, params: Column, metrics: Column, parent: Column | None = None,
    step: Column | None = None, has_model: bool = False,
) -> DataFrame:
    """Shape rows as run records."""
    return df.select(
        run_id.alias("run_id"),
        (F.lit(None).cast("string") if parent is None else parent).alias("parent_run_id"),
        name.alias("run_name"),
        params.alias("params"),
        metrics.alias("metrics"),
        (F.lit(None).cast("int") if step is None else step).alias("step"),
        F.lit(has_model).alias("has_model"),
        F.current_timestamp().alias("logged_at"),
    )


def new_run(
    spark: SparkSession, name: str, params: dict, metrics: dict, parent: str | None = None, has_model: bool = False,
    step: int | None = None, run_id: str | None = None,
) -> DataFrame:
    """One run record from driver values."""
    row = (
        run_id or uuid.uuid4().hex, parent, name, {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()}, step, has_model, None,
    )
    return spark.createDataFrame([row], RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())


def log_runs(runs: DataFrame, path: str) -> None:
    """Append run records to the log."""
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def stepped_metrics(runs: DataFrame) -> DataFrame:
    """``run_id, step, metric, value``: a row per logged value."""
    return runs.select("run_id", "step", F.explode("metrics").alias("metric", "value"))


def nested_metrics(runs: DataFrame) -> DataFrame:
    """``run_id, parent_run_id, step, metric, value``: the same with the run that each is nested in."""
    return runs.select("run_id", "parent_run_id", "step", F.explode("metrics").alias("metric", "value"))


def last_values(runs: DataFrame) -> DataFrame:
    """``run_id, metric, step, value``: of values logged at several steps the last; without a step comes first, and of one step the last logged."""
    at = F.struct(F.coalesce("step", F.lit(-1)).alias("step"), "logged_at", F.col("value"))
    values = runs.select("run_id", "step", "logged_at", F.explode("metrics").alias("metric", "value"))
    last = values.groupBy("run_id", "metric").agg(F.max(at).alias("l"))
    return last.select("run_id", "metric", F.when(F.col("l.step") >= 0, F.col("l.step")).alias("step"), F.col("l.value").alias("value"))


def ancestors(runs: DataFrame) -> DataFrame:
    """``run_id, ancestor``: a row for each run a run is nested in, at any depth. One join per level of nesting."""
    parents = materialize(runs.select("run_id", "parent_run_id").where("parent_run_id is not null").distinct(), "parents")
    up = parents.select(F.col("run_id").alias("parent_run_id"), F.col("parent_run_id").alias("above"))
    out = level = parents.select("run_id", F.col("parent_run_id").alias("ancestor"))
    while True:
        level = level.join(up, F.col("ancestor") == F.col("parent_run_id")).select("run_id", F.col("above").alias("ancestor"))
        level = materialize(level.join(out, ["run_id", "ancestor"], "left_anti"), "parents")  # a cycle ends here
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def nested_summary(runs: DataFrame) -> DataFrame:
    """``run_id, metric, runs, best_run, best, worst, last_run, last``: the last values of all runs nested in a run.

    ``best`` is the greatest value (ties: the smallest id), ``last`` the value with the greatest step.
    """
    values = ancestors(runs).join(last_values(runs), "run_id")
    grouped = values.groupBy(F.col("ancestor").alias("of"), "metric")
    facts = grouped.agg(
        F.count("*").alias("runs"), F.max("value").alias("best"), F.min("value").alias("worst"),
        F.max(F.struct(F.coalesce("step", F.lit(-1)).alias("s"), F.col("run_id").alias("r"), F.col("value").alias("v"))).alias("l"),
        F.min(F.struct((-F.col("value")).alias("v"), F.col("run_id").alias("r"))).alias("b"),
    )
    return facts.select(
        F.col("of").alias("run_id"), "metric", "runs", F.col("b.r").alias("best_run"), "best", "worst", F.col("l.r").alias("last_run"), F.col("l.v").alias("last")
    )


def metric(name: str) -> Column:
    """A metric of a run; 0 when it was not logged."""
    return F.coalesce(F.try_element_at("metrics", F.lit(name)), F.lit(0.0))


def flag(name: str) -> Column:
    """A boolean parameter as 1 or 0; anything that is not ``true`` is 0."""
    value = F.lower(F.coalesce(F.try_element_at("params", F.lit(name)), F.lit("")))
    return F.when(value == "true", 1).otherwise(0)


def flatten_runs(runs: DataFrame, flags: Sequence[str], numbers: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Runs as one flat numeric table."""
    return runs.select(
        "run_id",
        *[flag(f).alias(f) for f in flags],
        *[F.try_element_at("params", F.lit(n)).try_cast("double").alias(n) for n in numbers],
        *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics],
    )


def best_run(runs: DataFrame, name: str = "f1_weighted") -> DataFrame:
    """The run with a model and the greatest metric; ties go to the smallest id."""
    value = F.try_element_at("metrics", F.lit(name))
    return runs.where("has_model").orderBy(F.desc_nulls_last(value), "run_id").limit(1)


def promotion(
    runs: DataFrame, registry: DataFrame, model_name: str, name: str = "f1_weighted", threshold: float = 0.01
) -> DataFrame:
    """The registry after the best run is registered as a new version.

    It goes to Production when there is no production model, or when it is better by
    the threshold; the old production version is then archived. Otherwise it stays in
    Staging. ``registry`` is ``model_name, version, stage, run_id``.
    """
    mine = registry.where(F.col("model_name") == model_name)
    score = F.round(metric(name), 9)
    best = best_run(runs, name).select("run_id", score.alias("best"))
    # the production model with the newest version, if any, and the next free version: one row
    facts = mine.agg(
        F.max(F.when(F.col("stage") == "Production", F.struct("version", "run_id"))).alias("prod"),
        (F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"),
    )
    prod_run = facts.select(F.col("prod.run_id")).scalar()
    next_version = facts.select("next_version").scalar()
    prod_score = runs.where(F.col("run_id") == prod_run).agg(F.max(score)).scalar()
    promoted = prod_run.isNull() | (F.col("best") >= F.coalesce(prod_score, F.lit(0.0)) + threshold)
    new = best.select(
        F.lit(model_name).alias("model_name"),
        next_version.cast("int").alias("version"),
        F.when(promoted, "Production").otherwise("Staging").alias("stage"),
        "run_id",
    )
    wins = new.agg(F.max(F.col("stage") == "Production")).scalar()
    # promoting archives what was in production; other stages stay
    old = mine.withColumn(
        "stage", F.when(wins & (F.col("stage") == "Production"), "Archived").otherwise(F.col("stage"))
    ).select("model_name", F.col("version").cast("int").alias("version"), "stage", "run_id")
    others = registry.where(F.col("model_name") != model_name).select(*old.columns)
    return old.unionByName(new).unionByName(others)


def model_history(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """``model_name, version, stage, f1_weighted, accuracy``; a metric that was not logged is 0."""
    return registry.join(runs.select("run_id", "metrics"), "run_id", "left").select(
        "model_name", "version", "stage", metric("f1_weighted").alias("f1_weighted"), metric("accuracy").alias("accuracy")
    )


def registry_from_runs(runs: DataFrame, model_name: str, production: int) -> DataFrame:
    """Number runs as versions in id order; one of them is in production and the next one in Staging (bounded: one row per run)."""
    version = F.row_number().over(Window.orderBy("run_id"))
    return runs.select(
        F.lit(model_name).alias("model_name"), version.alias("version"), "run_id"
    ).select(
        "model_name", "version",
        F.when(F.col("version") == production, "Production").when(F.col("version") == production + 1, "Staging").otherwise("Archived").alias("stage"), "run_id",
    )
