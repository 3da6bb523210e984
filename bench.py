"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to its end through the no-op sink (every row and column is computed,
nothing is kept). A small folder warms the JVM up first when it is at hand.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from claimloom.plans.catalog import QUERIES
from claimloom.session import local_session

HEADLINE = (
    "clean_text", "strip_html", "regex_tokens", "treebank_tokens", "preprocess", "preprocess_stem", "oov_rate",
    "bow_counts", "tfidf_smooth", "tfidf_sublinear", "top_ngrams_by_class", "ngram_counts", "kn_perplexity",
    "kn_next_word", "lm_classify", "nb_train_tokens", "nb_predict", "nb_alpha_sweep", "classify_nb",
    "classify_batch_nb", "similar_claims", "class_report", "roc_auc", "dedupe_exact", "dataset_profile", "promotion",
    "lr_variants", "stream_score", "ablation",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "12g"), "claimloom-bench")
    names = sys.argv[1:] or HEADLINE
    small = Path(folder).parent / "sf0.001"
    if small.is_dir():
        for name in ("nb_predict", "tfidf_smooth"):
            run(spark, name, str(small))
    seconds = {name: round(run(spark, name, folder), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
