import random

from claimloom.operators import ngram_lm


def test_next_words_of_the_asked_contexts_alone(spark):
    """Only the suffixes of asked contexts are kept, and the answers are those of the whole model."""
    rng = random.Random(5)
    docs = spark.createDataFrame([([rng.choice("abcdefgh") * 2 for _ in range(12)],) for _ in range(40)], "tokens array<string>")
    asked = spark.createDataFrame([("aa bb",), ("zz cc",), ("zz yy",)], "context string")
    model = ngram_lm.fit(docs, 3)
    small = model.after(asked)
    whole = sorted(map(tuple, ngram_lm.next_words(model.materialized(), asked).collect()))
    assert sorted(map(tuple, ngram_lm.next_words(small, asked).collect())) == whole and len(whole) == 15
    assert {(r["n"], r["context"]) for r in small.contexts.collect()} <= {(3, "aa bb"), (2, "bb"), (2, "cc"), (1, "")}
