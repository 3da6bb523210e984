"""Kneser-Ney n-gram language models as count tables.

All orders 1..n (and all classes, when the models are per class) live in the same
three tables, so training is one pass and scoring is three equi-joins whatever n is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.tokens import ngrams
from claimloom.operators.keyed import lookup
from claimloom.session import broadcast_if_small, materialize

FLOOR = 1e-10  # probability used where the model gives none


@dataclass
class NgramModel:
    """Tables of a trained model; ``by`` are extra key columns, one model per value."""

    n: int
    discount: float
    by: tuple[str, ...]
    counts: DataFrame  # by, n, context, word, cnt
    contexts: DataFrame  # by, n, context, total, followers
    words: DataFrame  # by, n, word, p_cont

    def materialized(self) -> NgramModel:
        """The same model with its tables written once: scoring reads each of them several times."""
        counts = materialize(self.counts, "lm-counts")
        contexts = materialize(context_counts(counts, *self.by), "lm-contexts")
        words = materialize(continuation_shares(counts, *self.by), "lm-words")
        return replace(self, counts=counts, contexts=contexts, words=words)

    def after(self, asked: DataFrame) -> NgramModel:
        """The model, stored, with counts and contexts of only the suffixes of ``asked(context)``, and of the empty one: the same answers
        about these. Shares of words are those of the whole model. Only what the asked contexts hold is grouped by context and written."""
        counts = materialize(self.counts, "lm-counts")
        words = materialize(continuation_shares(counts, *self.by), "lm-words")
        suffixes = asked.select(F.inline(suffix_orders(F.col("context"), self.n))).distinct()
        suffixes = materialize(suffixes.unionByName(suffixes.sparkSession.createDataFrame([(1, "")], "n int, context string")), "lm-asked")
        own = materialize(counts.join(broadcast_if_small(suffixes), ["n", "context"], "left_semi").select(*counts.columns), "lm-asked-counts")
        return replace(self, counts=own, contexts=materialize(context_counts(own, *self.by), "lm-contexts"), words=words)


def explode_ngrams(docs: DataFrame, n: int, *keep: str, tokens: str = "tokens", orders: Sequence[int] | None = None):
    """``keep..., n, context, word`` for every order: a narrow generator."""
    parts = [ngrams(F.col(tokens), k) for k in (orders or range(1, n + 1))]
    return docs.select(*keep, F.inline(F.concat(*parts)))


def ngram_counts(docs: DataFrame, n: int, *by: str, tokens: str = "tokens") -> DataFrame:
    """``by..., n, context, word, cnt`` with map-side partial counts.

    With padding every position ends one n-gram of each order, and the shorter ones are
    its last words. So only the longest are unfolded and counted from the texts; these
    counts are stored, and the shorter orders are sums of them. Tokens hold no blank.
    """
    counted = explode_ngrams(docs, n, *by, tokens=tokens, orders=[n]).groupBy(*by, "context", "word").agg(F.count("*").alias("cnt"))
    longest = materialize(counted, "lm-longest") if n > 1 else counted
    out = longest.select(*by, F.lit(n).alias("n"), "context", "word", "cnt")
    for k in range(n - 1, 0, -1):
        last = F.substring_index("context", " ", 1 - k) if k > 1 else F.lit("")
        sums = longest.groupBy(*by, last.alias("context"), "word").agg(F.sum("cnt").alias("cnt"))
        out = out.unionByName(sums.select(*by, F.lit(k).alias("n"), "context", "word", "cnt"))
    return out


def context_counts(counts: DataFrame, *by: str) -> DataFrame:
    """``by..., n, context, total, followers``."""
    return counts.groupBy(*by, "n", "context").agg(F.sum("cnt").alias("total"), F.count("*").alias("followers"))


def continuation_counts(counts: DataFrame, *by: str) -> DataFrame:
    """``by..., n, word, continuations``: distinct contexts in front of a word at the same order."""
    return counts.groupBy(*by, "n", "word").agg(F.count("*").alias("continuations"))


def lm_vocabulary(docs: DataFrame, n: int, tokens: str = "tokens") -> DataFrame:
    """``word``: every token plus the end mark, and the start mark when the order needs one."""
    marks = ["</s>"] + (["<s>"] if n > 1 else [])
    every = F.concat(F.array_distinct(F.col(tokens)), F.array(*map(F.lit, marks)))
    return docs.select(F.explode(every).alias("word")).distinct()


def continuation_shares(counts: DataFrame, *by: str) -> DataFrame:
    """``by..., n, word, p_cont``; the totals are a handful of rows from the already aggregated words."""
    return shares(continuation_counts(counts, *by), *by)


def shares(words: DataFrame, *by: str) -> DataFrame:
    """``by..., n, word, p_cont`` from ``words(by..., n, word, continuations)``."""
    totals = words.groupBy(*by, "n").agg(F.sum("continuations").alias("all"))
    return words.join(F.broadcast(totals), [*by, "n"]).select(*by, "n", "word", (F.col("continuations") / F.col("all")).alias("p_cont"))


def fit(docs: DataFrame, n: int = 3, discount: float = 0.75, by: Sequence[str] = (), tokens: str = "tokens") -> NgramModel:
    counts = ngram_counts(docs, n, *by, tokens=tokens)
    return NgramModel(n, discount, tuple(by), counts, context_counts(counts, *by), continuation_shares(counts, *by))


def suffix_orders(context: Column, n: int) -> Column:
    """``array<struct<n, context>>``: the full context and the shorter ones, down to order 2."""
    words = F.filter(F.split(context, " "), lambda w: w != "")
    levels = [
        F.struct(F.lit(k).alias("n"), F.array_join(F.slice(words, F.lit(n - k + 1), F.lit(k - 1)), " ").alias("context"))
        for k in range(n, 1, -1)
    ]
    return F.array(*levels) if levels else F.array().cast("array<struct<n:int,context:string>>")


def _unigram_level(model: NgramModel) -> Column:
    """The level of last resort. Its context is empty, so it is looked up in a scalar, never joined on."""
    key = F.to_json(F.struct(*model.by)) if model.by else F.lit("")
    value = F.struct("n", "context", "total", "followers")
    per_model = model.contexts.agg(
        F.map_from_entries(F.collect_list(F.when(F.col("n") == 1, F.struct(key.alias("k"), value.alias("v")))))
    ).scalar()
    return F.try_element_at(per_model, key)


def context_levels(model: NgramModel, contexts: DataFrame) -> DataFrame:
    """``by..., full, n, context, total, followers``: the longest suffix of each context seen in training."""
    by = list(model.by)
    full = contexts.select(*by, F.col("context").alias("full")).distinct()
    seen = full.select(*by, "full", F.inline(suffix_orders(F.col("full"), model.n))).join(
        model.contexts, [*by, "n", "context"]
    )
    longest = seen.groupBy(*by, "full").agg(F.max(F.struct("n", "context", "total", "followers")).alias("b"))
    return full.join(longest, [*by, "full"], "left").select(
        *by, "full", F.coalesce("b", _unigram_level(model)).alias("b")
    ).where("b is not null").select(*by, "full", "b.*")


def probabilities(model: NgramModel, grams: DataFrame) -> DataFrame:
    """``by..., context, word, level, p``: the probability of ``word`` after ``context`` (full order).

    ``grams`` holds distinct ``by..., context, word`` rows. The context that counts is
    the longest one seen in training: an unseen context drops its first word.
    Interpolation uses the continuation counts of that same order.
    """
    by = list(model.by)
    levels = context_levels(model, grams)
    scored = (
        grams.select(*by, F.col("context").alias("full"), "word")
        .join(levels, [*by, "full"])
        .join(model.counts, [*by, "n", "context", "word"], "left")
    )
    # stored, as it is read twice; a frequent word follows many contexts
    scored = materialize(scored, "lm-scored")
    scored = lookup(scored, model.words, [*by, "n", "word"], ["full"], "left")
    d = F.lit(model.discount)
    p = F.greatest(F.coalesce("cnt", F.lit(0)) - d, F.lit(0.0)) / F.col("total") + d * F.col("followers") / F.col(
        "total"
    ) * F.coalesce("p_cont", F.lit(0.0))
    return scored.select(*by, F.col("full").alias("context"), "word", F.col("n").alias("level"), p.alias("p"))


def log_p(p: Column) -> Column:
    return F.log(F.when(p > 0, p).otherwise(F.lit(FLOOR)))


def perplexity_by(model: NgramModel, docs: DataFrame, *keys: str, tokens: str = "tokens") -> DataFrame:
    """``keys..., [by...,] positions, perplexity``; no keys give the perplexity of the whole corpus.

    Repeated n-grams of the corpus are scored once and weighted by their counts. With
    per-class models every document is scored under every class.
    """
    return perplexity_of(model, positions(docs, model.n, *keys, tokens=tokens), *keys)


def positions(docs: DataFrame, n: int, *keys: str, tokens: str = "tokens") -> DataFrame:
    """``keys..., context, word, times``, stored: how often each n-gram of the full order occurs."""
    every = explode_ngrams(docs, n, *keys, tokens=tokens, orders=[n])
    return materialize(every.groupBy(*keys, "context", "word").agg(F.count("*").alias("times")), "lm-positions")


def perplexity_of(model: NgramModel, counted: DataFrame, *keys: str) -> DataFrame:
    """``perplexity_by`` of n-grams counted by ``positions``."""
    distinct = counted.select("context", "word").distinct()
    if model.by:
        # one row per model and n-gram; the list of models is small and known from the unigram contexts
        models = model.contexts.where("n = 1").select(*model.by).collect()
        labels = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(model.by, m)]) for m in models])
        distinct = distinct.select("context", "word", F.inline(labels))
    scored = probabilities(model, distinct)
    return (
        counted.join(scored, ["context", "word"])
        .groupBy(*keys, *model.by)
        .agg(
            F.sum("times").alias("positions"),
            F.exp(-F.sum(F.col("times") * log_p(F.col("p"))) / F.sum("times")).alias("perplexity"),
        )
    )


def corpus_perplexity(model: NgramModel, docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row; an empty corpus gives infinity."""
    return single_row(perplexity_by(model, docs, tokens=tokens))


def single_row(row: DataFrame) -> DataFrame:
    return row.select(
        F.coalesce("positions", F.lit(0)).alias("positions"),
        F.coalesce("perplexity", F.lit(float("inf"))).alias("perplexity"),
    )


def classify_by_perplexity(model: NgramModel, docs: DataFrame, key: str, label: str, tokens: str = "tokens") -> DataFrame:
    """``key, prediction, perplexity``: the class whose model is least surprised; ties go to the smallest class."""
    return least_surprised(perplexity_by(model, docs, key, tokens=tokens), key, label)


def least_surprised(per_class: DataFrame, key: str, label: str) -> DataFrame:
    return per_class.groupBy(key).agg(
        F.min(F.struct(F.round("perplexity", 6).alias("perplexity"), F.col(label).alias("prediction"))).alias("b")
    ).select(key, "b.prediction", "b.perplexity")


def fit_context(context: Column, n: int) -> Column:
    """A token array as a context of n-1 words: padded with ``<s>`` on the left, or cut to the last words."""
    padded = F.concat(F.array_repeat(F.lit("<s>"), n - 1), context)
    return F.array_join(F.slice(padded, F.size(padded) - F.lit(n - 2), F.lit(n - 1)), " ") if n > 1 else F.lit("")


def next_words(model: NgramModel, contexts: DataFrame, k: int = 5) -> DataFrame:
    """``context, word, p, rank``: the k likeliest words after each distinct context.

    Words seen after the context come from the count table by an equi-join. All other
    words only have their continuation share times one factor per context, so the k
    greatest shares of an order serve every context (see ``_filler``). Nothing is
    crossed with the vocabulary.
    """
    if model.by:
        raise ValueError("next words need a single model")
    levels = context_levels(model, contexts)
    # contexts that share a level share its answer: rank each level once
    used = levels.select("n", "context", "total", "followers").distinct()
    d = F.lit(model.discount)
    lam = d * F.col("followers") / F.col("total")
    followers = (
        used.join(model.counts, ["n", "context"])
        .join(model.words, ["n", "word"])
        .select(
            "n", "context", "word",
            (F.greatest(F.col("cnt") - d, F.lit(0.0)) / F.col("total") + lam * F.col("p_cont")).alias("p"),
        )
    )
    filler = _filler(model, used, k).select("n", "context", "word", (lam * F.col("p_cont")).alias("p"))
    # a follower that is also filler keeps its greater, true probability
    every = followers.unionByName(filler).groupBy("n", "context", "word").agg(F.max("p").alias("p"))
    rank = F.row_number().over(Window.partitionBy("n", "context").orderBy(F.desc("p"), "word"))
    ranked = every.where("p > 0").withColumn("p", F.round("p", 9)).withColumn("rank", rank).where(F.col("rank") <= k)
    return levels.join(ranked, ["n", "context"]).select(F.col("full").alias("context"), "word", "p", "rank")


def _filler(model: NgramModel, used: DataFrame, k: int) -> DataFrame:
    """The k greatest continuation shares of each order, given to the contexts of that order.

    k of them are enough: a word in front of them that also follows the context only
    rises, so the k best of "followers or filler" are the k best of the vocabulary.
    """
    top = Window.partitionBy("n").orderBy(F.desc("p_cont"), "word")
    shares = model.words.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
    lists = shares.groupBy("n").agg(F.collect_list(F.struct("word", "p_cont")).alias("top"))
    # at most n rows of k words each
    return used.join(F.broadcast(lists), "n").select("n", "context", "total", "followers", F.inline("top"))


def _uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) from the digits of a hash of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**12))


#: A range of a draw holds about this many words at most, and a task about as many points; a step chooses among 16**DIGITS ranges.
RANGE_ROWS, DIGITS = 50_000, 2


def _prefix(words: int, rows: int | None = None) -> int:
    """How many hash digits cut so many words into ranges of at most about ``rows``; DIGITS at least, and a multiple of it."""
    digits = DIGITS
    while words > (rows or RANGE_ROWS) * 16**digits:
        digits += DIGITS
    return digits


def _drawn(weights: DataFrame, asked: DataFrame, *keys: str) -> DataFrame:
    """``full, word``: for each row of ``asked(full, keys..., u)`` the word at share ``u`` of the weights of its keys.

    The words of a key lie one after another in the order of their hash, each as long as
    its weight. A point goes down the digits of the hash, a few at a time: each step
    chooses among the 16**DIGITS ranges below the one reached, by their running totals, so
    neither a key with the whole vocabulary nor a point ever meets more than that. In the
    last range points and words are put in one order. A range with many points, such as
    that of a word with a third of all weight, has them dealt over salts, its words
    repeated once per salt: no more rows than there are points.
    """
    weights = materialize(weights.withColumn("hash", F.md5("word")), "draw-weights")
    digits = _prefix(weights.count())
    points = asked.select("full", *keys, "u", F.lit("").alias("range"), F.lit(0.0).alias("at"))
    for d in range(DIGITS, digits + 1, DIGITS):
        steps = materialize(_ranges(weights, d, *keys), "draw-ranges")
        met = lookup(points, steps, [*keys, "range"], ["full"])
        at = F.col("u") * F.col("all") if d == DIGITS else F.col("at")
        met = met.withColumn("at", at).withColumn("r", F.element_at(F.filter("ranges", lambda r: r["begin"] <= F.col("at")), -1))
        points = met.select("full", *keys, "u", F.col("r.range").alias("range"), (F.col("at") - F.col("r.begin")).alias("at"))
    points = materialize(points.drop("u"), "draw-points")
    many = points.groupBy(*keys, "range").agg(F.ceil(F.count("*") / RANGE_ROWS).cast("int").alias("parts")).where("parts > 1")
    many = materialize(many, "draw-salts")  # fewer than one for each RANGE_ROWS points
    parts = F.coalesce("parts", F.lit(1))
    points = lookup(points, many, [*keys, "range"], ["full"], "left").withColumn("salt", F.pmod(F.xxhash64("full"), parts).cast("int")).drop("parts")
    rows = weights.select(*keys, F.substring("hash", 1, digits).alias("range"), "hash", "word", "w")
    inside = Window.partitionBy(*keys, "range").orderBy("hash", "word").rowsBetween(Window.unboundedPreceding, 0)
    begins = rows.withColumn("at", F.sum("w").over(inside) - F.col("w")).drop("hash", "w")
    begins = lookup(begins, many, [*keys, "range"], ["word"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    both = points.withColumn("word", F.lit(None).cast("string")).unionByName(begins.withColumn("full", F.lit(None).cast("string")))
    last = F.last("word", True).over(Window.partitionBy(*keys, "range", "salt").orderBy("at", F.col("full").isNotNull()))
    return both.withColumn("word", last).where("full is not null").select("full", "word")


def _ranges(weights: DataFrame, digits: int, *keys: str) -> DataFrame:
    """``keys..., range, all, ranges``: for each hash prefix shorter by DIGITS the prefixes of ``digits`` digits in it, with the weight in front of them."""
    sums = weights.groupBy(*keys, F.substring("hash", 1, digits).alias("child")).agg(F.sum("w").alias("w"))
    sums = sums.withColumn("range", F.substring("child", 1, digits - DIGITS))
    upto = F.sum("w").over(Window.partitionBy(*keys, "range").orderBy("child").rowsBetween(Window.unboundedPreceding, 0))
    listed = F.sort_array(F.collect_list(F.struct("begin", F.col("child").alias("range"))))
    return sums.withColumn("begin", upto - F.col("w")).groupBy(*keys, "range").agg(F.sum("w").alias("all"), listed.alias("ranges"))


def sample_next(model: NgramModel, contexts: DataFrame, seed: int = 42) -> DataFrame:
    """``context, word``: a seeded draw from the full next-word distribution; ``<UNK>`` without candidates.

    The distribution is a mixture: with the interpolation weight the word comes from
    the continuation shares of the order, else from the discounted followers of the
    context. Every context draws its own side and its own word.
    """
    s = F.lit(str(seed))
    levels = materialize(context_levels(model, contexts), "levels")
    d = F.lit(model.discount)
    used = levels.select("n", "context").distinct()
    followers = model.counts.join(used, ["n", "context"]).where(F.col("cnt") > d).select("n", "context", "word", (F.col("cnt") - d).alias("w"))
    followers = materialize(followers, "followers")
    heavy = followers.select("n", "context").distinct().withColumn("heavy", F.lit(True))
    lam = d * F.col("followers") / F.col("total")
    sides = levels.join(heavy, ["n", "context"], "left").select(
        "full", "n", "context", _uniform(s, F.lit("word"), "full").alias("u"),
        ((_uniform(s, F.lit("side"), "full") < lam) | F.col("heavy").isNull()).alias("other"),
    )
    shares = model.words.select("n", "word", F.col("p_cont").alias("w"))
    drawn = _drawn(shares, sides.where("other").select("full", "n", "u"), "n").unionByName(
        _drawn(followers, sides.where("not other").select("full", "n", "context", "u"), "n", "context")
    )
    return contexts.select("context").distinct().join(drawn.withColumnRenamed("full", "context"), "context", "left").select(
        "context", F.coalesce("word", F.lit("<UNK>")).alias("word")
    )


def top_ngrams(counts: DataFrame, by: str, k: int = 5) -> DataFrame:
    """``by, n, ngram, cnt, rank``: the most frequent n-grams per class and order.

    Spark's group limit keeps k rows per class and task before the shuffle, so a class
    with most of the rows does not land in one task whole.
    """
    gram = F.trim(F.concat_ws(" ", "context", "word"))
    rank = F.row_number().over(Window.partitionBy(by, "n").orderBy(F.desc("cnt"), "ngram"))
    return counts.select(by, "n", gram.alias("ngram"), "cnt").withColumn("rank", rank).where(F.col("rank") <= k)
