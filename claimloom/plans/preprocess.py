"""The preprocessing chain of training and serving: split, stop words, stem or lemma, minimum length."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import stopwords, tokens
from claimloom.functions.clean import clean
from claimloom.functions.stem import stem_counts, stem_tokens
from claimloom.operators import lexicon
from claimloom.session import materialize


@dataclass(frozen=True)
class Preprocessing:
    """Options of the chain. Stemming wins over lemmas when both are asked for."""

    stopwords: str = "none"
    stem: bool = False
    lemma: bool = False
    min_len: int = 0

    def params(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}


# What the service uses for every request.
SERVING = Preprocessing(stopwords="standard", lemma=True)


def clean_texts(docs: DataFrame, text: str = "text", output: str = "cleaned_text") -> DataFrame:
    return docs.withColumn(output, clean(F.col(text)))


def split_tokens(docs: DataFrame, options: Preprocessing, text: str = "cleaned_text", output: str = "tokens") -> DataFrame:
    """The narrow part of the chain: Treebank tokens without stop words, stemmed if asked for."""
    split = tokens.treebank_tokens(F.lower(F.col(text)))
    out = docs.withColumn(output, stopwords.drop_stopwords(split, options.stopwords))
    return out.withColumn(output, stem_tokens(output)) if options.stem else out


def preprocess_tokens(
    docs: DataFrame,
    key: str,
    options: Preprocessing,
    text: str = "cleaned_text",
    output: str = "tokens",
    lexicon_table: DataFrame | None = None,
) -> DataFrame:
    """Add the processed token array of ``text``.

    Narrow, except for lemmas: those look words up in a lexicon (by default the
    vocabulary of ``docs``), so the split tokens are stored first and the costly
    splitting runs once.
    """
    out = split_tokens(docs, options, text, output)
    if options.lemma and not options.stem:
        out = lexicon.lemmatize(materialize(out, "tokens"), key, output, "noun", lexicon_table)
    return out.withColumn(output, tokens.drop_short(F.col(output), options.min_len))


def fit_tokens(
    docs: DataFrame, key: str, options: Preprocessing, text: str = "cleaned_text", output: str = "tokens"
) -> tuple[DataFrame, DataFrame | None]:
    """As ``preprocess_tokens``, and the stored lexicon later texts are to be processed with (None without lemmas)."""
    if options.stem or not options.lemma:
        return preprocess_tokens(docs, key, options, text, output), None
    split = materialize(split_tokens(docs, options, text, output), "tokens")
    words = materialize(lexicon.vocabulary(split, output), "lexicon")
    out = lexicon.lemmatize(split, key, output, "noun", words, terms=words)
    return out.withColumn(output, tokens.drop_short(F.col(output), options.min_len)), words


def split_counts(docs: DataFrame, text: str = "cleaned_text", output: str = "tokens") -> DataFrame:
    """The Treebank tokens of ``text``, counted.

    Stop words, stems, lemmas, minimum length and words depend on a token alone, so a table that is processed in several
    ways is split once, and each way goes over the distinct tokens of a document.
    """
    return docs.withColumn(output, tokens.term_counts(tokens.treebank_tokens(F.lower(F.col(text)))))


def fit_counts(split: DataFrame, key: str, options: Preprocessing, output: str = "tokens") -> DataFrame:
    """``fit_tokens`` on stored ``split_counts``, still without the minimum length."""
    out = split.withColumn(output, stopwords.drop_stopwords(F.col(output), options.stopwords, counted=True))
    if options.stem:
        return out.withColumn(output, stem_counts(output))
    if options.lemma:
        words = materialize(lexicon.vocabulary(out, output), "lexicon")
        return lexicon.lemmatize(out, key, output, "noun", words, terms=words)
    return out


def analyzer_terms(docs: DataFrame, processed: str = "tokens", output: str = "terms") -> DataFrame:
    """Terms a vectorizer sees: the processed tokens joined by blanks and split again into words. Counts stay counts."""
    if tokens.are_counted(docs, processed):
        return docs.withColumn(output, tokens.word_counts(F.col(processed)))
    return docs.withColumn(output, tokens.word_tokens(tokens.join_tokens(F.col(processed))))


def normalize_tokens(docs: DataFrame, key: str, tokens_col: str, method: str = "lemma") -> DataFrame:
    """Domain stop words, then stems, or noun lemmas for any other method."""
    out = docs.withColumn(tokens_col, stopwords.drop_stopwords(F.col(tokens_col), "domain"))
    if method == "stem":
        return out.withColumn(tokens_col, stem_tokens(tokens_col))
    return lexicon.lemmatize(materialize(out, "tokens"), key, tokens_col)


def preprocess_requests(requests: DataFrame, key: str, lexicon_table: DataFrame | None = None) -> DataFrame:
    """Requests with their own flags (``remove_stopwords, stem, lemma, min_len``) to token lists.

    Flags are data here, so every variant is a column expression chosen per row.
    """
    split = tokens.treebank_tokens(clean(F.col("text")))
    kept = F.when(F.col("remove_stopwords"), stopwords.drop_stopwords(F.col("_split"), "standard"))
    out = requests.withColumn("_split", split).withColumn("_kept", kept.otherwise(F.col("_split")))
    out = materialize(out.drop("_split"), "requests")
    lemmas = out.withColumn("_open", F.when(F.col("lemma") & ~F.col("stem"), F.col("_kept")).otherwise(F.array()))
    lemmas = lexicon.lemmatize(lemmas, key, "_open", lexicon=lexicon_table)
    chosen = (
        F.when(F.col("stem"), stem_tokens("_kept")).when(F.col("lemma"), F.col("_open")).otherwise(F.col("_kept"))
    )
    return lemmas.select(
        key,
        F.col("text").alias("original"),
        F.filter(chosen, lambda t: (F.col("min_len") <= 0) | (F.length(t) >= F.col("min_len"))).alias("tokens"),
    )
