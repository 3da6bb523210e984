"""Lemmas by suffix detachment against a lexicon table, and stem/lemma comparisons.

The lexicon is the vocabulary of the corpus itself (or any table with a ``term``
column), so a lemma is always a word that exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.stem import stem_term
from claimloom.functions.tokens import are_counted
from claimloom.operators.keyed import lookup
from claimloom.session import materialize

# Published suffix detachments per part of speech.
DETACH = {
    "noun": (
        ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
        ("men", "man"), ("ies", "y"),
    ),
    "verb": (
        ("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ),
}


def suffix_pattern(pos: str) -> str:
    return f"({'|'.join(sorted({suffix for suffix, _ in DETACH[pos]}))})$"


def vocabulary(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct terms; duplicates within a document and within a task collapse before the shuffle. ``tokens`` may be counted."""
    words = F.col(f"{tokens}.term") if are_counted(docs, tokens) else F.array_distinct(F.col(tokens))
    return docs.select(F.explode(words).alias("term")).distinct()


def candidates(term: Column, pos: str) -> Column:
    """The base forms the detachment rules allow for a term (nulls where a rule does not fit)."""
    forms = [
        F.when(
            term.endswith(suffix) & (F.length(term) > len(suffix)),
            F.concat(F.substring(term, F.lit(1), F.length(term) - len(suffix)), F.lit(base)),
        )
        for suffix, base in DETACH[pos]
    ]
    return F.array_compact(F.array(*forms))


def changed_lemmas(
    terms: DataFrame, lexicon: DataFrame | None = None, pos: str = "noun", exceptions: DataFrame | None = None
) -> DataFrame:
    """``term, lemma`` for the terms whose lemma differs from the term.

    Only terms with a matching suffix take part; each candidate is checked with one
    equi-join on the lexicon, and the shortest accepted form wins (then the smallest).
    """
    lexicon = terms if lexicon is None else lexicon
    forms = (
        terms.where(F.col("term").rlike(suffix_pattern(pos)))
        .select("term", F.explode(candidates(F.col("term"), pos)).alias("lemma"))
        .join(lexicon.select(F.col("term").alias("lemma")), "lemma", "left_semi")
    )
    if exceptions is not None:
        forms = forms.unionByName(exceptions.select("term", "lemma"))
    best = forms.groupBy("term").agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma"))["lemma"].alias("lemma"))
    return best.where(F.length("lemma") <= F.length("term"))


def lemma_table(vocab: DataFrame, pos: str = "noun", exceptions: DataFrame | None = None) -> DataFrame:
    """``term, lemma`` for every term of the vocabulary, which is read three times and should be stored."""
    return vocab.join(changed_lemmas(vocab, None, pos, exceptions), "term", "left").select(
        "term", F.coalesce("lemma", "term").alias("lemma")
    )


def lemmatize(
    docs: DataFrame,
    key: str,
    tokens: str = "tokens",
    pos: str = "noun",
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    terms: DataFrame | None = None,
) -> DataFrame:
    """Replace tokens by their lemmas, keeping order and repeats.

    ``docs`` is read three times, so it should be a stored table. ``terms`` is its
    vocabulary where the caller has it; ``lexicon`` holds the words a lemma may be.

    Only the distinct tokens of a document that a rule could change travel to the
    lemma table; what comes back per document is a map of the few changed words.
    Counted tokens stay counted; those that have one lemma stay apart.
    """
    counted = are_counted(docs, tokens)
    terms = materialize(vocabulary(docs, tokens), "lemma-terms") if terms is None else terms
    changes = changed_lemmas(terms, lexicon, pos, exceptions)
    may_change = suffix_pattern(pos)
    token = F.col(tokens)
    open_tokens = F.array_distinct(F.col(f"{tokens}.term") if counted else token)
    if exceptions is None:
        open_tokens = F.filter(open_tokens, lambda t: t.rlike(may_change))
    changes = materialize(changes, "lemmas")
    per_doc = (
        lookup(docs.select(key, F.explode(open_tokens).alias("term")), changes, "term", [key])
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_set(F.struct("term", "lemma"))).alias("_lemmas"))  # rows may share a key
    )
    lemma = lambda t: F.coalesce(F.try_element_at(F.col("_lemmas"), t), t)
    replaced = F.transform(token, lambda t: F.struct(lemma(t["term"]).alias("term"), t["tf"].alias("tf")) if counted else lemma(t))
    return (
        docs.join(per_doc, key, "left")
        .withColumn(tokens, F.when(F.col("_lemmas").isNull(), token).otherwise(replaced))
        .drop("_lemmas")
    )


def stem_table(vocab: DataFrame) -> DataFrame:
    return vocab.select("term", stem_term("term").alias("stem"))


def stem_vs_lemma(vocab: DataFrame) -> DataFrame:
    """Stem and verb lemma of every term, side by side."""
    return stem_table(vocab).join(lemma_table(vocab, "verb"), "term")


def vocabulary_reduction(comparison: DataFrame) -> DataFrame:
    """How far stems and lemmas shrink a vocabulary."""
    return comparison.agg(
        F.count("*").alias("terms"),
        F.countDistinct("stem").alias("stems"),
        F.countDistinct("lemma").alias("lemmas"),
    )
