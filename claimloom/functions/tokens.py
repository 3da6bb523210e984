"""Tokenizers and token-array functions (narrow: one input row gives one output row)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from claimloom.functions.clean import SPACE, let, replace_if

WORD = r"[\p{L}\p{N}_]{2,}"
WORD_OR_MARK = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE}]"

# The published Treebank word-splitting rules, in order. Each pattern starts with the mark it splits off
# and looks back from there, so that text without the mark is skipped over. A full stop before white space or the end
# closes a sentence and is split off. The look-ahead of the single-letter quote rule is written as a letter class.
TREEBANK = (
    (r"[«“‘„]", " $0 "),
    (r"`+", " $0 "),
    (r'^"', "``"),
    (r"``", " $0 "),
    (r'"(?<=[ (\[{<]")', " `` "),
    (r"''(?<=[ (\[{<]'')", " `` "),
    (r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b", "' $1"),
    (r"""\.(?<=[^.]\.)([\])}>"'»”’]*)(?=\s|$)""", " . $1 "),
    (r"[:,](?!\d)", " $0 "),
    (r"\.{2,}", " $0 "),
    (r"--", " -- "),
    (r"[;@#$%&?!*\]\[(){}<>»”’]", " $0 "),
    (r"$", " "),
    (r"''", " '' "),
    (r'"', " '' "),
    (r"\s{2,}|[\t-\r]", " "),
    (r"(?:n't|N'T)(?<=[^' ]...) ", " $0"),
    (r"'(?<=[^' ]')([sSmMdD]|ll|LL|re|RE|ve|VE)? ", " '$1 "),
    (r"(?i)not\b(?<=\bcannot)", " $0 "),
    (r"(?i)'ye\b(?<=\bd'ye)", " $0 "),
    (r"(?i)me\b(?<=\b(?:gim|lem)me)", " $0 "),
    (r"(?i)na\b(?<=\b(?:gon|wan)na)", " $0 "),
    (r"(?i)ta\b(?<=\bgotta)", " $0 "),
    (r"(?i)'n\b(?<=\bmore'n)", " $0 "),
    (r"(?i) 't(?=(?:is|was)\b)", "$0 "),
)

# What a text must hold for a rule to find anything, compared in lower case; looking for it is far cheaper than the rule.
# Rules that aren't here find something in most texts.
TREEBANK_MARKS = {
    r"[«“‘„]": ("«", "“", "‘", "„"),
    r"`+": ("`",),
    r'^"': ('"',),
    r"``": ("``",),
    r'"(?<=[ (\[{<]")': ('"',),
    r"''(?<=[ (\[{<]'')": ("''",),
    r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b": ("'",),
    r"\.{2,}": ("..",),
    r"--": ("--",),
    r"''": ("''",),
    r'"': ('"',),
    r"(?:n't|N'T)(?<=[^' ]...) ": ("n't ",),
    r"'(?<=[^' ]')([sSmMdD]|ll|LL|re|RE|ve|VE)? ": ("'",),
    r"(?i)not\b(?<=\bcannot)": ("cannot",),
    r"(?i)'ye\b(?<=\bd'ye)": ("d'ye",),
    r"(?i)me\b(?<=\b(?:gim|lem)me)": ("gimme", "lemme"),
    r"(?i)na\b(?<=\b(?:gon|wan)na)": ("gonna", "wanna"),
    r"(?i)ta\b(?<=\bgotta)": ("gotta",),
    r"(?i)'n\b(?<=\bmore'n)": ("more'n",),
    r"(?i) 't(?=(?:is|was)\b)": (" 't",),
}


def regex_tokens(text: Column) -> Column:
    """Words, and each punctuation mark on its own."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_OR_MARK), F.lit(0))


def word_tokens(text: Column) -> Column:
    """Lower-case words of two or more letters: the analyzer behind every term matrix."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"[{SPACE}]+"), lambda t: t != "")


def treebank_tokens(text: Column) -> Column:
    value = F.coalesce(text, F.lit(""))
    for pattern, replacement in TREEBANK:
        if pattern == "$":
            value = F.concat(value, F.lit(" "))
        elif pattern in TREEBANK_MARKS:
            value = replace_if(value, TREEBANK_MARKS[pattern], pattern, replacement, any_case=any(m.lower() != m.upper() for m in TREEBANK_MARKS[pattern]))
        else:
            value = F.regexp_replace(value, pattern, replacement)
    return whitespace_tokens(value)


def are_counted(docs: DataFrame, tokens: str) -> bool:
    """Whether a column holds counts (see ``term_counts``) in place of tokens."""
    return isinstance(docs.schema[tokens].dataType.elementType, StructType)


def drop_short(tokens: Column, min_len: int, counted: bool = False) -> Column:
    if min_len <= 0:
        return tokens
    return F.filter(tokens, lambda t: F.length(t["term"] if counted else t) >= min_len)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


@F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))
def _counted(tokens: pa.Array) -> pa.Array:
    flat = tokens.flatten()
    row = _rows(tokens)
    if flat.null_count:
        row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    encoded = flat.dictionary_encode()  # each distinct token of a batch is compared once, as bytes
    order, place = _alphabetical(encoded.dictionary)
    found, times = np.unique(row * len(place) + place[encoded.indices.to_numpy()], return_counts=True)
    return _count_lists(found, times, encoded.dictionary, order, len(tokens))


def _rows(lists: pa.Array) -> np.ndarray:
    """The row that each element of the flattened lists is of."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())


def _alphabetical(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The order of distinct words, and the place of each in it."""
    order = pc.sort_indices(words)
    place = np.empty(len(words), np.int64)
    place[order.to_numpy()] = np.arange(len(words))
    return order, place


def _count_lists(found: np.ndarray, times: np.ndarray, words: pa.Array, order: pa.Array, n_rows: int) -> pa.Array:
    """Counts per row from ascending ``row * len(words) + place`` and how often each was found."""
    row, place = np.divmod(found, max(1, len(words)))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_rows))]).astype(np.int32)
    terms = words.take(order.take(pa.array(place)))
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([terms, pa.array(times)], ["term", "tf"]))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one document, sorted by term.

    Counting inside the row means a document's terms are already pre-aggregated before
    anything is exploded or shuffled. It is done in Arrow, a batch of documents at a time.
    """
    return _counted(tokens)


@F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))
def _word_counted(counts: pa.Array) -> pa.Array:
    flat = counts.flatten()
    encoded = flat.field("term").dictionary_encode()
    # each distinct token of a batch is cut into words once
    cut = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(encoded.dictionary), r"[^\p{L}\p{N}_]+", " "), " ")
    token, words = _rows(cut), cut.flatten()
    long = pc.greater_equal(pc.utf8_length(words), 2)
    token, words = token[long.to_numpy(zero_copy_only=False)], words.filter(long).dictionary_encode()
    n_words = np.bincount(token, minlength=len(cut))
    begins = np.cumsum(n_words) - n_words
    # an occurrence of a token is one of each of its words
    index = encoded.indices.to_numpy()
    times = n_words[index]
    of = np.repeat(np.arange(len(index)), times)
    word = words.indices.to_numpy()[begins[index][of] + np.arange(len(of)) - (np.cumsum(times) - times)[of]]
    order, place = _alphabetical(words.dictionary)
    at = _rows(counts)[of] * len(place) + place[word]
    by = np.argsort(at)
    at, tf = at[by], flat.field("tf").to_numpy()[of][by]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    summed = np.add.reduceat(tf, first) if len(first) else tf
    return _count_lists(at[first], summed, words.dictionary, order, len(counts))


def word_counts(counts: Column) -> Column:
    """Counts of ``word_tokens`` over tokens that are counted: the words of each token, as often as the token occurs."""
    return _word_counted(counts)


@F.arrow_udf(ArrayType(StringType()))
def _repeated(counts: pa.Array) -> pa.Array:
    flat = counts.flatten()
    tf = flat.field("tf").to_numpy()
    ends = np.concatenate([[0], np.cumsum(np.bincount(_rows(counts), tf, len(counts)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), flat.field("term").take(pa.array(np.repeat(np.arange(len(tf)), tf))))


def repeated_terms(counts: Column) -> Column:
    """Counts as terms again, each as often as it was counted, in order of the terms."""
    return _repeated(counts)


def ngrams(tokens: Column, n: int, pad: bool = True) -> Column:
    """``array<struct<n, context, word>>``; the context is the n-1 previous tokens joined by a blank.

    No tokenizer here yields a token with a blank in it, so the joined context is unambiguous.
    With padding there are n-1 ``<s>`` in front and one ``</s>`` at the end.
    """
    if pad:
        tokens = F.concat(F.array_repeat(F.lit("<s>"), n - 1), tokens, F.array(F.lit("</s>")))

    def grams(t):
        return F.transform(
            F.sequence(F.lit(1), F.size(t) - n + 1),
            lambda i: F.struct(
                F.lit(n).alias("n"),
                (F.concat_ws(" ", *[F.get(t, i + (j - 1)) for j in range(n - 1)]) if n > 1 else F.lit("")).alias("context"),
                F.get(t, i + (n - 2)).alias("word"),
            ),
        )

    empty = F.array().cast("array<struct<n:int,context:string,word:string>>")
    return let(tokens, lambda t: F.when(F.size(t) >= n, grams(t)).otherwise(empty))
