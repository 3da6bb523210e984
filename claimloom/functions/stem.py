"""Porter stemming of token arrays.

The rules run once per distinct token of an Arrow batch (dictionary encoding), so
the work per token stays inside Arrow and no token is ever shuffled.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# Suffix -> replacement of the published algorithm, tried in order; the first suffix that fits decides.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)
# Irregular forms that skip the rules.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
    "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_SYLLABLE = re.compile("v+c+")


def _shape(word: str) -> str:
    """Each letter as ``v`` or ``c``; a ``y`` is a vowel only after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return len(_SYLLABLE.findall(_shape(word)))


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        base = word.removesuffix(suffix)
        if base != word and "v" in _shape(base):
            if base.endswith(("at", "bl", "iz")):
                return base + "e"
            if base[-2:-1] == base[-1:] and _shape(base)[-1] == "c":
                return base if base[-1] in "lsz" else base[:-1]
            return base + "e" if _measure(base) == 1 and _short_end(base) else base
    return word


def _swap(word: str, rules) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            # "logi" counts its own "l" as part of the base
            return base + replacement if _measure(base + ("l" if suffix == "logi" else "")) > 0 else word
    return word


def _cut(word: str) -> str:
    for suffix in STEP4:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            return base if _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t")) else word
    return word


@lru_cache(maxsize=200_000)
def porter(token: str) -> str:
    word = token.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    word = _cut(_swap(_swap(word, STEP2), STEP3))
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def _stem_flat(flat: pa.Array) -> pa.Array:
    encoded = flat.dictionary_encode()
    stems = pa.array([porter(t) for t in encoded.dictionary.to_pylist()], pa.string())
    return stems.take(encoded.indices)


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem every token of an array column."""
    return pa.ListArray.from_arrays(_offsets(tokens), _stem_flat(tokens.flatten()))


@F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))
def stem_counts(counts: pa.Array) -> pa.Array:
    """Stem counted tokens; those that have one stem stay apart."""
    flat = counts.flatten()
    stems = pa.StructArray.from_arrays([_stem_flat(flat.field("term")), flat.field("tf")], ["term", "tf"])
    return pa.ListArray.from_arrays(_offsets(counts), stems)


@F.arrow_udf(StringType())
def stem_term(terms: pa.Array) -> pa.Array:
    """Stem a term column (used on a table of distinct terms)."""
    return _stem_flat(terms)


def _offsets(lists: pa.Array) -> pa.Array:
    lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0)
    ends = pa.compute.cumulative_sum(lengths.cast(pa.int32()))
    return pa.concat_arrays([pa.array([0], pa.int32()), ends])
