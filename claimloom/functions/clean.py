"""Claim cleaning as a chain of column expressions, all inside one projection."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roman Urdu noise words, removed as whole words in any case.
ROMAN_URDU_NOISE = (
    "hain", "hai", "mein", "ki", "ka", "ke", "ko", "aur", "is", "se", "bhi", "tha", "thi", "the", "hi",
    "jo", "kya", "kyun", "magar", "ho", "par", "shyad", "lekin",
)

# Unicode white space, written so that every regex dialect agrees on it.
SPACE = r"\p{Z}\t-\r\x1c-\x1f\x85"
# Runs of ASCII white space other than one blank, which stays as it is.
ASCII_SPACE = r"[\t-\r\x1c-\x1f][\t-\r\x1c-\x20]*| [\t-\r\x1c-\x20]+"

URL = rf"http[^{SPACE}]+|www[^{SPACE}]+"
HANDLE = rf"[@#][^{SPACE}]+"

# The inside of a tag: a quoted value may hold the closing sign.
INSIDE = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
# Markup that holds no text, in the order it is removed. Scripts and styles without an end reach to the end of the text.
MARKUP = (
    rf"(?is)<script\b{INSIDE}>.*?(?:</script\s*>|\z)",
    rf"(?is)<style\b{INSIDE}>.*?(?:</style\s*>|\z)",
    r"(?s)<!--.*?(?:-->|\z)",
    r"<\?[^>]*>",
    r"<![^>]*>",
    rf"</?[A-Za-z]{INSIDE}>",
    r"</?[A-Za-z][^>]*>",
)
ENTITY = r"&(#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,30};|(?:LEGACY)(?![A-Za-z0-9;=]))"
# Named references that are read without a semicolon as well.
LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
ENTITY = ENTITY.replace("LEGACY", "|".join(LEGACY))
# What the numbers 128 to 159 stand for, from windows-1252; 0 where it has nothing.
WINDOWS = (
    8364, 0, 8218, 402, 8222, 8230, 8224, 8225, 710, 8240, 352, 8249, 338, 0, 381, 0,
    0, 8216, 8217, 8220, 8221, 8226, 8211, 8212, 732, 8482, 353, 8250, 339, 0, 382, 376,
)


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` evaluates it once."""
    return F.transform(F.array(value), body)[0]


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number; what is no character (0, surrogates, too large) becomes U+FFFD, as HTML defines."""
    number = F.conv(F.replace(digits, F.lit(";"), F.lit("")), base, 10).cast("int")
    windows = F.element_at(F.array(*map(F.lit, WINDOWS)), F.greatest(F.lit(1), F.least(F.lit(32), number - 127)))
    mapped = F.when(number.between(128, 159) & (windows > 0), windows).otherwise(number)
    bad = mapped.isNull() | (mapped == 0) | mapped.between(0xD800, 0xDFFF) | (mapped > 0x10FFFF)
    safe = F.when(bad, F.lit(0xFFFD)).otherwise(mapped)
    return F.decode(F.unhex(F.lpad(F.hex(safe.cast("long")), 8, "0")), "UTF-32")


def _entity_text(name: Column) -> Column:
    # two literal strings fold into one constant map; no name and no character holds the separator
    # the map is searched from its start, so the older and usual names come first
    known = sorted(html5.items(), key=lambda item: item[0].rstrip(";") not in name2codepoint)
    named = F.map_from_arrays(
        F.split(F.lit("\x1f".join(n for n, _ in known)), "\x1f"), F.split(F.lit("\x1f".join(c for _, c in known)), "\x1f")
    )
    return (
        F.when(name.rlike("^#[xX]"), _code_point(F.substring(name, 3, 7), 16))
        .when(name.startswith("#"), _code_point(F.substring(name, 2, 8), 10))
        .otherwise(F.coalesce(F.try_element_at(named, name), F.concat(F.lit("&"), name)))
    )


def decode_entities(text: Column) -> Column:
    """Decode named and numeric character references in one pass, so nothing is decoded twice."""
    pieces = F.split(text, ENTITY, -1)
    names = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1))
    decoded = F.array_join(
        F.zip_with(pieces, names, lambda p, n: F.when(n.isNull(), p).otherwise(F.concat(p, _entity_text(n)))), ""
    )
    return F.when(text.contains("&"), decoded).otherwise(text)


def strip_html(text: Column) -> Column:
    """Text of an HTML fragment; pieces are joined without a separator."""
    bare = text
    for pattern in MARKUP:
        bare = F.regexp_replace(bare, pattern, "")
    bare = F.when(text.contains("<"), bare).otherwise(text)
    return F.when(text.contains("&"), let(bare, decode_entities)).otherwise(bare)


def replace_if(text: Column, marks: Sequence[str], pattern: str, replacement: str, any_case: bool = False) -> Column:
    """``regexp_replace`` of texts that hold one of ``marks``, without which the pattern finds nothing; looking for them is far cheaper.

    With ``any_case`` the marks, in lower case, are looked for in the text in lower case.
    """

    def replaced(t: Column) -> Column:
        searched = F.lower(t) if any_case else t
        holds = searched.contains(marks[0])
        for mark in marks[1:]:
            holds = holds | searched.contains(mark)
        return F.when(holds, F.regexp_replace(t, pattern, replacement)).otherwise(t)

    return let(text, replaced)


def strip_urls(text: Column) -> Column:
    return replace_if(text, ("http", "www"), URL, "")


def strip_handles(text: Column) -> Column:
    return replace_if(text, ("@", "#"), HANDLE, "")


def _any_case(letter: str) -> str:
    """One letter in either case, with the few further letters that fold to it."""
    folded = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}.get(letter, "")
    return f"[{letter}{letter.upper()}{folded}]"


def _shared_prefixes(words: Sequence[str]) -> str:
    """An alternation that tests each common prefix once."""
    tails: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        tails.setdefault(word[:1], []).append(word[1:])
    ends = tails.pop("", None)
    options = "|".join(_any_case(first) + _shared_prefixes(rest) for first, rest in tails.items())
    if not options:
        return ""
    return f"(?:{options})?" if ends else f"(?:{options})"


def strip_words(text: Column, words: Sequence[str] = ROMAN_URDU_NOISE) -> Column:
    """Remove whole words in any case. A look at the first letter comes before the costly word-boundary test."""
    if not words:
        return text
    gate = "".join(_any_case(first)[1:-1] for first in sorted({w[0] for w in words}))
    return F.regexp_replace(text, rf"(?U)(?=[{gate}])\b{_shared_prefixes(words)}\b", "")


def collapse_repeats(text: Column) -> Column:
    return replace_if(text, ("..", "!!", "??"), r"([!?.])\1+", "$1")


def ascii_only(text: Column) -> Column:
    bare = lambda t: F.when(F.octet_length(t) > F.char_length(t), F.regexp_replace(t, r"[^\x00-\x7F]+", "")).otherwise(t)
    return let(text, bare)


def tidy(text: Column) -> Column:
    """Lower-case and squeeze white space of an ASCII text."""
    return F.trim(F.regexp_replace(F.lower(text), ASCII_SPACE, " "))


def blank_to_empty(text: Column) -> Column:
    value = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(value.rlike(rf"^[{SPACE}]*$"), F.lit("")).otherwise(value)


def clean(text: Column, noise_words: Sequence[str] = ROMAN_URDU_NOISE) -> Column:
    """The whole cleaning chain. A null or blank text gives the empty string."""
    value = strip_html(F.coalesce(text.cast("string"), F.lit("")))
    value = strip_handles(strip_urls(value))
    value = strip_words(value, noise_words)
    return tidy(ascii_only(collapse_repeats(value)))


def preview(text: Column, width: int = 50) -> Column:
    """First characters of a text; the dots are added even when nothing was cut."""
    return F.concat(F.substring(text, 1, width), F.lit("..."))
