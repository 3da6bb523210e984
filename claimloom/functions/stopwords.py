"""Stop-word lists. Small fixed vocabularies, compiled into the plan as a hashed set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The standard English stop-word list of the public NLTK corpus.
STANDARD = frozenset(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
    himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
    haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
    weren weren't won won't wouldn wouldn't
    """.split()
)

# Words that carry the claim and stay, and newsroom words that go.
KEPT = frozenset({"not", "no", "never", "completely", "actually", "false", "true"})
NEWSROOM = frozenset({"breaking", "update", "reported", "sources", "said", "according", "news"})

DOMAIN = (STANDARD - KEPT) | NEWSROOM

LISTS = {"none": frozenset(), "standard": STANDARD, "domain": DOMAIN}


def drop_stopwords(tokens: Column, which: str = "standard", counted: bool = False) -> Column:
    """Remove the words of a list, comparing in lower case; order and repeats stay. ``counted`` tokens come with their counts."""
    words = sorted(LISTS[which])
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~F.lower(t["term"] if counted else t).isin(words))


def stopword_table(spark: SparkSession, which: str) -> DataFrame:
    return spark.createDataFrame([(w,) for w in sorted(LISTS[which])], "word string")


def domain_table(standard: DataFrame, kept: DataFrame, added: DataFrame) -> DataFrame:
    """(standard minus kept) plus added, as set operations on one-column tables."""
    return standard.subtract(kept).union(added).distinct()
