import pytest
from pyspark.sql import functions as F

from claimloom.functions import clean, stopwords, tokens
from claimloom.functions.stem import porter, stem_tokens
from claimloom.operators import lexicon
from claimloom.plans.preprocess import (
    Preprocessing, analyzer_terms, fit_counts, fit_tokens, normalize_tokens, preprocess_requests, preprocess_tokens, split_counts,
)
from claimloom.session import materialize


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "text string").select(expr(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p>WOW!!!! see http://x.co/a @bob #tag</p>", "wow! see"),
        ("Yeh News hai??", "yeh news ?"),
        ("Café déjà", "caf dj"),
        ("a < b", "a < b"),
        ("<script>if (a<b) x()</script>Hey <b>you</b>", "hey you"),
        ("Fish &amp; chips &lt;now&gt; &#39;ok&#39; &eacute;", "fish & chips <now> 'ok'"),
        ("THEY KI theki kilo", "they theki kilo"),
        ("mail me@home.org  now\t!?!", "mail me now !?!"),
    ],
)
def test_clean(spark, text, expected):
    assert one(spark, text, clean.clean) == expected


def test_entities_decode_once(spark):
    assert one(spark, "&amp;lt; &#x1F600; &unknown; &copy;", clean.strip_html) == "&lt; \U0001f600 &unknown; ©"


def test_tokenizers(spark):
    assert one(spark, "it's ok.", tokens.regex_tokens) == ["it", "'", "s", "ok", "."]
    assert one(spark, "a bc d2", tokens.word_tokens) == ["bc", "d2"]
    assert one(spark, " a b  c ", tokens.whitespace_tokens) == ["a", "b", "c"]
    assert one(spark, None, tokens.word_tokens) == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Dr. Orlov's 'own' figures (p. 7) aren't theirs; I'd ask.", "Dr . Orlov 's 'own ' figures ( p . 7 ) are n't theirs ; I 'd ask ."),  # a full stop before a space ends a sentence
        ('"Rain?" asked Ana, "at 5 p.m.?"', "`` Rain ? '' asked Ana , `` at 5 p.m. ? ''"),
        ("cannot gonna wanna gimme", "can not gon na wan na gim me"),
        ('he said "hi there."', "he said `` hi there . ''"),
        ("a: b, 3,000 wait...", "a : b , 3,000 wait ..."),
        ("shouldn't've", "shouldn't 've"),
    ],
)
def test_treebank(spark, text, expected):
    assert one(spark, text, lambda c: tokens.join_tokens(tokens.treebank_tokens(c))) == expected


def test_stopwords_keep_order_case_and_repeats(spark):
    df = spark.createDataFrame([(["Not", "breaking", "the", "vaccine", "Not"],)], "t array<string>")
    assert df.select(stopwords.drop_stopwords(F.col("t"), "domain")).first()[0] == ["Not", "vaccine", "Not"]
    assert df.select(stopwords.drop_stopwords(F.col("t"), "standard")).first()[0] == ["breaking", "vaccine"]
    table = stopwords.domain_table(
        stopwords.stopword_table(spark, "standard"),
        spark.createDataFrame([(w,) for w in stopwords.KEPT], "word string"),
        spark.createDataFrame([(w,) for w in stopwords.NEWSROOM], "word string"),
    )
    assert {r[0] for r in table.collect()} == stopwords.DOMAIN


def test_porter_known_pairs():
    pairs = (
        "caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster motoring motor sing sing "
        "conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz "
        "failing fail filing file happy happi sky sky relational relat conditional condit rational ration digitizer digit "
        "operator oper feudalism feudal hopefulness hope callousness callous formaliti formal sensibiliti sensibl "
        "triplicate triplic formative form formalize formal electrical electr goodness good revival reviv allowance allow "
        "inference infer adjustable adjust irritant irrit replacement replac adoption adopt communism commun activate activ "
        "effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll dying die "
        "enjoy enjoy died die flies fli reporting report verified verifi news news geology geolog"
    ).split()
    for word, stem in zip(pairs[::2], pairs[1::2]):
        assert porter(word) == stem, word


def test_stem_tokens_keeps_shape(spark):
    df = spark.createDataFrame([(["Cats", "running"],), ([],), (["news"],)], "t array<string>")
    assert [r[0] for r in df.select(stem_tokens("t")).collect()] == [["cat", "run"], [], ["news"]]


def test_term_counts_and_ngrams(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "t array<string>")
    got = [[(x["term"], x["tf"]) for x in r[0]] for r in df.select(tokens.term_counts(F.col("t"))).collect()]
    assert got == [[("a", 1), ("b", 2)], []]
    grams = [[(x["context"], x["word"]) for x in r[0]] for r in df.select(tokens.ngrams(F.col("t"), 3)).collect()]
    assert grams[0] == [("<s> <s>", "b"), ("<s> b", "a"), ("b a", "b"), ("a b", "</s>")]
    assert grams[1] == [("<s> <s>", "</s>")]


def test_lemmas_need_a_known_word(spark):
    docs = spark.createDataFrame([(1, ["cats", "boxes", "women", "bus", "cats", "ladies"])], "id int, tokens array<string>")
    lex = spark.createDataFrame([(w,) for w in ("cat", "box", "woman", "lady")], "term string")
    out = lexicon.lemmatize(docs, "id", lexicon=lex).first()["tokens"]
    assert out == ["cat", "box", "woman", "bus", "cat", "lady"]
    vocab = spark.createDataFrame([(w,) for w in ("walked", "walk", "making", "make", "lies", "lie")], "term string")
    verbs = {r["term"]: r["lemma"] for r in lexicon.lemma_table(vocab, "verb").collect()}
    assert (verbs["walked"], verbs["making"], verbs["lies"]) == ("walk", "make", "lie")


def test_preprocess_variants(spark):
    docs = spark.createDataFrame([(1, "the cats and a cat were running"), (2, "")], "id int, cleaned_text string")
    run = lambda o: {r["id"]: r["tokens"] for r in preprocess_tokens(docs, "id", o).collect()}
    assert run(Preprocessing("standard"))[1] == ["cats", "cat", "running"]
    assert run(Preprocessing("standard", stem=True, lemma=True))[1] == ["cat", "cat", "run"]
    assert run(Preprocessing("standard", lemma=True, min_len=4))[1] == ["running"]
    assert run(Preprocessing())[2] == []
    out, words = fit_tokens(docs, "id", Preprocessing("standard", lemma=True))
    assert {r["id"]: r["tokens"] for r in out.collect()}[1] == ["cat", "cat", "running"]
    assert {r[0] for r in words.collect()} == {"cats", "cat", "running"}


def test_treebank_rules_are_skipped_only_where_they_find_nothing(spark, monkeypatch):
    assert set(tokens.TREEBANK_MARKS) < {p for p, _ in tokens.TREEBANK}
    texts = [
        "Don't CANNOT cannot d'ye D'YE gimme LEMME gonna wanna Gotta more'n MORE'N 'tis a 'TWAS b 'tis c", "we'll they've I'd it's CAN'T N'T can't. rock 'n' roll",
        "\"Hello,\" she said. ``q'' ''z ... -- \u00aba\u00bb \u201cb\u201d \u2018c\u2019 \u201ed\u201d `e` (\"x\" ['' y", "isn't\ncan't\t DON'T ", "plain words, no marks", "", None,
    ]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    out = lambda: [list(r[0]) for r in docs.select(tokens.treebank_tokens(F.col("text"))).collect()]
    guarded = out()
    monkeypatch.setattr(tokens, "TREEBANK_MARKS", {})
    assert out() == guarded


def test_counted_tokens_give_the_same_terms(spark):
    texts = [
        "don't state-running cats' cats-cat x a.b.cc boxes box 3,000 $5.50 foo/bar_baz women woman cannot", "", None, "the a . !!",
        "\u03b1\u03b2\u03b3-\u00e9t\u00e9s 12\u00b2 the-news news cats dogs dog dog", "running runs run ran women's",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, cleaned_text string")
    split = materialize(split_counts(docs), "test-split")
    ways = [Preprocessing(), Preprocessing("standard"), Preprocessing("domain", stem=True, min_len=3), Preprocessing("standard", lemma=True, min_len=4)]
    for way in ways:
        counted = fit_counts(split, "id", way)
        counted = counted.withColumn("tokens", tokens.drop_short(F.col("tokens"), way.min_len, counted=True))
        got = {r["id"]: r["terms"] for r in analyzer_terms(counted).collect()}
        plain = analyzer_terms(fit_tokens(docs, "id", way)[0])
        assert got == {r["id"]: r["t"] for r in plain.select("id", tokens.term_counts(F.col("terms")).alias("t")).collect()}
    again = analyzer_terms(split).select("id", tokens.repeated_terms(F.col("terms")).alias("t")).collect()
    plain = analyzer_terms(fit_tokens(docs, "id", Preprocessing())[0]).select("id", F.sort_array("terms").alias("t")).collect()
    assert {r["id"]: r["t"] for r in again} == {r["id"]: r["t"] for r in plain}


def test_normalize_and_request_flags(spark):
    docs = spark.createDataFrame([(1, ["Breaking", "not", "cats", "cat"])], "id int, tokens array<string>")
    assert normalize_tokens(docs, "id", "tokens").first()["tokens"] == ["not", "cat", "cat"]
    assert normalize_tokens(docs, "id", "tokens", "stem").first()["tokens"] == ["not", "cat", "cat"]
    rows = [
        (1, "This is a REALLY bad FAKE news tweet! http://fake.com", True, True, False, 3),
        (2, "the cats cat", False, False, True, 0),
        (3, "the cats", False, False, False, 0),
    ]
    requests = spark.createDataFrame(rows, "id int, text string, remove_stopwords boolean, stem boolean, lemma boolean, min_len int")
    out = {r["id"]: r["tokens"] for r in preprocess_requests(requests, "id").collect()}
    assert out[1] == ["realli", "bad", "fake", "news", "tweet"]
    assert out[2] == ["cat", "cat"]  # "the" is also a noise word of the cleaner
    assert out[3] == ["cats"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("&#9999999;", "\ufffd"), ("&#xD800;", "\ufffd"), ("a&#0;b", "a\ufffdb"), ("&#128;", "\u20ac"), ("&#65;&#x42;&#67", "ABC"),
        ("<?xml version='1'?>hello", "hello"), ("x<script>var a=1;", "x"), ("x <style>p{}", "x "), ("<!-- x > y", ""),
        ("<a title='x>y'>z</a>", "z"), ("<a href='x>open", "open"), ("&excl; &lpar;", "! ("), ("&amp x", "& x"), ("&amp;lt;", "&lt;"),
        ("a & b &unknown; &x", "a & b &unknown; &x"), ("&copy2", "&copy2"), ("a < b > c", "a < b > c"),
    ],
)
def test_markup_and_references(spark, html, expected):
    assert one(spark, html, clean.strip_html) == expected


def test_stems_in_sql():
    """The suffix rules as SQL give what the rules give, on words made of many endings."""
    import itertools

    import duckdb

    from claimloom.functions.stem import IRREGULAR, STEP2, STEP3, STEP4, porter
    from claimloom.plans.oracle import stems

    ends = ["", "s", "es", "ies", "sses", "ed", "eed", "ied", "ing", "y", "e", "ll", "lly", "alli", "ss", "ion", "tion", *(s for s, _ in (*STEP2, *STEP3)), *STEP4]
    heads = ["", "a", "tr", "hop", "hopp", "fizz", "by", "ya", "syzyg", "toy", "rel", "commun", "at", "troubl", "agre", "controll", "x", "ow", "bl", "siz"]
    words = sorted({a + b for a, b in itertools.product(heads, ends)} | {a + b + c for a, b, c in itertools.product(heads[:9], ends[:16], ("s", "ed", "ing", "ness"))} | set(IRREGULAR) | {"!", "...", "10th", "Caresses"} - {""})
    con = duckdb.connect()
    con.execute("CREATE TABLE v(term VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?)", [[w] for w in words if w])
    assert dict(con.execute(f"WITH {stems('v', 'st')} SELECT term, stem FROM st").fetchall()) == {w: porter(w) for w in words if w}
