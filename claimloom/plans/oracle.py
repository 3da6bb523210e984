"""The same answers in plain SQL, one self-contained statement per query, for checking against another engine."""

from __future__ import annotations

from claimloom.functions.clean import HANDLE, MARKUP, ROMAN_URDU_NOISE, URL
from claimloom.functions.stem import IRREGULAR, STEP2, STEP3, STEP4
from claimloom.functions.stopwords import LISTS
from claimloom.functions.tokens import WORD, WORD_OR_MARK
from claimloom.operators.lexicon import DETACH
from claimloom.operators.naive_bayes import ALPHAS

ORACLE: dict[str, str] = {}

# The Treebank rules in their published, consuming form (the other engine has no look-around).
TREEBANK = (
    (r"[«“‘„]|`+", " $0 "),
    (r'^"', "``"),
    (r"``", " $0 "),
    (r"""([ (\[{<])("|'')""", "$1 `` "),
    (r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b", "' $1"),
    (r"""([^.])(\.)([\])}>"'»”’]*)(\s|$)""", "$1 $2 $3 $4"),
    (r"([:,])([^\d])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"\.{2,}|--|[;@#$%&?!*\]\[(){}<>»”’]", " $0 "),
    (r"^|$", " "),
    (r"""''|\"""", " '' "),
    (r"\s+", " "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T|') ", "$1 $2 "),
    (r"(?i)\b(can)(not)\b", " $1 $2 "),
    (r"(?i)\b(d)('ye)\b", " $1 $2 "),
    (r"(?i)\b(gim|lem)(me)\b", " $1 $2 "),
    (r"(?i)\b(gon|wan)(na)\b", " $1 $2 "),
    (r"(?i)\b(got)(ta)\b", " $1 $2 "),
    (r"(?i)\b(more)('n)\b", " $1 $2 "),
    (r"(?i) ('t)(is|was)\b", " $1 $2 "),
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, replacement: str = "") -> str:
    for digit in "01234":
        replacement = replacement.replace(f"${digit}", f"\\{digit}")
    return f"regexp_replace({x}, {q(pattern)}, {q(replacement)}, 'g')"


def strip_html(x: str) -> str:
    for pattern in MARKUP:
        x = sub(x, pattern)
    for name, text in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " "), ("apos", "'"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{name};', {q(text)})"
    return x


def clean(x: str) -> str:
    x = sub(sub(strip_html(f"coalesce({x}, '')"), URL), HANDLE)
    runs = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+')"
    noise = ", ".join(map(q, ROMAN_URDU_NOISE))
    x = f"array_to_string(list_filter({runs}, lambda w: lower(w) NOT IN ({noise})), '')"
    for mark in ("!", "\\?", "\\."):
        x = sub(x, f"{mark}+", mark[-1])
    x = sub(x, "[^\\x00-\\x7F]")
    return f"trim({sub(f'lower({x})', r'[\t-\r\x1c-\x20]+', ' ')})"


def words(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {q(WORD)})"


def marks(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), {q(WORD_OR_MARK)})"


def blanks(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '[\\p{{Z}}\\t-\\r\\x1c-\\x1f\\x85]+'), lambda t: t <> '')"


def treebank(x: str) -> str:
    x = f"coalesce({x}, '')"
    for pattern, replacement in TREEBANK:
        x = f"(' ' || {x} || ' ')" if pattern == "^|$" else sub(x, pattern, replacement)
    return blanks(x)


def without(x: str, which: str) -> str:
    return f"list_filter({x}, lambda t: lower(t) NOT IN ({', '.join(q(w) for w in sorted(LISTS[which]))}))"


def text(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


def is_test(key: str) -> str:
    return f"(md5('42:' || CAST({key} AS VARCHAR)) < '33333333')"


LABEL = "CASE WHEN l.quality = 1 THEN 'real' ELSE 'fake' END"
LAB = f"lab AS (SELECT d.doc_id, d.text, {LABEL} AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
TURN = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"


def tf(source: str, name: str = "tf", key: str = "doc_id", tokens: str | None = None, keep: str = "") -> str:
    """CTE ``name(key, term, tf)`` of a text table."""
    tokens = tokens or words(clean("text"))
    return (
        f"{name}_t AS (SELECT {key}{keep}, unnest({tokens}) AS term FROM {source}), "
        f"{name} AS (SELECT {key}{keep}, term, CAST(count(*) AS BIGINT) AS tf FROM {name}_t GROUP BY ALL)"
    )


def vocab(source: str = "tf", k: int = 5000, name: str = "vocab") -> str:
    return (
        f"{name} AS (SELECT term, CAST(sum(tf) AS BIGINT) AS ctf, CAST(count(*) AS BIGINT) AS df FROM {source} "
        f"GROUP BY term ORDER BY 2 DESC, 1 LIMIT {k})"
    )


def weights(source: str, docs: str, variant: str = "smooth", name: str = "w", key: str = "doc_id", voc: str = "vocab") -> str:
    """CTE ``name(key, term, weight)``, L2-normalised."""
    n = f"(SELECT count(*) FROM {docs})"
    idf = f"ln(CAST({n} AS DOUBLE) / v.df) + 1" if variant == "standard" else f"ln((1.0 + {n}) / (1.0 + v.df)) + 1"
    count = "ln(CAST(t.tf AS DOUBLE)) + 1" if variant == "sublinear" else "CAST(t.tf AS DOUBLE)"
    return (
        f"{name}_r AS (SELECT t.{key}, t.term, t.tf, ({count}) * ({idf}) AS raw FROM {source} t JOIN {voc} v ON t.term = v.term), "
        f"{name} AS (SELECT {key}, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight FROM {name}_r)"
    )


def lemmas(terms: str, lexicon: str, pos: str = "noun", name: str = "changed") -> str:
    """CTE ``name(term, lemma)`` for the terms a rule changes."""
    forms = " UNION ALL ".join(
        f"SELECT term, substr(term, 1, length(term) - {len(s)}) || {q(b)} AS lemma FROM {terms} "
        f"WHERE term LIKE '%{s}' AND length(term) > {len(s)}"
        for s, b in DETACH[pos]
    )
    return (
        f"{name}_f AS ({forms}), "
        f"{name}_b AS (SELECT term, min({{'n': length(lemma), 'l': lemma}}) AS b FROM {name}_f "
        f"WHERE lemma IN (SELECT term FROM {lexicon}) GROUP BY term), "
        f"{name} AS (SELECT term, b.l AS lemma FROM {name}_b WHERE b.n <= length(term))"
    )


def cut(x: str, n: int) -> str:
    return f"substr({x}, 1, length({x}) - {n})"


def shape(x: str) -> str:
    """Each letter of ``x`` as v or c."""
    return f"list_reduce(list_prepend('', string_split({x}, '')), lambda s, l: s || CASE WHEN l IN ('a', 'e', 'i', 'o', 'u') OR (l = 'y' AND s LIKE '%c') THEN 'v' ELSE 'c' END)"


def measure(x: str) -> str:
    return f"len(regexp_extract_all({shape(x)}, 'v+c+'))"


def short_end(x: str) -> str:
    return f"({shape(x)} = 'vc' OR ({shape(x)} LIKE '%cvc' AND right({x}, 1) NOT IN ('w', 'x', 'y')))"


def swap(rules, least: int, extra: str = "TRUE") -> str:
    """The first suffix of ``rules`` that ``w`` has decides; the base needs a measure above ``least``."""
    suffix = "CASE " + " ".join(f"WHEN w LIKE '%{s}' THEN '{s}'" for s, _ in rules) + " END"
    other = "CASE x " + " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in rules) + " END"
    base = "substr(w, 1, length(w) - length(x))"
    counted = f"{base} || CASE WHEN x = 'logi' THEN 'l' ELSE '' END"
    return f"(SELECT term, CASE WHEN x IS NOT NULL AND {measure(counted)} > {least} AND {extra.format(base=base)} THEN {base} || {other} ELSE w END AS w FROM (SELECT term, w, {suffix} AS x FROM {{}}))"


def stems(terms: str, name: str) -> str:
    """CTE ``name(term, stem)`` of the published suffix rules."""
    w = "w"
    plural = f"CASE WHEN w LIKE '%sses' THEN {cut(w, 2)} WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN {cut(w, 1)} ELSE {cut(w, 2)} END WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {cut(w, 1)} ELSE w END"
    base = " ".join(f"WHEN w LIKE '%{s}' AND {shape(cut(w, len(s)))} LIKE '%v%' THEN {cut(w, len(s))}" for s in ("ed", "ing"))
    mended = (f"CASE WHEN right(b, 2) IN ('at', 'bl', 'iz') THEN b || 'e' WHEN length(b) > 1 AND right(b, 1) = substr(b, length(b) - 1, 1) AND {shape('b')} LIKE '%c' "
              f"THEN CASE WHEN right(b, 1) IN ('l', 's', 'z') THEN b ELSE {cut('b', 1)} END WHEN {measure('b')} = 1 AND {short_end('b')} THEN b || 'e' ELSE b END")
    past = (f"CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {cut(w, 1)} ELSE {cut(w, 2)} END WHEN w LIKE '%eed' THEN CASE WHEN {measure(cut(w, 3))} > 0 THEN {cut(w, 1)} ELSE w END "
            f"WHEN b IS NOT NULL THEN {mended} ELSE w END")
    steps = [
        f"(SELECT term, lower(term) AS w FROM {{}} WHERE length(term) > 2 AND lower(term) NOT IN ({', '.join(map(q, IRREGULAR))}))",
        f"(SELECT term, {plural} AS w FROM {{}})",
        f"(SELECT term, {past} AS w FROM (SELECT term, w, CASE {base} END AS b FROM {{}}))",
        f"(SELECT term, CASE WHEN w LIKE '%y' AND length(w) > 2 AND {shape(w)} LIKE '%c_' THEN {cut(w, 1)} || 'i' ELSE w END AS w FROM {{}})",
        f"(SELECT term, CASE WHEN w LIKE '%alli' AND {measure(cut(w, 4))} > 0 THEN {cut(w, 2)} ELSE w END AS w FROM {{}})",
        swap(STEP2, 0), swap(STEP3, 0),
        swap([(s, "") for s in STEP4], 1, "(x <> 'ion' OR right({base}, 1) IN ('s', 't'))"),
        f"(SELECT term, CASE WHEN w LIKE '%e' AND ({measure(cut(w, 1))} > 1 OR ({measure(cut(w, 1))} = 1 AND NOT {short_end(cut(w, 1))})) THEN {cut(w, 1)} ELSE w END AS w FROM {{}})",
        f"(SELECT term, CASE WHEN w LIKE '%ll' AND {measure(cut(w, 1))} > 1 THEN {cut(w, 1)} ELSE w END AS w FROM {{}})",
    ]
    ctes, source = "", terms
    for k, step in enumerate(steps):
        ctes += f"{name}_{k} AS {step.replace('{}', source)}, "
        source = f"{name}_{k}"
    odd = ", ".join(f"({q(a)}, {q(b)})" for a, b in IRREGULAR.items())
    return (f"{ctes}{name} AS (SELECT t.term, coalesce(i.b, r.w, lower(t.term)) AS stem FROM {terms} t LEFT JOIN {source} r ON r.term = t.term "
            f"LEFT JOIN (VALUES {odd}) i(a, b) ON i.a = lower(t.term))")


def serving(source: str, name: str, lexicon: str | None = None, key: str = "doc_id", body: str = "text") -> str:
    """CTEs of the serving chain: ``name(key, processed)``; the lexicon is ``name_v`` unless given."""
    tokens = without(treebank(clean(body)), "standard")
    return (
        f"{name}_l AS (SELECT {key}, {tokens} AS toks FROM {source}), "
        f"{name}_e AS (SELECT {key}, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM {name}_l), "
        f"{name}_v AS (SELECT DISTINCT term FROM {name}_e), "
        + lemmas(f"{name}_v", lexicon or f"{name}_v", name=f"{name}_c")
        + f", {name}_j AS (SELECT e.{key}, string_agg(coalesce(c.lemma, e.term), ' ' ORDER BY pos) AS processed "
        f"FROM {name}_e e LEFT JOIN {name}_c c ON e.term = c.term GROUP BY e.{key}), "
        f"{name} AS (SELECT s.{key}, coalesce(j.processed, '') AS processed FROM {source} s LEFT JOIN {name}_j j ON s.{key} = j.{key})"
    )


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ---------------------------------------------------------------- text

add("clean_text", f"SELECT 'documents' AS source, doc_id AS id, {clean('text')} AS cleaned FROM documents UNION ALL "
    f"SELECT 'pages', page_id, {clean('html')} FROM pages")
add("strip_html", f"SELECT page_id, {strip_html('html')} AS text FROM pages")


def _token_query(tokens: str, source: str = "documents", n: bool = True) -> str:
    size = ", CAST(len(toks) AS BIGINT) AS n" if n else ""
    return f"SELECT doc_id, {text('toks')} AS tokens{size} FROM (SELECT doc_id, {tokens} AS toks FROM {source})"


add("regex_tokens", _token_query(marks("text")))
add("word_tokens", _token_query(words("text")))
add("treebank_tokens", _token_query(treebank(clean("text"))))
add("stopwords_standard", _token_query(without(marks("text"), "standard"), n=False))
add("stopwords_domain", _token_query(without(marks("text"), "domain"), n=False))
add("min_token_len", _token_query(f"list_filter({marks('text')}, lambda t: length(t) >= 3)", n=False))

for _pos in ("noun", "verb"):
    add(f"lemma_{_pos}", f"WITH {tf('documents')}, v AS (SELECT DISTINCT term FROM tf), {lemmas('v', 'v', _pos)} "
        "SELECT v.term, coalesce(c.lemma, v.term) AS lemma FROM v LEFT JOIN changed c ON v.term = c.term")

add("preprocess", f"WITH {serving('documents', 'p')} SELECT doc_id, processed FROM p")
add("preprocess_domain_min_len", "SELECT doc_id, "
    + text(f"list_filter({without(treebank(clean('text')), 'domain')}, lambda t: length(t) >= 3)") + " AS processed FROM documents")

_DTERMS = f"{tf('documents')}, v AS (SELECT DISTINCT term FROM tf)"
add("stem_vocab", f"WITH {_DTERMS}, {stems('v', 'st')} SELECT term, stem FROM st")
_BOTH = f"WITH {_DTERMS}, {stems('v', 'st')}, {lemmas('v', 'v', 'verb')}, both_ AS (SELECT st.term, stem, coalesce(c.lemma, st.term) AS lemma FROM st LEFT JOIN changed c ON c.term = st.term)"
add("stem_vs_lemma", f"{_BOTH} SELECT * FROM both_")
add("vocabulary_reduction", f"{_BOTH} SELECT count(*) AS terms, count(DISTINCT stem) AS stems, count(DISTINCT lemma) AS lemmas FROM both_")
add("preprocess_stem", f"WITH p AS (SELECT doc_id, {without(treebank(clean('text')), 'standard')} AS toks FROM documents), "
    f"e AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM p), v AS (SELECT DISTINCT term FROM e), {stems('v', 'st')}, "
    "g AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS processed FROM e JOIN st ON st.term = e.term GROUP BY doc_id) "
    "SELECT p.doc_id, coalesce(g.processed, '') AS processed FROM p LEFT JOIN g ON g.doc_id = p.doc_id")

_split = treebank(clean("text"))
add("preprocess_requests_corpus",
    f"WITH {serving('documents', 'sv')}, r AS (SELECT {TURN} AS request_id, role = 'user' AS stopped, turn % 3 = 2 AS stem, turn % 3 <> 0 AS lemma, {_split} AS split FROM conversations), "
    f"k AS (SELECT *, CASE WHEN stopped THEN {without('split', 'standard')} ELSE split END AS kept FROM r), "
    "e AS (SELECT request_id, stem AS s, lemma AS l, unnest(kept) AS term, generate_subscripts(kept, 1) AS pos FROM k), "
    f"v AS (SELECT DISTINCT term FROM e), {lemmas('v', 'sv_v')}, {stems('v', 'st')}, "
    "g AS (SELECT request_id, string_agg(CASE WHEN s THEN st.stem WHEN l THEN coalesce(c.lemma, e.term) ELSE e.term END, ' ' ORDER BY pos) AS tokens "
    "FROM e JOIN st ON st.term = e.term LEFT JOIN changed c ON c.term = e.term GROUP BY request_id) "
    "SELECT r.request_id, coalesce(g.tokens, '') AS tokens FROM r LEFT JOIN g ON g.request_id = r.request_id")
add("preprocess_requests_flags",
    f"WITH r AS (SELECT {TURN} AS request_id, role = 'user' AS stopped, turn > 0 AS lemma, CASE WHEN turn > 1 THEN 3 ELSE 0 END AS min_len, "
    f"{_split} AS split FROM conversations), "
    f"k AS (SELECT *, CASE WHEN stopped THEN {without('split', 'standard')} ELSE split END AS kept FROM r), "
    "e AS (SELECT request_id, lemma, min_len, unnest(kept) AS term, generate_subscripts(kept, 1) AS pos FROM k), "
    "v AS (SELECT DISTINCT term FROM e WHERE lemma), " + lemmas("v", "v") + ", "
    "o AS (SELECT request_id, pos, CASE WHEN e.lemma THEN coalesce(c.lemma, e.term) ELSE e.term END AS t, min_len FROM e LEFT JOIN changed c ON e.term = c.term), "
    "g AS (SELECT request_id, string_agg(t, ' ' ORDER BY pos) AS tokens, CAST(count(*) AS BIGINT) AS n FROM o WHERE min_len <= 0 OR length(t) >= min_len GROUP BY request_id) "
    "SELECT r.request_id, coalesce(g.tokens, '') AS tokens, coalesce(g.n, 0) AS n FROM r LEFT JOIN g ON r.request_id = g.request_id")

add("ngrams", f"SELECT doc_id, CAST(len(p) - 1 AS BIGINT) AS n, array_to_string(list_transform(range(1, len(p)), lambda i: p[i] || ' ' || p[i + 1]), '|') AS grams "
    f"FROM (SELECT doc_id, list_concat(['<s>'], {words('text')}, ['</s>']) AS p FROM documents)")

# ---------------------------------------------------------------- audits

add("noise_audit", f"SELECT page_id, md5({clean('html')}) AS cleaned_md5, CAST(length(html) AS BIGINT) AS original_len, "
    f"CAST(length({clean('html')}) AS BIGINT) AS cleaned_len FROM "
    "(SELECT page_id, html FROM pages ORDER BY md5('42:' || CAST(page_id AS VARCHAR)), page_id LIMIT 200)")
add("noise_summary", f"SELECT round(avg(1 - CAST(length({clean('html')}) AS DOUBLE) / length(html)), 6) AS noise_reduction FROM pages WHERE length(html) > 0")
_counts = (f"SELECT doc_id, substr(c, 1, 50) || '...' AS preview, CAST(len({treebank('c')}) AS BIGINT) AS treebank_count, "
           f"CAST(len({marks('c')}) AS BIGINT) AS regex_count, CAST(len({blanks('c')}) AS BIGINT) AS whitespace_count "
           f"FROM (SELECT doc_id, {clean('text')} AS c FROM documents)")
add("tokenizer_compare", _counts)
add("tokenizer_summary", "SELECT round(avg(treebank_count), 6) AS avg_treebank, round(avg(regex_count), 6) AS avg_regex, "
    f"round(avg(whitespace_count), 6) AS avg_whitespace FROM (SELECT * FROM ({_counts}) ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50)")
add("oov_rate", f"WITH k AS (SELECT DISTINCT unnest({blanks('lower(text)')}) AS term FROM documents), "
    f"r AS (SELECT {TURN} AS request_id, {marks('text')} AS toks FROM conversations), "
    "e AS (SELECT request_id, lower(unnest(toks)) AS term FROM r), "
    "g AS (SELECT request_id, CAST(count(*) AS BIGINT) AS tokens, CAST(count(*) FILTER (WHERE term NOT IN (SELECT term FROM k)) AS BIGINT) AS oov FROM e GROUP BY 1) "
    "SELECT r.request_id, coalesce(g.tokens, 0) AS tokens, coalesce(g.oov, 0) AS oov, "
    "round(CASE WHEN g.tokens > 0 THEN CAST(g.oov AS DOUBLE) / g.tokens ELSE 0 END, 6) AS oov_rate FROM r LEFT JOIN g ON r.request_id = g.request_id")

# ---------------------------------------------------------------- features

_DOCS = tf("documents")
add("top_vocab", f"WITH {_DOCS}, {vocab()} SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, term, ctf AS tf, df FROM vocab")
add("bow_counts", f"WITH {_DOCS}, {vocab()} SELECT doc_id, term, tf FROM tf WHERE term IN (SELECT term FROM vocab)")
add("bow_sparsity", f"WITH {_DOCS}, {vocab()}, s AS (SELECT (SELECT count(*) FROM documents) AS r, (SELECT count(*) FROM vocab) AS c, "
    "(SELECT count(*) FROM tf WHERE term IN (SELECT term FROM vocab)) AS nnz) SELECT r AS matrix_rows, c AS matrix_cols, nnz AS non_zero_elements, "
    "round(100 * (1 - CAST(nnz AS DOUBLE) / (r * c)), 6) AS sparsity_percentage FROM s")
for _variant, _k in (("smooth", 5000), ("sublinear", 5000), ("standard", 5000)):
    add(f"tfidf_{_variant}", f"WITH {_DOCS}, {vocab(k=_k)}, {weights('tf', 'documents', _variant)} SELECT doc_id, term, round(weight, 6) AS weight FROM w")
add("tfidf_stats", f"WITH {_DOCS}, {vocab()}, {weights('tf', 'documents')} SELECT round(max(weight), 6) AS max_tfidf_value, "
    "round(sum(weight) / ((SELECT count(*) FROM documents) * (SELECT count(*) FROM vocab)), 9) AS mean_tfidf_value FROM w")

_LAB = f"{LAB}, {tf('lab')}"
add("discriminative_terms", f"WITH {_LAB}, {vocab()}, {weights('tf', 'lab')}, m AS (SELECT label, term, round(sum(weight) / (SELECT count(*) FROM lab b WHERE b.label = lab.label), 6) AS mean_weight "
    "FROM w JOIN lab ON w.doc_id = lab.doc_id GROUP BY label, term) SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY mean_weight DESC, term) AS BIGINT) AS rank, term, mean_weight "
    "FROM m QUALIFY row_number() OVER (PARTITION BY label ORDER BY mean_weight DESC, term) <= 5")

# ---------------------------------------------------------------- language model


def grams(source: str, n: int, key: str = "", pad: bool = True, tokens: str = "toks") -> str:
    """``key, n, context, word`` of a token table."""
    start = "[" + ", ".join(["'<s>'"] * (n - 1)) + "]"
    padded = f"list_concat({start}, {tokens}, ['</s>'])" if pad and n > 1 else (f"list_concat({tokens}, ['</s>'])" if pad else tokens)
    context = "''" if n == 1 else " || ' ' || ".join(f"p[i + {j}]" for j in range(n - 1))
    return (
        f"SELECT {key}{n} AS n, g.c AS context, g.w AS word FROM (SELECT {key}unnest(list_transform(range(1, greatest(len(p) - {n} + 2, 1)), "
        f"lambda i: {{'c': {context}, 'w': p[i + {n - 1}]}})) AS g FROM (SELECT {key}{padded} AS p FROM {source}))"
    )


def lm(source: str, n: int, key: str = "") -> str:
    """CTEs ``cnt, ctx, wrd`` of a model over ``source``; ``key`` ends in a comma."""
    union = " UNION ALL ".join(grams(source, k, key) for k in range(1, n + 1))
    return (
        f"cnt AS (SELECT {key}n, context, word, CAST(count(*) AS BIGINT) AS cnt FROM ({union}) GROUP BY ALL), "
        f"ctx AS (SELECT {key}n, context, CAST(sum(cnt) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS followers FROM cnt GROUP BY ALL), "
        f"wrd AS (SELECT {key}n, word, CAST(count(*) AS BIGINT) AS continuations FROM cnt GROUP BY ALL), "
        f"pc AS (SELECT {key}n, word, CAST(continuations AS DOUBLE) / sum(continuations) OVER (PARTITION BY {key}n) AS p_cont FROM wrd)"
    )


_LMDOCS = f"src AS (SELECT doc_id, {words(clean('text'))} AS toks FROM documents)"
_TURNS = f"trn AS (SELECT {TURN} AS request_id, {words(clean('text'))} AS toks FROM conversations)"


def kn(source: str, n: int, by: str = "") -> str:
    """CTE ``kn(by, context, word, level, p)`` for the distinct grams of ``source`` (``by`` ends in a comma)."""
    b = by.rstrip(", ")
    same = lambda x: f"{x}.{b} = g.{b} AND " if b else ""
    levels = [(k, "g.context" if k == n else ("''" if k == 1 else f"array_to_string(list_slice(string_split(g.context, ' '), {n - k + 1}, {n - 1}), ' ')")) for k in range(n, 0, -1)]
    joins = " ".join(f"LEFT JOIN ctx x{k} ON {same(f'x{k}')}x{k}.n = {k} AND x{k}.context = {c}" for k, c in levels)
    pick = lambda col: "coalesce(" + ", ".join(f"x{k}.{col}" for k, _ in levels) + ")"
    g = f"g.{b}, " if b else ""
    return (
        f"lvl AS (SELECT {g}g.context, g.word, {pick('n')} AS level, {pick('context')} AS used, {pick('total')} AS total, {pick('followers')} AS followers FROM {source} g {joins}), "
        f"kn AS (SELECT {g}g.context, g.word, g.level, greatest(coalesce(c.cnt, 0) - 0.75, 0) / CAST(g.total AS DOUBLE) + 0.75 * g.followers / CAST(g.total AS DOUBLE) * coalesce(w.p_cont, 0) AS p "
        f"FROM lvl g LEFT JOIN cnt c ON {same('c')}c.n = g.level AND c.context = g.used AND c.word = g.word LEFT JOIN pc w ON {same('w')}w.n = g.level AND w.word = g.word)"
    )


_LM3 = f"WITH {_LMDOCS}, {lm('src', 3)}"
add("ngram_counts", f"{_LM3} SELECT CAST(n AS BIGINT) AS n, context, word, cnt FROM cnt")
add("ngram_context_counts", f"{_LM3} SELECT CAST(n AS BIGINT) AS n, context, total, followers FROM ctx")
add("ngram_continuations", f"{_LM3} SELECT CAST(n AS BIGINT) AS n, word, continuations FROM wrd")
add("lm_vocabulary", f"WITH {_LMDOCS} SELECT DISTINCT unnest(toks) AS word FROM src UNION SELECT '<s>' UNION SELECT '</s>'")

_free = " UNION ALL ".join(grams("t", n, "label, ", pad=False) for n in (1, 2, 3))
add("top_ngrams_by_class", f"WITH {LAB}, t AS (SELECT label, {words(clean('text'))} AS toks FROM lab), c AS (SELECT label, n, trim(context || ' ' || word) AS ngram, CAST(count(*) AS BIGINT) AS cnt FROM ({_free}) GROUP BY ALL) "
    "SELECT label, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (PARTITION BY label, n ORDER BY cnt DESC, ngram) AS BIGINT) AS rank, ngram, cnt FROM c "
    "QUALIFY row_number() OVER (PARTITION BY label, n ORDER BY cnt DESC, ngram) <= 5")

_asked = f"asked AS (SELECT DISTINCT context, word FROM ({grams('trn', 3)}))"
add("kn_prob", f"{_LM3}, {_TURNS}, {_asked}, {kn('asked', 3)} SELECT context, word, CAST(level AS BIGINT) AS level, round(p, 9) AS p FROM kn")
_logp = "ln(CASE WHEN k.p > 0 THEN k.p ELSE 1e-10 END)"
add("kn_perplexity", f"{_LM3}, {_TURNS}, pos AS ({grams('trn', 3)}), {_asked}, {kn('asked', 3)} "
    f"SELECT CAST(count(*) AS BIGINT) AS positions, round(exp(-avg({_logp})), 4) AS perplexity FROM pos JOIN kn k ON pos.context = k.context AND pos.word = k.word")
add("kn_perplexity_by_text", f"WITH {_LMDOCS}, {lm('src', 3)}, {_TURNS}, pos AS ({grams('trn', 3, 'request_id, ')}), asked AS (SELECT DISTINCT context, word FROM pos), {kn('asked', 3)} "
    f"SELECT request_id, CAST(count(*) AS BIGINT) AS positions, round(exp(-avg({_logp})), 4) AS perplexity FROM pos JOIN kn k ON pos.context = k.context AND pos.word = k.word GROUP BY request_id")
add("kn_next_word", f"{_LM3}, {_TURNS}, q AS (SELECT DISTINCT array_to_string(list_slice(list_concat(['<s>', '<s>'], toks), -2, -1), ' ') AS context FROM trn), "
    "asked AS (SELECT context, '' AS word FROM q), " + kn("asked", 3) + ", "
    "best AS (SELECT context, level, used, total, followers FROM lvl), "
    "a AS (SELECT b.context, b.level, b.total, b.followers, c.word, c.cnt FROM best b JOIN cnt c ON c.n = b.level AND c.context = b.used "
    "UNION ALL SELECT b.context, b.level, b.total, b.followers, t.word, 0 FROM best b JOIN (SELECT n, word FROM pc QUALIFY row_number() OVER (PARTITION BY n ORDER BY p_cont DESC, word) <= 5) t ON t.n = b.level), "
    "m AS (SELECT a.context, a.word, round(max(greatest(a.cnt - 0.75, 0) / CAST(a.total AS DOUBLE) + 0.75 * a.followers / CAST(a.total AS DOUBLE) * pc.p_cont), 9) AS p FROM a JOIN pc ON pc.n = a.level AND pc.word = a.word GROUP BY a.context, a.word) "
    "SELECT context, CAST(row_number() OVER (PARTITION BY context ORDER BY p DESC, word) AS BIGINT) AS rank, word, p FROM m "
    "QUALIFY row_number() OVER (PARTITION BY context ORDER BY p DESC, word) <= 5")
_unit = lambda kind: f"(CAST('0x' || substr(md5('42|{kind}|' || b.context), 1, 12) AS BIGINT) + 0.5) / CAST({16**12} AS DOUBLE)"
add("kn_sample_word", f"{_LM3}, {_TURNS}, q AS (SELECT DISTINCT array_to_string(list_slice(list_concat(['<s>', '<s>'], toks), -2, -1), ' ') AS context FROM trn), "
    "asked AS (SELECT context, '' AS word FROM q), " + kn("asked", 3) + ", "
    "heavy AS (SELECT n, context, word, cnt - 0.75 AS w FROM cnt WHERE cnt > 0.75), "
    f"b AS (SELECT b.context, level, used, {_unit('word')} AS u, {_unit('side')} < 0.75 * followers / CAST(total AS DOUBLE) OR NOT EXISTS (SELECT 1 FROM heavy h WHERE h.n = b.level AND h.context = b.used) AS other FROM lvl b), "
    "ps AS (SELECT n, word, sum(p_cont) OVER o - p_cont AS lo, sum(p_cont) OVER o AS hi, sum(p_cont) OVER (PARTITION BY n) AS tot FROM pc WINDOW o AS (PARTITION BY n ORDER BY md5(word), word ROWS UNBOUNDED PRECEDING)), "
    "hs AS (SELECT n, context, word, sum(w) OVER o - w AS lo, sum(w) OVER o AS hi, sum(w) OVER (PARTITION BY n, context) AS tot FROM heavy WHERE (n, context) IN (SELECT (level, used) FROM b WHERE NOT other) WINDOW o AS (PARTITION BY n, context ORDER BY md5(word), word ROWS UNBOUNDED PRECEDING)) "
    "SELECT b.context, word FROM b JOIN ps ON other AND ps.n = b.level AND b.u * tot >= lo AND b.u * tot < hi "
    "UNION ALL SELECT b.context, word FROM b JOIN hs ON NOT other AND hs.n = b.level AND hs.context = b.used AND b.u * tot >= lo AND b.u * tot < hi")
add("lm_classify", f"WITH {LAB}, tok AS (SELECT doc_id, label, {words(clean('text'))} AS toks FROM lab), src AS (SELECT * FROM tok WHERE NOT {is_test('doc_id')}), tst AS (SELECT * FROM tok WHERE {is_test('doc_id')}), "
    f"{lm('src', 3, 'label, ')}, pos AS ({grams('tst', 3, 'doc_id, ')}), asked AS (SELECT DISTINCT l.label, context, word FROM pos, (SELECT DISTINCT label FROM src) l), {kn('asked', 3, 'label, ')}, "
    f"s AS (SELECT doc_id, k.label, round(exp(-avg({_logp})), 6) AS pp FROM pos JOIN kn k ON pos.context = k.context AND pos.word = k.word GROUP BY doc_id, k.label) "
    "SELECT doc_id, label AS prediction, round(pp, 4) AS perplexity FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pp, label) = 1")

# ---------------------------------------------------------------- Naive Bayes

_PRIOR = "prior AS (SELECT label, count(*) AS n, ln(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {src})) AS log_prior FROM {src} GROUP BY label)"
add("class_priors", f"WITH {LAB} SELECT label, CAST(count(*) AS BIGINT) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lab), 6) AS prior, round(ln(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lab)), 6) AS log_prior FROM lab GROUP BY label")
add("class_weights", f"WITH {LAB} SELECT label, CAST(count(*) AS BIGINT) AS n, round(CAST((SELECT count(*) FROM lab) AS DOUBLE) / ((SELECT count(DISTINCT label) FROM lab) * count(*)), 6) AS weight FROM lab GROUP BY label")


def nb(train: str, value: str = "tf", width: str = "(SELECT count(DISTINCT term) FROM c)") -> str:
    """CTEs ``c(term, label, cnt), tot(label, total), nbv, prior`` from ``tr(doc_id, label, term, value)`` and documents ``train``."""
    return (
        f"c AS (SELECT term, label, sum({value}) AS cnt FROM tr GROUP BY ALL), tot AS (SELECT label, CAST(sum(cnt) AS DOUBLE) AS total FROM c GROUP BY label), "
        f"nbv AS (SELECT {width} AS v), {_PRIOR.format(src=train)}"
    )


def scored(docs: str, terms: str, value: str = "tf", alpha: str = "1.0", key: str = "doc_id", extra: str = "", cross: str = "") -> str:
    """CTE ``s(key, label, score)``."""
    return (
        f"s AS (SELECT d.{key}, p.label{extra}, max(p.log_prior) + coalesce(sum(t.{value} * ln((coalesce(c.cnt, 0) + {alpha}) / (tot.total + {alpha} * (SELECT v FROM nbv)))), 0) AS score "
        f"FROM {docs} d CROSS JOIN prior p {cross} JOIN tot ON tot.label = p.label LEFT JOIN {terms} t ON t.{key} = d.{key} LEFT JOIN c ON c.term = t.term AND c.label = p.label GROUP BY d.{key}, p.label{extra})"
    )


_TR = "tr AS (SELECT lab.doc_id, label, term, tf FROM tf JOIN lab ON tf.doc_id = lab.doc_id)"
_NB = f"WITH {_LAB}, {_TR}, {nb('lab')}"
add("nb_train_tokens", f"{_NB} SELECT term, c.label AS class, CAST(cnt AS BIGINT) AS cnt, round(ln((cnt + 1.0) / (total + (SELECT v FROM nbv))), 6) AS ll FROM c JOIN tot ON c.label = tot.label")
add("nb_class_table", f"{_NB} SELECT prior.label AS class, round(log_prior, 6) AS log_prior, round(ln(1.0 / (total + (SELECT v FROM nbv))), 6) AS default_ll FROM prior JOIN tot ON prior.label = tot.label")
_LABW = f"WITH {_LAB}, {vocab()}, {weights('tf', 'lab')}, tr AS (SELECT w.doc_id, label, term, weight FROM w JOIN lab ON w.doc_id = lab.doc_id), {nb('lab', 'weight')}"
add("nb_train_tfidf", f"{_LABW} SELECT term, c.label AS class, round(cnt, 6) AS total_weight, round(ln((cnt + 1.0) / (total + (SELECT v FROM nbv))), 6) AS ll FROM c JOIN tot ON c.label = tot.label")

_ALL = f"{_NB}, {tf('documents', 'dtf')}, {scored('documents', 'dtf')}"
_PROBA = "pr AS (SELECT doc_id, label, score, exp(score - max(score) OVER (PARTITION BY doc_id)) AS e FROM s), pb AS (SELECT doc_id, label, score, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM pr)"
add("nb_score", f"{_ALL} SELECT doc_id, label AS class, round(score, 4) AS score FROM s")
add("nb_proba", f"{_ALL}, {_PROBA} SELECT doc_id, label AS class, round(p, 6) AS p FROM pb")
_FIRST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, label) = 1"
add("nb_predict", f"{_ALL}, {_PROBA} SELECT doc_id, label AS prediction, round(p, 6) AS confidence FROM pb {_FIRST.format(key='doc_id')}")

_SPLIT = (f"{_LAB}, trn AS (SELECT * FROM lab WHERE NOT {is_test('doc_id')}), tst AS (SELECT * FROM lab WHERE {is_test('doc_id')}), "
          f"tr AS (SELECT trn.doc_id, label, term, tf FROM tf JOIN trn ON tf.doc_id = trn.doc_id), {nb('trn')}")
_TEST = (f"WITH {_SPLIT}, {scored('tst', 'tf')}, {_PROBA}, best AS (SELECT doc_id, label AS prediction FROM pb {_FIRST.format(key='doc_id')}), "
         "ev AS (SELECT tst.doc_id, tst.label, prediction FROM tst JOIN best ON tst.doc_id = best.doc_id)")
_SWEEP = (f"WITH {_SPLIT}, al(alpha) AS (VALUES {', '.join(f'(CAST({a} AS DOUBLE))' for a in ALPHAS)}), {scored('tst', 'tf', alpha='alpha', extra=', alpha', cross='CROSS JOIN al')}, "
          "best AS (SELECT doc_id, alpha, label AS prediction FROM s QUALIFY row_number() OVER (PARTITION BY doc_id, alpha ORDER BY score DESC, label) = 1), "
          "ev AS (SELECT alpha, tst.label, prediction FROM tst JOIN best ON tst.doc_id = best.doc_id)")
add("nb_alpha_sweep", f"{_SWEEP} SELECT alpha, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ev GROUP BY alpha")

_CLAIMS = (f"WITH {LAB}, {serving('lab', 'sv')}, {tf('sv', 'tf', tokens=words('processed'))}, {vocab()}, {weights('tf', 'lab')}, "
           f"tr AS (SELECT w.doc_id, label, term, weight FROM w JOIN lab ON w.doc_id = lab.doc_id), {nb('lab', 'weight', '(SELECT count(*) FROM vocab)')}, "
           f"req AS (SELECT {TURN} AS doc_id, text FROM conversations), {serving('req', 'rq', 'sv_v')}, {tf('rq', 'rtf', tokens=words('processed'))}, "
           f"{weights('rtf', 'lab', name='rw')}, {scored('req', 'rw', 'weight')}, {_PROBA}")
add("classify_batch", f"{_CLAIMS}, b AS (SELECT doc_id, label AS prediction FROM pb {_FIRST.format(key='doc_id')}) "
    f"SELECT conv_id, CAST(count(*) AS BIGINT) AS batch_size, CASE WHEN count(*) > 100 THEN '' ELSE string_agg(prediction, ',' ORDER BY turn) END AS predictions, "
    f"CASE WHEN count(*) > 100 THEN 'batch too large' ELSE '' END AS reason FROM conversations c JOIN b ON b.doc_id = {TURN.replace('conv_id', 'c.conv_id').replace('turn AS', 'c.turn AS')} GROUP BY conv_id")
add("classify_nb", f"{_CLAIMS}, b AS (SELECT doc_id, label AS prediction, p FROM pb {_FIRST.format(key='doc_id')}) "
    "SELECT b.doc_id AS request_id, prediction, round(p, 6) AS confidence, (SELECT round(p, 6) FROM pb x WHERE x.doc_id = b.doc_id AND label = 'fake') AS p_fake, "
    "(SELECT round(p, 6) FROM pb x WHERE x.doc_id = b.doc_id AND label = 'real') AS p_real FROM b JOIN req ON req.doc_id = b.doc_id WHERE length(text) BETWEEN 10 AND 10000")
add("nb_top_features", f"{_CLAIMS}, f AS (SELECT doc_id, term, round(weight, 6) AS weight FROM rw) SELECT doc_id AS request_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS BIGINT) AS rank, term, weight "
    "FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) <= 5")
add("classify_batch_nb", f"{_CLAIMS}, b AS (SELECT doc_id, label AS prediction FROM pb {_FIRST.format(key='doc_id')}) "
    "SELECT b.doc_id AS request_id, substr(text, 1, 50) || '...' AS text, prediction FROM b JOIN req ON req.doc_id = b.doc_id")

# ---------------------------------------------------------------- retrieval

add("similar_claims", f"WITH {serving('documents', 'sv')}, {tf('sv', 'tf', tokens=words('processed'))}, {vocab()}, {weights('tf', 'documents')}, "
    f"{serving('benchmark', 'bq', 'sv_v', 'item_id')}, {tf('bq', 'qtf', 'item_id', words('processed'))}, {weights('qtf', 'documents', name='qw', key='item_id')}, "
    "sc AS (SELECT qw.item_id, w.doc_id, sum(qw.weight * w.weight) AS s FROM qw JOIN w ON qw.term = w.term GROUP BY ALL), "
    "every AS (SELECT b.item_id, d.doc_id, d.text, round(coalesce(sc.s, 0), 6) AS similarity FROM benchmark b CROSS JOIN documents d LEFT JOIN sc ON sc.item_id = b.item_id AND sc.doc_id = d.doc_id), "
    "top AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM every QUALIFY rank <= 5) "
    f"SELECT item_id, CAST(rank AS BIGINT) AS rank, top.doc_id, substr(text, 1, 50) || '...' AS text, CASE WHEN l.quality IS NULL THEN '' ELSE {LABEL} END AS label, similarity FROM top LEFT JOIN labels l ON l.doc_id = top.doc_id")

add("similar_claims_top_k", f"WITH {serving('documents', 'sv')}, {tf('sv', 'tf', tokens=words('processed'))}, {vocab()}, {weights('tf', 'documents')}, "
    f"req AS (SELECT {TURN} AS request_id, text, (turn + 1) * 4 AS k FROM conversations WHERE length(text) >= 1 AND (turn + 1) * 4 BETWEEN 1 AND 20), "
    f"{serving('req', 'bq', 'sv_v', 'request_id')}, {tf('bq', 'qtf', 'request_id', words('processed'))}, {weights('qtf', 'documents', name='qw', key='request_id')}, "
    "sc AS (SELECT qw.request_id, w.doc_id, sum(qw.weight * w.weight) AS s FROM qw JOIN w ON qw.term = w.term GROUP BY ALL), "
    "every AS (SELECT b.request_id, b.k, d.doc_id, round(coalesce(sc.s, 0), 6) AS similarity FROM req b CROSS JOIN documents d LEFT JOIN sc ON sc.request_id = b.request_id AND sc.doc_id = d.doc_id) "
    "SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, doc_id) AS rank, doc_id, similarity FROM every QUALIFY rank <= k")

# ---------------------------------------------------------------- sampling, evaluation

add("hash_split", f"SELECT doc_id, {is_test('doc_id')} AS is_test FROM documents")
add("hash_sample", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 200")
add("head_rows", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 1000")
add("label_encode", "SELECT d.doc_id, CAST(CASE WHEN l.quality = 1 THEN 1 WHEN l.quality IS NOT NULL THEN 0 END AS BIGINT) AS target, "
    f"CASE WHEN l.quality IS NOT NULL THEN {LABEL} END AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def _reason(low: int, high: int | None) -> str:
    long = f" WHEN length(text) > {high} THEN 'text too long'" if high else ""
    return f"CASE WHEN text IS NULL THEN 'text missing' WHEN length(text) < {low} THEN 'text too short'{long} ELSE '' END"


add("validate_requests", " UNION ALL ".join(
    f"SELECT {TURN} AS request_id, '{k}' AS kind, {_reason(*lim)} AS reason FROM conversations"
    for k, lim in (("preprocess", (1, 10000)), ("classify", (10, 10000)), ("retrieve", (1, None)))
) + f" UNION ALL SELECT {TURN}, 'top_k', CASE WHEN (turn + 1) * 4 < 1 OR (turn + 1) * 4 > 20 THEN 'top_k out of range' ELSE '' END FROM conversations"
    " UNION ALL SELECT CAST(conv_id AS VARCHAR), 'batch', CASE WHEN count(*) > 100 THEN 'batch too large' ELSE '' END FROM conversations GROUP BY conv_id")

_CLS = "cl(k) AS (VALUES ('fake'), ('real'))"
add("confusion", f"{_TEST}, {_CLS} SELECT a.k AS label, b.k AS prediction, CAST((SELECT count(*) FROM ev WHERE ev.label = a.k AND ev.prediction = b.k) AS BIGINT) AS n FROM cl a CROSS JOIN cl b")


def report(source: str, by: str = "") -> str:
    """CTEs ``rep(by, k, pr, rc, f1, sup)`` and ``tot_(by, acc, n)``; ``by`` ends in a comma."""
    on = " AND ".join(["TRUE"] + [f"e.{b.strip()} = g.{b.strip()}" for b in by.split(",") if b.strip()])
    g = "".join(f"g.{b.strip()}, " for b in by.split(",") if b.strip())
    base = f"(SELECT DISTINCT {by.rstrip(', ')} FROM {source})" if by else "(SELECT 1)"
    return (
        f"cnt_ AS (SELECT {g}k, count(*) FILTER (WHERE e.label = k AND e.prediction = k) AS tp, count(*) FILTER (WHERE e.prediction = k) AS pp, count(*) FILTER (WHERE e.label = k) AS sup "
        f"FROM {base} g CROSS JOIN cl JOIN {source} e ON {on} GROUP BY ALL), "
        f"rep AS (SELECT *, CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS pr, CASE WHEN sup = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / sup END AS rc, CASE WHEN pp + sup = 0 THEN 0.0 ELSE 2.0 * CAST(tp AS DOUBLE) / (pp + sup) END AS f1 FROM cnt_), "
        f"tot_ AS (SELECT {by}CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc FROM {source} GROUP BY ALL)"
    )


add("class_report", f"{_TEST}, {_CLS}, {report('ev')} SELECT k AS class, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, CAST(sup AS BIGINT) AS support FROM rep "
    "UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM tot_ "
    "UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1), 6), max(n) FROM rep, tot_ "
    "UNION ALL SELECT 'weighted avg', round(sum(pr * sup / n), 6), round(sum(rc * sup / n), 6), round(sum(f1 * sup / n), 6), max(n) FROM rep, tot_")
add("accuracy", f"{_TEST} SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ev")

_MARGIN = (f"WITH {_SPLIT}, {scored('tst', 'tf')}, mg AS (SELECT tst.doc_id, tst.label, round(r.score - f.score, 9) AS score FROM tst "
           "JOIN s r ON r.doc_id = tst.doc_id AND r.label = 'real' JOIN s f ON f.doc_id = tst.doc_id AND f.label = 'fake'), "
           "pt AS (SELECT score, count(*) FILTER (WHERE label = 'real') AS pos, count(*) FILTER (WHERE label <> 'real') AS neg FROM mg GROUP BY score), "
           "rc AS (SELECT score, CAST(sum(neg) OVER o AS DOUBLE) / sum(neg) OVER () AS fpr, CAST(sum(pos) OVER o AS DOUBLE) / sum(pos) OVER () AS tpr FROM pt WINDOW o AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))")
add("roc_curve", f"{_MARGIN} SELECT round(score, 6) AS score, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM rc")
add("roc_auc", f"{_MARGIN} SELECT round(sum((fpr - lf) * (tpr + lt) / 2), 6) AS roc_auc FROM (SELECT fpr, tpr, lag(fpr, 1, 0) OVER (ORDER BY score DESC) AS lf, lag(tpr, 1, 0) OVER (ORDER BY score DESC) AS lt FROM rc)")
add("misclassified_buckets", f"{_TEST}, ov AS (SELECT tf.doc_id, round(CAST(sum(CASE WHEN term IN (SELECT term FROM c) THEN 0 ELSE tf END) AS DOUBLE) / sum(tf), 6) AS oov_rate FROM tf GROUP BY tf.doc_id), "
    "x AS (SELECT ev.doc_id, ev.label, prediction, coalesce(oov_rate, 0) AS oov_rate, text FROM ev LEFT JOIN ov ON ov.doc_id = ev.doc_id JOIN documents d ON d.doc_id = ev.doc_id WHERE ev.label <> prediction) "
    "SELECT doc_id, label, prediction, oov_rate, CASE WHEN oov_rate > 0.5 THEN 'oov' WHEN regexp_matches(text, '[\"“”«»„]') THEN 'quotes' ELSE 'other' END AS bucket FROM x ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 30")
add("dataset_profile", "SELECT lang, CAST(count(*) AS BIGINT) AS documents, CAST(count(DISTINCT text) AS BIGINT) AS distinct_texts, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM documents), 6) AS share, "
    "round(1 - CAST(count(DISTINCT text) AS DOUBLE) / count(*), 6) AS duplicate_rate FROM documents GROUP BY lang")
add("dedupe_exact", f"SELECT min(doc_id) AS doc_id, md5(c) AS text_md5 FROM (SELECT doc_id, {clean('text')} AS c FROM documents) GROUP BY c")

# ---------------------------------------------------------------- experiments

_RUNS = (f"{_SWEEP}, {_CLS}, {report('ev', 'alpha, ')}, runs AS (SELECT 'nb-' || CAST(rep.alpha AS VARCHAR) AS run_id, rep.alpha, round(sum(f1 * sup / n), 6) AS f1_weighted, round(max(acc), 6) AS accuracy, "
         + ", ".join(f"round(max({col}) FILTER (WHERE k = '{c}'), 6) AS {m}_{c}" for c in ("fake", "real") for m, col in (("precision", "pr"), ("recall", "rc"), ("f1", "f1")))
         + " FROM rep JOIN tot_ ON rep.alpha = tot_.alpha GROUP BY rep.alpha), reg AS (SELECT row_number() OVER (ORDER BY run_id) AS version, run_id, f1_weighted, accuracy FROM runs)")
add("run_flatten", f"{_RUNS} SELECT run_id, CAST(0 AS BIGINT) AS remove_stopwords, CAST(CASE WHEN alpha >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS smoothed, alpha, f1_weighted, accuracy FROM runs")
add("best_run", f"{_RUNS} SELECT run_id, f1_weighted FROM runs ORDER BY f1_weighted DESC, run_id LIMIT 1")
add("promotion", f"{_RUNS}, top1 AS (SELECT run_id, f1_weighted FROM runs ORDER BY f1_weighted DESC, run_id LIMIT 1), "
    "win AS (SELECT round((SELECT f1_weighted FROM top1), 9) >= round((SELECT f1_weighted FROM reg WHERE version = 2), 9) + 0.01 AS w) "
    "SELECT 'claims-nb' AS model_name, CAST(version AS BIGINT) AS version, CASE WHEN version = 2 AND NOT (SELECT w FROM win) THEN 'Production' WHEN version = 3 THEN 'Staging' ELSE 'Archived' END AS stage, run_id FROM reg "
    "UNION ALL SELECT 'claims-nb', CAST((SELECT max(version) + 1 FROM reg) AS BIGINT), CASE WHEN (SELECT w FROM win) THEN 'Production' ELSE 'Staging' END, run_id FROM top1")
add("model_history", f"{_RUNS} SELECT 'claims-nb' AS model_name, CAST(version AS BIGINT) AS version, CASE WHEN version = 2 THEN 'Production' WHEN version = 3 THEN 'Staging' ELSE 'Archived' END AS stage, f1_weighted, accuracy FROM reg")
add("run_log", f"{_RUNS} " + " UNION ALL ".join(f"SELECT run_id, '{m}' AS metric, {m} AS value FROM runs" for m in
    ("accuracy", "f1_weighted", "precision_fake", "recall_fake", "f1_fake", "precision_real", "recall_real", "f1_real")))

_METRICS = ("accuracy", "f1_weighted", "precision_fake", "recall_fake", "f1_fake", "precision_real", "recall_real", "f1_real")
_STEPS = f"{_RUNS}, st AS (" + " UNION ALL ".join(f"SELECT run_id, row_number() OVER (ORDER BY alpha) - 1 AS step, '{m}' AS metric, {m} AS value FROM runs" for m in _METRICS) + ")"
add("run_steps", f"{_STEPS} SELECT run_id, 'nb-sweep' AS parent_run_id, step, metric, value FROM st")
add("run_summary", f"{_STEPS} SELECT above AS run_id, metric, count(*) AS runs, arg_min(run_id, {{'v': -value, 'r': run_id}}) AS best_run, max(value) AS best, min(value) AS worst, "
    "arg_max(run_id, step) AS last_run, arg_max(value, step) AS last FROM st, (VALUES ('nb-sweep'), ('project')) v(above) GROUP BY above, metric")

# ---------------------------------------------------------------- files and lake

add("detect_text_column", "WITH m AS (SELECT avg(length(CAST(page_id AS VARCHAR))) AS a, avg(length(coalesce(url, 'nan'))) AS b, avg(length(coalesce(html, 'nan'))) AS c FROM pages) "
    + " UNION ALL ".join(f"SELECT '{n}' AS column, round({x}, 6) AS mean_length, {w} AS chosen FROM m" for n, x, w in
                         (("page_id", "a", "a >= b AND a >= c"), ("url", "b", "b > a AND b >= c"), ("html", "c", "c > a AND c > b"))))
_MANIFEST = "m AS (" + " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS name, '2024' || lpad(CAST(coalesce(max({k}), 0) AS VARCHAR), 10, '0') AS version, '{k}' AS key, CAST(count(*) AS VARCHAR) AS rows, '{n}' AS columns FROM {t}"
    for layer, t, k, n in (("processed", "documents", "doc_id", 3), ("processed", "pages", "page_id", 2), ("embeddings", "embeddings", "vec_id", 2))) + ")"
add("list_versions", f"WITH {_MANIFEST} SELECT layer, CAST(count(DISTINCT version) AS BIGINT) AS n, string_agg(DISTINCT version, ',' ORDER BY version) AS versions FROM m GROUP BY layer UNION ALL SELECT 'raw', 0, ''")
add("metadata_json", f"WITH {_MANIFEST} SELECT * FROM m")
_FULL = f"(SELECT doc_id, {clean('text')} AS c FROM documents)"
add("lake_roundtrip", f"SELECT 'claims' AS artifact, '20240101000000' AS version, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT c) AS BIGINT) AS texts, CAST(0 AS BIGINT) AS chars FROM {_FULL} "
    f"UNION ALL SELECT 'claims_sized', '20240102000000', CAST(count(*) AS BIGINT), CAST(count(DISTINCT c) AS BIGINT), CAST(sum(length(c)) AS BIGINT) FROM {_FULL}")
add("ingest_incremental", "SELECT 1 AS run, 'cleaned' AS status, CAST(count(DISTINCT lang) AS BIGINT) AS files FROM documents UNION ALL SELECT 2, 'skipped', CAST(count(DISTINCT lang) AS BIGINT) FROM documents")
add("ingest_cleaned", f"SELECT doc_id, c AS cleaned_text FROM {_FULL} WHERE c NOT IN ('', 'nan')")
add("stream_clean", f"SELECT page_id, {clean('html')} AS cleaned_text FROM pages")

add("ingest_malformed", f"SELECT doc_id, c AS cleaned_text FROM {_FULL} WHERE doc_id % 10 <> 0 AND c NOT IN ('', 'nan')")
add("stream_ingest", ORACLE["ingest_malformed"])
add("stream_ingest_files", "SELECT doc_id % 2 AS arrival, 'cleaned' AS status, CAST(count(*) FILTER (WHERE doc_id % 10 <> 0) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE doc_id % 10 = 0) AS BIGINT) AS skipped, '' AS detail "
    "FROM documents GROUP BY 1 UNION ALL SELECT 2, 'failed', 0, 0, 'other columns' FROM pages GROUP BY 1")
add("lake_raw", "SELECT source, doc_id // 1000 AS lot, CAST(0 AS BIGINT) AS at, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS bytes, "
    "md5(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) || chr(10)) AS digest FROM documents GROUP BY ALL")
add("lake_vectors", "SELECT vec_id, 'vectors' AS artifact, '20240101000000' AS version, generate_subscripts(embedding, 1) - 1 AS at, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings")
_UNIT = "u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
add("similar_vectors", f"WITH {_UNIT}, p AS (SELECT a.vec_id, b.vec_id AS other_id, round(list_cosine_similarity(a.v, b.v), 9) AS s FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) "
    "SELECT vec_id, other_id, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other_id) AS rank, round(s, 6) AS similarity FROM p QUALIFY rank <= 10")
add("vocabulary_export", f"WITH {_DOCS}, {vocab()} SELECT term AS word, CAST(length(term) AS BIGINT) AS length FROM vocab")
add("report_export", ORACLE["class_report"])
add("stopword_sets", f"WITH {_DOCS}, l(list, word) AS (VALUES " + ", ".join(f"('{n}', {q(w)})" for n in ("standard", "domain") for w in sorted(LISTS[n]))
    + ") SELECT list, word, CAST(coalesce((SELECT sum(tf) FROM tf WHERE term = word), 0) AS BIGINT) AS n FROM l")
add("normalized_tokens", f"WITH n_l AS (SELECT doc_id, {without(words(clean('text')), 'domain')} AS toks FROM documents), "
    "n_e AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM n_l), n_v AS (SELECT DISTINCT term FROM n_e), "
    + lemmas("n_v", "n_v", name="n_c")
    + ", n_j AS (SELECT e.doc_id, string_agg(coalesce(c.lemma, e.term), ' ' ORDER BY pos) AS tokens FROM n_e e LEFT JOIN n_c c ON e.term = c.term GROUP BY e.doc_id) "
    "SELECT d.doc_id, coalesce(tokens, '') AS tokens FROM documents d LEFT JOIN n_j j ON d.doc_id = j.doc_id")
add("stream_score_nb", f"{_ALL}, {_PROBA} SELECT doc_id, label AS prediction, round(p, 6) AS confidence FROM pb WHERE doc_id IN (SELECT doc_id FROM documents WHERE length(text) BETWEEN 10 AND 10000) {_FIRST.format(key='doc_id')}")
