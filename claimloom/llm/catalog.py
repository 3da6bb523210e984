"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import aligned, audited, backoff, bagminhash, bpe, caps, decontaminate, kdshards, licenses, lid, packing, pii, warc
from claimloom.llm.common import Stored, dropped, read
from claimloom.session import fresh_path


def vocabulary() -> str:
    """Where the public byte-level vocabulary lies; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.known(spark))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lid.fit(docs.where(~lid.held_out(F.col("doc_id"))))
    return lid.predict(docs, model).select("doc_id", lid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.links(read(spark, sf_dir, "embeddings"))


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(read(spark, sf_dir, "documents"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshards.assigned(read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.found(docs, pii.fit(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(read(spark, sf_dir, "documents"))


def op9_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(read(spark, sf_dir, "documents"), vocabulary(), ids=False)


def op11_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
    return aligned.aligned(read(spark, sf_dir, "documents"), *files, groups=False)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited.audited(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "archives")
    result = Stored(warc.pages(warc.chunks(warc.write(read(spark, sf_dir, "pages"), folder), data=False)), "pages").df
    dropped(spark, folder)
    return result


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_language_id": op2_language_id,
    "op3_spherical_caps": op3_spherical_caps,
    "op4_stupid_backoff": op4_stupid_backoff,
    "op5_kd_shards": op5_kd_shards,
    "op6_personal_data": op6_personal_data,
    "op7_decontaminate": op7_decontaminate,
    "op8_bagminhash": op8_bagminhash,
    "op9_packed_ids": op9_packed_ids,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_aligned_tokens": op11_aligned_tokens,
    "op12_filter_audit": op12_filter_audit,
    "op13_warc": op13_warc,
}

#: Runs of letters, digits and combining marks, lower-cased, as ``words`` has them.
WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}\\p{M}]+')"



def _canonical_sql(text: str) -> str:
    t = f"replace(replace(lower(coalesce({text}, '')), '(c)', ' copyright '), '©', ' copyright ')"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g')"
    t = f"' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' '"
    for written, read_as in licenses.EQUIVALENT:
        t = f"replace({t}, ' {written} ', ' {read_as} ')"
    lines = f"list_transform(string_split({t}, chr(10)), lambda x: replace(trim(x), '  ', ' '))"
    named = f"regexp_matches(x, '{licenses.DATED}') OR (regexp_matches(x, '{licenses.SHORT_LINE}') AND NOT regexp_matches(x, '{licenses.IN_TEXT}'))"
    holder = f"({named} OR x LIKE 'spdx %' OR x = 'all rights reserved')"
    return f"list_filter({lines}, lambda x: x <> '' AND NOT {holder})"


_KNOWN_SQL = ", ".join("('{}', '{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in licenses.KNOWN)

ORACLE: dict[str, str] = {
    "op1_licenses": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_canonical_sql("text")} AS l FROM documents),
known AS (SELECT name, unit, {_canonical_sql("text")} AS l FROM (VALUES {_KNOWN_SQL}) v(name, unit, text)),
k AS (SELECT unit, digest, min(name) AS name FROM (
  SELECT name, unit, md5(array_to_string(l, ' ')) AS digest FROM known WHERE unit = 'text'
  UNION ALL SELECT name, unit, md5(unnest(l)) FROM known WHERE unit = 'line') GROUP BY ALL),
n AS (SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names
  FROM (SELECT r, md5(unnest(l)) AS digest FROM d) JOIN (SELECT * FROM k WHERE unit = 'line') USING (digest) GROUP BY r)
SELECT doc_id, CASE WHEN len(l) > 0 THEN md5(array_to_string(l, ' ')) END AS text_digest, k.name AS license,
  coalesce(n.n, 0) AS n_notices, coalesce(n.names, '') AS notices
FROM d LEFT JOIN n USING (r) LEFT JOIN k ON k.unit = 'text' AND len(l) > 0 AND k.digest = md5(array_to_string(l, ' '))""",
    "op4_stupid_backoff": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM d),
g AS (SELECT r, i, w[i] AS one, CASE WHEN i > 1 THEN w[i-1] || ' ' || w[i] END AS two,
  CASE WHEN i > 2 THEN w[i-2] || ' ' || w[i-1] || ' ' || w[i] END AS three FROM p),
c1 AS (SELECT one, r, count(*) AS own, sum(count(*)) OVER (PARTITION BY one) - count(*) AS rest FROM g GROUP BY one, r),
c2 AS (SELECT two, r, sum(count(*)) OVER (PARTITION BY two) - count(*) AS rest FROM g WHERE two IS NOT NULL GROUP BY two, r),
c3 AS (SELECT three, r, sum(count(*)) OVER (PARTITION BY three) - count(*) AS rest FROM g WHERE three IS NOT NULL GROUP BY three, r),
n AS (SELECT r, len(w) AS n_words, greatest(1, sum(len(w)) OVER () - len(w)) AS others FROM d),
j AS (SELECT g.r, g.i, c1.rest AS r1, coalesce(c2.rest, 0) AS r2, coalesce(c3.rest, 0) AS r3, others FROM g
  JOIN c1 ON c1.one = g.one AND c1.r = g.r LEFT JOIN c2 ON c2.two = g.two AND c2.r = g.r LEFT JOIN c3 ON c3.three = g.three AND c3.r = g.r
  JOIN n ON n.r = g.r),
k AS (SELECT *, lag(r1) OVER o AS b1, lag(r2) OVER o AS b2,
  CASE WHEN r3 > 0 THEN 3 WHEN r2 > 0 THEN 2 WHEN r1 > 0 THEN 1 ELSE 0 END AS level FROM j WINDOW o AS (PARTITION BY r ORDER BY i)),
s AS (SELECT r, level, CASE level WHEN 3 THEN ln(r3 / b2) WHEN 2 THEN ln(r2 / b1) + ln(0.4) WHEN 1 THEN ln(r1 / others) + 2 * ln(0.4)
  ELSE ln(1 / others) + 2 * ln(0.4) END AS score FROM k),
a AS (SELECT r, count(*) FILTER (level = 3) AS n_three, count(*) FILTER (level = 2) AS n_two, count(*) FILTER (level = 1) AS n_one,
  count(*) FILTER (level = 0) AS n_new, sum(score) AS score FROM s GROUP BY r)
SELECT doc_id, n_words, coalesce(n_three, 0) AS n_three, coalesce(n_two, 0) AS n_two, coalesce(n_one, 0) AS n_one, coalesce(n_new, 0) AS n_new,
  round(coalesce(score, 0), 4) AS log_score, round(score / n_words, 6) AS mean_log_score
FROM d JOIN n USING (r) LEFT JOIN a USING (r)""",
    "op12_filter_audit": """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
b AS (SELECT part, good, toxic, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > first THEN 16 ELSE 0 END AS cell
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, cell, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM b GROUP BY part, cell),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
o AS (SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM f p, f q, f r, f s, f t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND p.bit | q.bit | r.bit | s.bit | t.bit = 31),
k AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) x(step)),
m AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (cell & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (cell & before > 0 AND cell & bit > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (cell = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (cell & before = 0 AND cell & bit > 0), 0)::BIGINT AS toxic_lost
  FROM c, k GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM m""",
    "op13_warc": """
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM (SELECT page_id, h, first, coalesce(strlen(h) >= 100 AND first IS NOT NULL AND (page_id IS NULL OR page_id > first), false) AS again
  FROM (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)))""",
}
