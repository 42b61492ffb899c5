"""The operators on the given tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    collocations,
    decontaminate,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling,
    url_filter,
)
from .registry import query, table


def quality_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The quality labels that may be learned from."""
    usable = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    return table(spark, folder, "labels").where(usable).select("doc_id", F.col("quality").alias("label"))


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_OP1_SQL = r"""
WITH RECURSIVE rules(decision, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), tags AS (
  SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''>\s]+)', 1) AS href
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|''(?:[^''>]*\s)?canonical(?:\s[^''>]*)?''|canonical\b)[^>]*>')) AS tag
        FROM pages)
  UNION ALL
  SELECT url, regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[^>]*?\burl\s*=\s*["'']?([^"''>\s]+)', 1)
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')) AS tag
        FROM pages)
), links AS (
  SELECT DISTINCT url, CASE
    WHEN starts_with(href, '?') THEN regexp_extract(url, '^[^:]*://[^?#]*') || href
    WHEN contains(regexp_extract(href, '^[^?#]*'), '://') THEN href
    WHEN starts_with(href, '//') THEN regexp_extract(url, '^[^:]*') || ':' || href
    WHEN starts_with(href, '/') THEN regexp_extract(url, '^[^:]*://[^/?#]*') || href
    ELSE regexp_extract(url, '^[^:]*://[^/?#]*') || coalesce(nullif(regexp_extract(url, '://[^/?#]*([^?#]*/)', 1), ''), '/') || href
    END AS target
  FROM (SELECT url, regexp_replace(href, '(?i)&(?:amp|#38|#x26);', '&', 'g') AS href FROM tags)
  WHERE href <> '' AND href NOT LIKE '#%'
), rest AS (
  SELECT DISTINCT u, CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE '' END AS r
  FROM (SELECT url AS u FROM pages UNION SELECT target FROM links UNION SELECT url FROM links)
), urls AS (
  SELECT u, coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path,
    array_to_string(list_filter(string_split(regexp_extract(r, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: NOT regexp_matches(x, '^(utm_[^=&]*|gclid|fbclid)=')), '&') AS query
  FROM rest
), nodes AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE path WHEN '' THEN '/' ELSE plain END
    || CASE coalesce(query, '') WHEN '' THEN '' ELSE '?' || query END END AS node
  FROM (SELECT *, CASE WHEN NOT contains(path, '/.') THEN path ELSE
          list_reduce(list_concat([''], string_split(path, '/')[2:]), lambda way, step: CASE step WHEN '.' THEN way
            WHEN '..' THEN regexp_replace(way, '/[^/]*$', '') ELSE way || '/' || step END)
          || CASE WHEN regexp_matches(path, '/\.\.?$') THEN '/' ELSE '' END END AS plain FROM urls)
), fits AS (
  SELECT u, arg_max(decision, length(rhost || rpath)) AS decision, arg_max(rhost || rpath, length(rhost || rpath)) AS rule
  FROM nodes JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY u
), edges AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM links l JOIN nodes a ON a.u = l.url JOIN nodes b ON b.u = l.target
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
bad(node) AS (
  SELECT node FROM nodes JOIN fits USING (u) WHERE decision = 'block' AND node IS NOT NULL
  UNION
  SELECT b FROM bad JOIN both_ways ON bad.node = both_ways.a
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(decision, CASE WHEN node IN (SELECT node FROM bad) THEN 'block' END, 'allow') AS verdict
FROM pages LEFT JOIN nodes ON nodes.u = pages.url LEFT JOIN fits ON fits.u = pages.url
"""


@query("op1_url_filters", _OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_benchmark_passages")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digests(table(spark, folder, "documents"))


def packed_digests(documents: DataFrame) -> DataFrame:
    return packing.pack(documents).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op3_secret_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    base = F.filter("found", lambda x: x["kind"] != "random")

    def listed(spans) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


@query("op8_quality_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).drop("class_distance", "word_distance")


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """A row with a null doc_id has no remainder: it is predicted, but not learned from."""
    documents = table(spark, folder, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = language_id.fit(documents.select("doc_id", "text", "lang").where(remainder != 1))
    found = language_id.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score")


@query("op9_chat_format")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(table(spark, folder, "conversations"))


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


@query("op7_quality_votes")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_classifier.fit(documents, quality_labels(spark, folder))
    scored = quality_classifier.score(documents, model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


_OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, place, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), shared AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT l.*, s.key IS NOT NULL AS dropped FROM lines l LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", _OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM pieces WHERE len(words) > 0
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase
    FROM places, (SELECT unnest(range(1, 6)) AS size) WHERE place + size - 1 <= len(words))
  GROUP BY lang, size, phrase HAVING count(*) >= 100
), held AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, array_to_string(w[first:first + size - 1], ' ') AS part
    FROM (SELECT c.lang, c.f, string_split(phrase, ' ') AS w, s.size, unnest(range(1, c.size - s.size + 2)) AS first
          FROM counts c, (SELECT unnest(range(2, 5)) AS size) s WHERE c.size > s.size))
  GROUP BY lang, part
), candidates AS (
  SELECT c.* FROM counts c LEFT JOIN held h ON h.lang = c.lang AND h.part = c.phrase
  WHERE c.size >= 2 AND (h.f IS NULL OR 100 * h.f < 100 * c.f)
), cuts AS (
  SELECT lang, phrase, f, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS cut FROM candidates)
), scored AS (
  SELECT x.lang, x.phrase, x.f AS a, a.f AS l, b.f AS r, t.n, x.cut,
         ((1000::HUGEINT * x.f * t.n) // (a.f::HUGEINT * b.f))::BIGINT AS score
  FROM cuts x JOIN counts a ON a.lang = x.lang AND a.phrase = x.head
  JOIN counts b ON b.lang = x.lang AND b.phrase = x.tail JOIN totals t ON t.lang = x.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= 2000
"""


@query("op11_phrase_collocations", _OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.top_collocations(table(spark, folder, "documents"))


@query("op12_quartile_fingerprints")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, folder, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
