"""Profiles of the text corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import money
from tallyloom.functions import text as T
from tallyloom.operators import pii, profile, suggest
from tallyloom.plans import query
from tallyloom.sources.tables import spread, table

USUAL = "[\\p{L}\\p{N}.,;:!?+*/%()\\[\\]{}<>_=|&@#$₹€£''\"\\\\-]"
PROFILE_SQL = f"""
base AS (
  SELECT doc_id, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s, regexp_replace(text, '\\s', '', 'g') AS solid, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS n_words FROM documents
), measured AS (
  SELECT *, length(text) AS n_chars, len(list_filter(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s', '', 'g')) <> '')) AS n_lines,
    CASE WHEN length(solid) = 0 THEN 0.0 ELSE length(regexp_replace(solid, '{USUAL}', '', 'g'))::DOUBLE / length(solid) END AS symbol_ratio,
    CASE WHEN length(solid) = 0 THEN 0.0 ELSE length(regexp_replace(solid, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(solid) END AS alpha_ratio,
    greatest(len(regexp_extract_all(text, '(?i)---\\s*PAGE\\s*\\d+\\s*---')) + len(regexp_extract_all(text, '(?i)===\\s*PAGE\\s*\\d+\\s*===')) + len(regexp_extract_all(text, '(?i)\\[\\s*PAGE\\s*\\d+\\s*\\]')) + len(regexp_extract_all(text, '(?i)PAGE\\s+\\d+')), CASE WHEN s <> '' THEN 1 ELSE 0 END) AS n_pages FROM base)"""


@query(f"WITH {PROFILE_SQL} SELECT doc_id, n_chars::INT AS n_chars, n_words::INT AS n_words, n_lines::INT AS n_lines, n_pages::INT AS n_pages, symbol_ratio, alpha_ratio FROM measured")
def q_doc_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.document_profile(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text").drop("status", "warnings")


#: a character eight times in a row has no back-reference in the other engine's patterns, so each distinct character is looked for
WARN_SQL = """
warned AS (
  SELECT *, CASE WHEN s = '' THEN 'EMPTY' WHEN length(s) < 100 THEN 'VERY_SHORT' ELSE coalesce(array_to_string(list_filter([
    CASE WHEN symbol_ratio >= 0.35 THEN 'HIGH_SYMBOL_RATIO' END, CASE WHEN alpha_ratio < 0.15 THEN 'LOW_ALPHABETIC_RATIO' END,
    CASE WHEN len(list_filter(list_distinct(string_split(s, '')), lambda c: c NOT IN (chr(10), chr(13)) AND contains(s, repeat(c, 8)))) > 0 THEN 'REPEATED_CHARACTER' END,
    CASE WHEN n_words > 100 AND len(list_filter(regexp_extract_all(s, '[\\p{L}\\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Za-z]'))) / n_words > 0.25 THEN 'HIGH_SINGLE_CHARACTER_RATIO' END], lambda x: x IS NOT NULL), '; '), '') END AS ocr FROM measured
), coded AS (
  SELECT *, CASE WHEN s = '' THEN ['EMPTY_DOCUMENT'] ELSE list_filter([CASE WHEN length(s) < 100 THEN 'VERY_SHORT' END, CASE WHEN n_words < 20 THEN 'VERY_FEW_WORDS' END, CASE WHEN length(text) > 500000 THEN 'VERY_LARGE' END,
    CASE WHEN contains(text, chr(0)) THEN 'NULL_CHARACTER' END, CASE WHEN regexp_matches(text, '\\n\\s*\\n\\s*\\n\\s*\\n') THEN 'EXCESSIVE_BLANK_LINES' END, CASE WHEN ocr <> '' THEN 'OCR_WARNING:' || ocr END], lambda x: x IS NOT NULL) END AS codes FROM warned)"""


@query(f"WITH {PROFILE_SQL}, {WARN_SQL} SELECT doc_id, ocr FROM warned")
def q_ocr_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select("doc_id", T.ocr_warning(F.col("text")).alias("ocr"))


@query(f"WITH {PROFILE_SQL}, {WARN_SQL} SELECT doc_id, CASE WHEN s = '' THEN 'EMPTY' WHEN len(codes) > 0 THEN 'WARNING' ELSE 'OK' END AS status, array_to_string(codes, '; ') AS warnings FROM coded")
def q_doc_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return spread(table(spark, sf_dir, "documents")).select("doc_id", T.document_status(text).alias("status"), F.array_join(T.suspicious(text), "; ").alias("warnings"))


@query("""WITH k AS (SELECT doc_id, md5(replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(13) || chr(10), chr(10))) AS content_md5 FROM documents WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '')
SELECT * FROM (SELECT content_md5, doc_id, count(*) OVER (PARTITION BY content_md5) AS group_size FROM k) WHERE group_size > 1""")
def q_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"""WITH {PROFILE_SQL} SELECT 'n_chars' AS measure, sum(n_chars)::DOUBLE AS total, avg(n_chars) AS mean, median(n_chars)::DOUBLE AS median, min(n_chars)::DOUBLE AS least, max(n_chars)::DOUBLE AS greatest FROM measured
UNION ALL SELECT 'n_words', sum(n_words)::DOUBLE, avg(n_words), median(n_words)::DOUBLE, min(n_words)::DOUBLE, max(n_words)::DOUBLE FROM measured""")
def q_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.length("text").alias("n_chars"), T.word_count(F.col("text")).alias("n_words"))
    return profile.corpus_statistics(docs, ["n_chars", "n_words"])


@query(f"WITH {PROFILE_SQL}, {WARN_SQL} SELECT trim(code) AS code, count(*) AS n FROM (SELECT unnest(string_split(array_to_string(codes, ';'), ';')) AS code FROM coded) WHERE trim(code) <> '' GROUP BY 1")
def q_warning_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.array_join(T.suspicious(F.col("text")), ";").alias("warnings"))
    return profile.histogram(rows, "warnings")


@query("""SELECT doc_id, CASE WHEN contains(u, 'INR') OR contains(u, 'RS.') OR contains(u, 'RS ') OR contains(u, '₹') THEN 'INR' WHEN contains(u, 'USD') OR contains(u, '$') THEN 'USD' WHEN contains(u, 'EUR') OR contains(u, '€') THEN 'EUR' WHEN contains(u, 'GBP') OR contains(u, '£') THEN 'GBP' ELSE '' END AS currency
FROM (SELECT doc_id, upper(text) AS u FROM documents)""")
def q_doc_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", money.document_currency(F.col("text")).alias("currency"))


STOP = ["THE", "AND", "FOR", "WITH"]


@query("""WITH w AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z\\-]{2,}'), lambda x: upper(x)), lambda x: x NOT IN ('THE', 'AND', 'FOR', 'WITH')) AS w FROM documents),
p AS (SELECT doc_id, unnest(list_distinct(list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS phrase FROM w)
SELECT phrase, count(*) AS n_rows FROM p GROUP BY phrase ORDER BY n_rows DESC, phrase LIMIT 60""")
def q_ngram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggest.phrase_frequencies(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "text", STOP)


@query("""SELECT conv_id, turn, line_no, line FROM (SELECT conv_id, turn, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ls FROM conversations))""")
def q_line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.filter(F.transform(F.split("text", "\n"), T.strip), lambda x: x != "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(lines).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[EMAIL]', 'g'), '\\b\\d{2}[A-Z]{5}\\d{4}[A-Z][A-Z0-9]Z[A-Z0-9]\\b', '[REG_ID]', 'g'), '\\+?\\d[\\d -]{8,}\\d', '[PHONE]', 'g'), '\\b\\d{1,3}(?:,\\d{2,3})+(?:\\.\\d{1,2})?\\b', '[AMOUNT]', 'g') AS text FROM documents""")
def q_pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", pii.mask(F.col("text")).alias("text"))


@query("""WITH RECURSIVE links AS (SELECT p_partkey AS alias, p_partkey // 2 AS canonical FROM part WHERE p_partkey > 1),
walk AS (SELECT alias, canonical FROM links UNION ALL SELECT w.alias, l.canonical FROM walk w JOIN links l ON w.canonical = l.alias)
SELECT alias, min(canonical) AS canonical FROM walk GROUP BY alias""")
def q_alias_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "part").where("p_partkey > 1").select(F.col("p_partkey").alias("alias"), F.floor(F.col("p_partkey") / 2).alias("canonical"))
    return suggest.follow_chains(links)


@query()
def q_alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of part names, some abbreviated, plural or in other case; sequence similarity has no SQL form."""
    k = F.col("p_partkey") % 7
    name = F.upper("p_name")
    text = F.when(k == 0, F.concat(name, F.lit("S"))).when(k == 1, F.regexp_replace(name, r"^(\w{3})\w*", "$1")).when(k == 2, F.replace(name, F.lit(" "), F.lit("-"))).otherwise(name)
    return suggest.alias_pairs(suggest.ranked_spellings(table(spark, sf_dir, "part").select(text.alias("s")), "s"))
