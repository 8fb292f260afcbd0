"""The text operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
GROUP_WIDTH, GROUP_PERCENT = 3, 85


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target, all others the background."""
    from headway.llm.lmscore import cross_entropy_difference

    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), GROUP_WIDTH, GROUP_PERCENT)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.secret_scan import secret_scan

    return secret_scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.langid import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.repeats import repeated_bytes

    return repeated_bytes(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.page_text import html_extract

    return html_extract(table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from headway.llm.bpe import byte_bpe

    return byte_bpe(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("score", 6).alias("score"), "question_overlap", "answer_overlap")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.whiten import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


def op13_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from headway.llm.lz_print import phrase_fingerprints

    return phrase_fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lm_scoring, op2_minhash_dedup, op3_secret_scan, op4_language_id, op5_suffix_dedup, op6_html_extract, op7_byte_bpe,
    op8_toxicity, op9_decontaminate, op10_quality_rules, op11_filter_audit, op12_whitening, op13_phrase_fingerprints)}

#: White space of the contracts as a DuckDB pattern.
_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = "list_filter(string_split_regex({0}, '" + _SPACE + "'), lambda x: x <> '')"

OP2_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {GROUP_WIDTH} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS s
  FROM words),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= {GROUP_PERCENT} * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other),
components AS (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""


def _op10_sql() -> str:
    from headway.llm import quality as q

    literal = lambda x: "'" + x.replace("'", "''") + "'"
    boilerplate = " OR ".join(f"contains(lower(x), {literal(p)})" for p in q.BOILERPLATE)
    ends = ", ".join(map(literal, q.END_MARKS))
    count = lambda m: f"(length(x) - length(replace(x, {literal(m)}, '')))"
    separators = " + ".join(f"greatest({count(m)} - {count(q.COUNTERPARTS[m]) if m in q.COUNTERPARTS else 0}, 0)" for m in q.SEPARATORS)
    symbols = lambda x: f"(length({x}) - length(regexp_replace({x}, '[{q.SYMBOLS}]', '', 'g')))"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, t, {_WORDS.format("t")} AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {literal(q.WORD_LINE)})) AS lines FROM texts),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s
  FROM parts WHERE len(w) >= 3),
repeated AS (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (
  SELECT doc_id, COUNT(DISTINCT place) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS place FROM repeated) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {symbols("t")} AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(array_to_string(lines, '')) AS all_chars,
    list_filter(lines, lambda x: right(rtrim(x, {literal(q.CLOSERS)}), 1) IN ({ends})
      AND NOT {symbols("x")} * 100 > length(x) * {q.MAX_SYMBOL_PERCENT}
      AND NOT ({separators} >= {q.MENU_SEPARATORS} AND ({separators}) * {q.MENU_WORDS} >= len({_WORDS.format("x").replace("lambda x: x", "lambda y: y")}))
      AND NOT (contains(x, '!!') AND x = upper(x)) AND NOT ({boilerplate})) AS good
  FROM parts LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    length(array_to_string(good, '')) AS left_chars FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND left_chars * 100 >= all_chars * {q.MIN_LEFT_PERCENT} AS kept, n_lines, len(good) AS n_good_lines, left_chars
FROM judged"""


def _op11_sql() -> str:
    from headway.llm import filter_audit as a

    bits = range(len(a.LETTERS))
    letters = ", ".join(f"('{a.LETTERS[i]}', {1 << i})" for i in bits)
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
firsts AS (SELECT t, MIN(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, CASE WHEN len(w) < {a.MIN_WORDS} THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < {a.MIN_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {a.MAX_UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '{a.SYMBOLS}') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM masks GROUP BY part, mask),
letters(letter, bit) AS (VALUES {letters}),
orders(filter_order, applied) AS (
  SELECT '', 0 UNION ALL SELECT filter_order || letter, applied | bit FROM orders, letters WHERE applied & bit = 0),
steps AS (
  SELECT filter_order, step, bit, list_sum(list_transform(range(1, step), lambda i:
      1 << (strpos('{a.LETTERS}', substr(filter_order, i, 1)) - 1)))::INT AS before
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders WHERE length(filter_order) = 5)
  JOIN letters ON letter = substr(filter_order, step, 1)),
counted AS (
  SELECT part, filter_order, step, bit,
    SUM(CASE WHEN mask & (coalesce(before, 0) | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    SUM(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    SUM(CASE WHEN mask & coalesce(before, 0) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    SUM(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    SUM(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    SUM(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (SUM(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted"""


ORACLES: dict[str, str] = {"op2_minhash_dedup": OP2_SQL, "op10_quality_rules": _op10_sql(), "op11_filter_audit": _op11_sql()}
