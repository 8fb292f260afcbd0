"""Filter interaction audit: what each filter removes, keeps and duplicates under every order of five filters.

Every document becomes a mask of the filters it fails, and masks are counted per
part of the corpus, so that a part is at most 32 masks (64 with their label
counts folded in). A recursive CTE then enumerates the orders: it extends a
prefix of filters by every letter not used yet, joins the mask cells of the
part, carries the bits applied so far, and each level of the recursion emits the
counts of its step. A step depends on the prefix alone, so 325 prefixes per part
serve all 120 orders.

Defined results: a null text counts as empty; a null source is the part "";
a document without words fails A only; a null ``doc_id`` never fails E and has no
label; rows that repeat a ``doc_id`` and its text do not fail E because of each
other; of several labels of a document one that says 1 counts; other columns are
never read; no documents, no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored
from headway.llm.quality import words

LETTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = "[#$%&*|]"
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column, parts: Column) -> Column:
    """Bits of the filters that a text alone decides: A 1, B 2, C 4, D 8."""
    n = F.size(parts)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (n < MIN_WORDS, F.size(F.array_distinct(parts)) * 100 < n * MIN_DISTINCT_PERCENT,
             upper * 100 > F.length(text) * MAX_UPPER_PERCENT, text.rlike(SYMBOLS))
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """One small row per document: part, mask of A to D, and a digest that stands for the text."""
    df = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("t"))
    return df.withColumn("w", words(F.col("t"))).select(
        "doc_id", "part", text_mask(F.col("t"), F.col("w")).alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones per part and mask.

    E needs the smallest id of each text: copies are reduced to it before the shuffle, and a document is asked by its
    digest and id together, so no key is as large as a group of copies.
    """
    rows = stored(measured(docs), "filter_masks")
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    late = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(late, 16).otherwise(0)).alias("mask")).join(marks, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


#: Cells of a part are an array of (mask, n, good, toxic); a step counts what its letter meets after the applied bits.
_COUNT = "aggregate(filter(c.cells, x -> {0}), 0L, (total, x) -> total + x.{1})"
_STEPS = f"""
WITH RECURSIVE letters AS (SELECT substr('{LETTERS}', i, 1) AS letter, CAST(shiftleft(1, i - 1) AS INT) AS bit
  FROM (SELECT explode(sequence(1, {len(LETTERS)})) AS i)),
steps (part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, CAST('' AS STRING), 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.prefix, l.letter), s.applied | l.bit, s.step + 1,
    {_COUNT.format("x.mask & (s.applied | l.bit) = 0", "n")}, {_COUNT.format("x.mask & s.applied = 0 AND x.mask & l.bit <> 0", "n")},
    {_COUNT.format("x.mask & s.applied <> 0 AND x.mask & l.bit <> 0", "n")}, {_COUNT.format("x.mask = l.bit", "n")},
    {_COUNT.format("x.mask & s.applied = 0 AND x.mask & l.bit <> 0", "good")}, {_COUNT.format("x.mask & s.applied = 0 AND x.mask & l.bit <> 0", "toxic")}
  FROM steps s JOIN {{cells}} c ON s.part = c.part JOIN letters l ON s.applied & l.bit = 0
  WHERE s.step < {len(LETTERS)})
SELECT * FROM steps WHERE step > 0"""


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; ``shapley`` sums what the step's filter removes over all orders."""
    spark = docs.sparkSession
    cells = mask_cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    cells = stored(cells, "filter_cells")  # read at every level of the recursion
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # else many parts would end the enumeration
    steps = stored(spark.sql(_STEPS.format(cells="{cells}"), cells=cells), "filter_steps")
    letter = F.substring("prefix", -1, 1)
    # a prefix of k letters is shared by the orders of the letters left
    sharing = F.element_at(F.array(*[F.lit(factorial(len(LETTERS) - k)) for k in range(1, len(LETTERS) + 1)]), F.col("step"))
    shapley = steps.groupBy("part", letter.alias("letter")).agg(F.sum(F.col("removed") * sharing).alias("shapley"))
    orders = spark.createDataFrame(
        [(order, order[:k]) for order in map("".join, permutations(LETTERS)) for k in range(1, len(LETTERS) + 1)],
        "filter_order STRING, prefix STRING")
    # 600 rows, whatever the input
    return steps.join(F.broadcast(orders), "prefix").withColumn("letter", letter).join(shapley, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), *METRICS, "shapley")
