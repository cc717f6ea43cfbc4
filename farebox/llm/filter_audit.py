"""How five filters act on a corpus in each of their 120 orders: what each removes, and what it would have."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.shared import table

#: Fixed values of the filters: words at least, per cent of different words at least and of capitals at most.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
LETTERS = "ABCDE"
#: All orders in which the filters can stand, and the steps of one.
ORDERS = ["".join(p) for p in permutations(LETTERS)]
STEPS = len(LETTERS)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, part, sha (of the text) and failed, the letters among A to D of the filters that a text fails."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split("text", BLANKS), "")
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    read = read.select("doc_id", "part", "text", words.alias("words"))
    fails = {
        "A": F.size("words") < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct("words")).cast("long") < MIN_DISTINCT * F.size("words").cast("long"),
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > MAX_CAPITALS * F.length("text").cast("long"),
        "D": F.col("text").rlike(SYMBOLS),
    }
    failed = F.concat(*[F.when(fails[f], F.lit(f)).otherwise(F.lit("")) for f in "ABCD"])
    return read.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), failed.alias("failed"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and set of failed filters (``failed``, as letters): n, good and toxic documents.

    Texts stay where they are read: only their digests move. E needs the smallest
    id of each text, so documents are counted by text and part first; a text with
    a third of all rows is a few rows per task by then.
    """
    rows = _verdicts(docs).groupBy("doc_id", "part", "sha", "failed").agg(F.count("*").alias("n"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    classes = rows.join(marks, "doc_id", "left").groupBy("sha", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("low"),
        F.min_by("n", "doc_id").alias("n_low"),
        F.sum(F.when(F.isnull("doc_id"), F.col("n")).otherwise(0)).alias("n_null"),
    )
    first = F.min("low").over(Window.partitionBy("sha"))
    firsts = F.col("n_null") + F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    classes = classes.withColumn("first", first).withColumn("firsts", firsts)
    either = F.array(
        F.struct(F.col("failed"), F.col("firsts").alias("n")),
        F.struct(F.concat("failed", F.lit("E")).alias("failed"), (F.col("n") - F.col("firsts")).alias("n")),
    )
    cells = classes.select("part", "good", "toxic", F.inline(either)).where("n > 0")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return cells.groupBy("part", "failed").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _fold(cell: Column, order: Column) -> Column:
    """The steps of one order for the documents of one cell, as weighted structs."""

    def step(state: Column, k: Column) -> Column:
        fails = F.contains(cell["failed"], F.substring(order, k, F.lit(1)))
        alone = F.length(cell["failed"]) == 1
        weigh = lambda when, weight: F.when(when, cell[weight]).otherwise(F.lit(0).cast("long"))
        here, gone = ~state["gone"] & fails, state["gone"]
        counts = (
            weigh(~gone & ~fails, "n"), weigh(here, "n"), weigh(gone & fails, "n"),
            weigh(fails & alone, "n"), weigh(here, "good"), weigh(here, "toxic"),
        )
        entry = F.struct(*[c.alias(name) for name, c in zip(COUNTS, counts, strict=True)])
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(entry)).alias("steps"))

    entries = "array<struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(entries).alias("steps"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda state: state["steps"])


def _add(a: Column, b: Column) -> Column:
    return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])


def audit_cells(cells: DataFrame) -> DataFrame:
    """The audit of mask cells: 600 rows per part.

    The array of orders is a literal, so it reaches all tasks. Each cell folds
    across it to 600 weighted structs; those of a part's cells, at most 32,
    are merged by elementwise sums.
    """
    orders = F.array(*[F.lit(o) for o in ORDERS])
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    zeros = F.array_repeat(zero, len(ORDERS) * STEPS)
    weighted = lambda cell: F.flatten(F.transform(orders, lambda order: _fold(cell, order)))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    merged = parts.select(
        "part", F.aggregate("cells", zeros, lambda total, cell: F.zip_with(total, weighted(cell), _add)).alias("entries")
    )
    rows = merged.select("part", F.posexplode("entries").alias("at", "entry"))
    order = F.element_at(orders, F.floor(F.col("at") / STEPS).cast("int") + 1)
    rows = rows.select("part", order.alias("filter_order"), (F.col("at") % STEPS + 1).alias("step"), "entry.*")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    shapley = F.sum("removed").over(Window.partitionBy("part", letter))
    return rows.select("part", "filter_order", "step", *COUNTS, shapley.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter keeps and removes at each step of each order, per part (source).

    A document fails A with under 200 words, B if under half its words differ, C if over 2 % of
    its code points are A-Z, D if it holds one of ``#$%&*|``, E if a smaller doc_id
    has the same text. Columns: part, filter_order, step, then the numbers of
    documents kept after the step, removed in it, redundant (failing its filter but
    gone), unique_fails (failing no other filter), good_lost and toxic_lost, and
    shapley (removed by this filter over all orders).

    Defined cases: a null text is empty, a null source the empty part. A null
    doc_id is no smaller or larger than another, so it never fails E and has no
    label. Rows with equal doc_id and text are documents each, and none fails E
    for another. An id with several labels counts as good or toxic if one of them says
    so; a null label says nothing. Texts of any length are read whole. Columns beside
    doc_id, text and source are not read. No documents give no rows.
    """
    return audit_cells(mask_cells(docs, labels))


def _oracle() -> str:

    orders = ", ".join(f"('{o}')" for o in ORDERS)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d
), lows AS (
  SELECT text, min(doc_id) AS low FROM d GROUP BY text
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT w.part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < {MIN_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(w.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(w.text, '{SYMBOLS}') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > low THEN 'E' ELSE '' END AS failed
  FROM w JOIN lows USING (text) LEFT JOIN marks ON w.doc_id = marks.doc_id
), cells AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f GROUP BY part, failed
), runs AS (
  SELECT part, failed, n, good, toxic, filter_order, step, substr(filter_order, step, 1) AS letter,
         contains(failed, substr(filter_order, step, 1)) AS fails,
         len(regexp_replace(substr(filter_order, 1, step - 1), '[^' || failed || '#]', '', 'g')) > 0 AS gone
  FROM cells, (VALUES {orders}) AS o(filter_order), (VALUES (1), (2), (3), (4), (5)) AS s(step)
), audit AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM runs GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM audit
"""


ORACLE = _oracle()


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
