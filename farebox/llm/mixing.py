"""Mixing sources to target weights by weighted sampling without replacement.

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from farebox.llm.shared import WORD, Scratch, fresh, table

#: Weights of the sources in code point order (null last), repeated as needed.
WEIGHTS = (5, 2, 1)
#: The mix holds so many percent of all words, and at most so many times a source's own.
PERCENT, MOST = 150, 2
#: Documents that share a cell of the key grid, about: those of one cell per source are sorted.
CELL_ROWS = 2_000


def _size() -> Column:
    return F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")


def quality_weight() -> Column:
    """0.5 to 1: half, and half the share of the text's code points that are letters or white space."""
    text = F.coalesce(F.col("text"), F.lit(""))
    prose = F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    return 0.5 + 0.5 * (prose + 1.0) / (F.length(text) + 1.0)


def _key(weight: Column) -> Column:
    """Exponential key -ln(u) / weight with u in (0, 1) from the id's MD5: small keys come first."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(source, source_size, docs, target) from rows of source and size.

    The shares solve target = min(most * size, rate * weight) with the wanted sum:
    sources in the order of most * size / weight are capped as long as the rate
    that is left for the others exceeds that quotient. Its windows hold one row
    per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    # a constant partition: the table has one row per source
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("long")
    ranked = sums.withColumn("weight", weight)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    upto, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    capped, taken = F.coalesce(F.sum("source_size").over(upto), F.lit(0)), F.coalesce(F.sum("weight").over(upto), F.lit(0))
    rate = (F.sum("source_size").over(every) * percent / 100.0 - most * capped) / (F.sum("weight").over(every) - taken)
    # capped if the rate, with all before capped, is more than the source can give
    rated = ranked.withColumn("rate", rate).withColumn("capped", F.col("rate") * F.col("weight") >= most * F.col("source_size"))
    # the first that isn't capped sets the rate of all that follow
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("rate")))).over(every)
    target = F.when(F.col("capped"), most * F.col("source_size").cast("double")).otherwise(free["rate"] * F.col("weight"))
    return rated.select("source", "source_size", "docs", target.alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def sample_edges(rows: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """One row per source: target, whole epochs, and where its fractional selection ends.

    ``rows`` has doc_id, source, size and key. Within a source, documents in order
    of key are taken until the budget beyond the whole epochs is spent. The order is
    cut into cells; sums per cell show the one in which the budget ends, and only
    that one is sorted. The edge is the key, id and size of the document where it
    ends, and the words that this document (each of its equal rows) still gives.
    """
    targets = scratch.write(source_targets(rows, **options), "targets")
    targets = targets.withColumns(
        {
            "epochs": F.coalesce(F.floor(F.try_divide(F.round("target"), F.col("source_size"))), F.lit(0)).cast("long"),
            "cells": F.ceil(F.col("docs") / CELL_ROWS),
        }
    ).withColumn("budget", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    targets = scratch.write(targets.withColumnRenamed("source", "source_"), "budgets")
    placed = rows.where("size > 0").join(targets, _same("source", "source_")).withColumn(
        "cell", F.floor((1 - F.exp(-F.col("key"))) * F.col("cells"))
    )
    sums = placed.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    upto = Window.partitionBy("source").orderBy("cell")
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    cut = sums.where("before < budget and before + words >= budget").select(
        F.col("source").alias("cut_source"), F.col("cell").alias("cut_cell"), (F.col("budget") - F.col("before")).alias("left")
    )
    cut = scratch.write(cut, "cells")
    inside = placed.join(cut, _same("source", "cut_source") & (F.col("cell") == F.col("cut_cell")))
    same = inside.groupBy("source", "key", "doc_id", "size").agg(F.count("*").alias("rows"), F.first("left").alias("left"))
    line = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    same = same.withColumn("before", F.sum(F.col("size") * F.col("rows")).over(line) - F.col("size") * F.col("rows"))
    end = same.where("before < left and before + size * rows >= left").select(
        F.col("source").alias("end_source"),
        F.col("key").alias("end_key"),
        F.col("doc_id").alias("end_id"),
        F.col("size").alias("end_size"),
        F.floor((F.col("left") - F.col("before")) / F.col("rows")).alias("end_words"),
    )
    end = scratch.write(end, "ends")
    edges = targets.join(end, _same("source_", "end_source"), "left").select(
        "source_", "source_size", "target", "epochs", F.coalesce("end_key", F.lit(-1.0)).alias("end_key"), "end_id", "end_size", "end_words"
    )
    return scratch.write(edges, "edges")


def _extra() -> Column:
    """Words of the row that its source's fractional selection takes."""
    at, end = F.struct("key", "doc_id", "size"), F.struct("end_key", "end_id", "end_size")
    return F.when(at < end, F.col("size")).when(at.eqNullSafe(end), F.col("end_words")).otherwise(0)


def _rows(docs: DataFrame, weight: Column) -> DataFrame:
    return docs.withColumns({"size": _size(), "key": _key(weight)})


def mix(docs: DataFrame, weight: Column | None = None, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and taken.

    Each source gives its whole epochs first and then a sample drawn without
    replacement, in which a document's chance rises with ``weight`` (of columns of
    ``docs``; the default is ``quality_weight``). The document at the end of the
    budget gives its first words, so a source misses its rounded target by less
    than one word for each equal row at the end.

    Defined cases: a null or empty text has size 0 and gives nothing; a null source
    is a source, last in order; rows that agree in id, key and size are drawn
    together; a null id is an id; a source without words has target 0; extra
    columns are not read; texts of any length are counted whole; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    weight = quality_weight() if weight is None else weight
    rows = scratch.write(_rows(docs, weight).select("doc_id", "source", "size", "key"), "rows")
    edges = sample_edges(rows, scratch, **options)
    taken = F.col("epochs") * F.col("size") + _extra()
    return rows.join(edges, _same("source", "source_")).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: one row for each time a document is taken.

    The document at the end of a source's budget comes with its first words only,
    space-joined (n_chars follows, if there). Documents without words don't come. Columns of
    any names stay as they are; nulls, ties and empty tables are as in ``mix``.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    weight = quality_weight()
    rows = scratch.write(_rows(docs, weight).select("doc_id", "source", "size", "key"), "rows")
    edges = sample_edges(rows, scratch, **options)
    whole = fresh(docs, "whole")
    keyed = _rows(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), "doc_id", "source", "text"), weight)
    drawn = keyed.join(edges, _same("source", "source_")).withColumn("extra", _extra())
    full = F.array_repeat("size", (F.col("epochs") + (F.col("extra") == F.col("size")).cast("long")).cast("int"))
    part = F.when((F.col("extra") > 0) & (F.col("extra") < F.col("size")), F.array("extra")).otherwise(F.array().cast("array<bigint>"))
    drawn = drawn.where("size > 0").select(whole, "size", F.explode(F.concat(full, part)).alias("words"))
    text = F.col(f"{whole}.text")
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    cut = F.when(F.col("words") == F.col("size"), text).otherwise(first)
    out = drawn.select(whole, cut.alias("cut"))
    columns = []
    for c in docs.columns:
        value = F.col(f"{whole}.`{c}`")
        if c == "text":
            value = F.col("cut")
        elif c == "n_chars":
            value = F.when(F.col("cut") == text, value).otherwise(F.length("cut").cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return out.select(*columns)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         0.5::DOUBLE + 0.5::DOUBLE * (length(regexp_replace(coalesce(text, ''), '[^\p{L}\x20\x09-\x0D]+', '', 'g')) + 1.0::DOUBLE)
           / (length(coalesce(text, '')) + 1.0::DOUBLE) AS quality,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), o AS (
  SELECT *, (CAST(sum(source_size) OVER () * 150 AS DOUBLE) / 100 - CAST(2 * coalesce(sum(source_size) OVER earlier, 0) AS DOUBLE))
              / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS rate
  FROM w
  WINDOW earlier AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, rate * weight >= 2 * source_size AS capped FROM o
), f AS (
  SELECT rate AS free FROM c WHERE NOT capped ORDER BY source_size / weight, source IS NULL, source LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE (SELECT free FROM f) * weight END AS target
  FROM c
), b AS (
  SELECT *, coalesce(CAST(floor(round(target) / nullif(source_size, 0)) AS BIGINT), 0) AS epochs FROM t
), k AS (
  SELECT d.*, source_size, target, epochs, CAST(round(target) AS BIGINT) - epochs * source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / quality, doc_id NULLS FIRST, size, r) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - (upto - size))) AS BIGINT) AS taken
FROM k
"""


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
