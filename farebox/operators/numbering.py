"""Dense ids 1..N without a global sort and without a single-task window.

All ways number rows by where they lie in files, which is the same however often a
task is repeated and however the scan is split.

``number_rows`` is lazy: it works on rows that carry their source position. Where the
positions of the kept rows are known to differ and few enough to broadcast as bitmaps, a
row's id is the number of bits before its own, and the rows stay where they are. Else
they are shuffled once, in blocks of bounded size. ``number_written`` works on rows that
were written out: the row index in each file is already dense, so ids need only a
per-file offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from farebox.schemas import POSITION

BLOCK_ROWS = 1 << 18
BROADCAST_BYTES = 256 * 1024 * 1024
#: Source rows of a bitmap word, and words of a block: 64 of 64, as powers of two.
WORD_SHIFT, BLOCK_SHIFT = 6, 6
BLOCK_WORDS = 1 << BLOCK_SHIFT
#: Bytes that the bitmaps take for a source row, at most: 8 + 4 in 64 and the overhead of a hashed row in 4096.
BITMAP_BYTES_PER_ROW = 1 / 4


def _running_total_before(count: str, window) -> Column:
    """Sum of ``count`` over the rows before the current one in ``window``."""
    before = F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0).cast("bigint"))


def number_rows(
    rows: DataFrame,
    name: str,
    counted: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    source_rows: int | None = None,
) -> DataFrame:
    """Add ``name``, the 1-based rank of each row in source order, and drop the position.

    A block is a run of ``block_rows`` source rows of one file, so no group can
    grow with the data or with a repeated value. Offsets come from counts per
    block (one narrow pass, partially aggregated): within a file over its blocks,
    and over files from one total per file, a list the driver holds anyway.

    ``counted`` may be any frame with the same rows as ``rows``, to count without
    steps that only add columns. ``source_rows`` states how many rows the source files
    have (their footers tell) and that no position repeats in ``rows``: the kept rows
    are then broadcast as bitmaps, if those of so many rows are within the bound.
    """
    file, row = POSITION
    counted = rows if counted is None else counted
    columns = [c for c in rows.columns if c not in POSITION]
    if source_rows is not None and source_rows * BITMAP_BYTES_PER_ROW <= BROADCAST_BYTES:
        return _number_by_bitmaps(rows, name, counted, columns)
    block = F.floor(F.col(row) / block_rows).cast("bigint").alias("_block")
    blocks = counted.groupBy(file, block).agg(F.count(F.lit(1)).alias("_n"))
    files = blocks.groupBy(file).agg(F.sum("_n").alias("_file_n"))
    file_starts = files.select(file, _running_total_before("_file_n", Window.orderBy(file)).alias("_file_start"))
    in_file = Window.partitionBy(file).orderBy("_block")
    starts = blocks.withColumn("_block_start", _running_total_before("_n", in_file)).join(file_starts, file)
    starts = starts.select(file, "_block", (F.col("_file_start") + F.col("_block_start")).alias("_start"))

    # The window's partitioning and order also serve the join: one shuffle, one sort.
    in_block = Window.partitionBy(file, "_block").orderBy(row)
    ranked = rows.withColumn("_block", block).withColumn("_rank", F.row_number().over(in_block))
    return ranked.join(starts, [file, "_block"]).select((F.col("_start") + F.col("_rank")).alias(name), *columns)


def _number_by_bitmaps(rows: DataFrame, name: str, counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ids from a broadcast of the kept rows: per block of source rows, words of bits and the bits before each word."""
    file, row = POSITION
    at = lambda c: F.col(c).cast("bigint")
    word = F.shiftright(at(row), WORD_SHIFT)
    bit = F.expr(f"shiftleft(1L, cast({row} & {(1 << WORD_SHIFT) - 1} as int))")
    words = counted.groupBy(file, word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    block = F.shiftright("_word", BLOCK_SHIFT).alias("_block")
    place = F.col("_word").bitwiseAND(BLOCK_WORDS - 1).cast("int").alias("at")
    blocks = words.groupBy(file, block).agg(
        F.map_from_entries(F.collect_list(F.struct(place, F.col("_bits").alias("bits")))).alias("_by_word"),
        F.sum(F.bit_count("_bits")).alias("_n"),
    )
    every = F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1))
    blocks = blocks.withColumn("_words", F.transform(every, lambda i: F.coalesce(F.col("_by_word")[i], F.lit(0).cast("bigint"))))
    before = lambda i: F.aggregate(F.slice("_words", 1, i), F.lit(0), lambda n, w: n + F.bit_count(w))
    # all blocks are broadcast in a moment, so one task may as well order them
    start = _running_total_before("_n", Window.orderBy(file, "_block"))
    ranks = blocks.select(F.col(file).alias("_file"), "_block", start.alias("_start"), "_words", F.transform(every, before).alias("_before"))
    mine = F.shiftright(at(row), WORD_SHIFT).bitwiseAND(BLOCK_WORDS - 1).cast("int")
    below = F.expr(f"_words[_at] & ~shiftleft(-1L, cast({row} & {(1 << WORD_SHIFT) - 1} as int))")
    placed = rows.withColumn("_at", mine)
    same = (F.col(file) == F.col("_file")) & (F.shiftright(at(row), WORD_SHIFT + BLOCK_SHIFT) == F.col("_block"))
    ranked = placed.join(F.broadcast(ranks), same)
    return ranked.select((F.col("_start") + F.expr("_before[_at]") + F.bit_count(below) + 1).alias(name), *columns)


def file_starts(written: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """(_file, _n, _start): rows of each file of written Parquet, and of all files before it.

    Files stand in the order of their partition columns ``order``, then of their paths.
    Counting rows per file reads footers only.
    """
    placed = written.select(*order, F.col("_metadata.file_path").alias("_file"))
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in order])
    before = _running_total_before("_n", Window.orderBy(*order, "_file"))
    return counts.select("_file", "_n", before.alias("_start"))


def number_written(written: DataFrame, name: str, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Add dense ids to written Parquet: offset of the file + row index in it.

    There is one offset per file, so the listing the driver already holds gives their
    size: they are broadcast up to a bound, and meet the rows in a shuffle on the file
    beyond it.
    """
    placed = written.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    starts = file_starts(written, order).select("_file", "_start")
    if sum(len(file) + 64 for file in written.inputFiles()) <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    return placed.join(starts, "_file").select((F.col("_start") + F.col("_row") + 1).alias(name), *columns)


def repeated_ids(starts: DataFrame) -> DataFrame:
    """One row: rows, and ids that two files share, from the offsets alone.

    A file has the ids from its offset on, one per row, so ids repeat only where the
    range of a file begins before the end of those before it.
    """
    ends = F.max(F.col("_start") + F.col("_n")).over(Window.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    shared = F.greatest(F.lit(0), F.least(F.col("_n"), F.coalesce(ends - F.col("_start"), F.lit(0))))
    of_files = starts.where("_n > 0").select("_n", shared.alias("_shared"))
    return of_files.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_shared"), F.lit(0)).alias("repeated"))


def read_numbered(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """Read written Parquet rows with dense ids."""
    return number_written(spark.read.schema(schema).parquet(path), name, schema.names)
