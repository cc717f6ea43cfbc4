"""Fingerprints of documents from prefix polynomial hashes, and how alike edited texts are by them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.prefix_hash import Joined, Spans, Text
from farebox.llm.shared import parts_of, table

#: Code points of a hashed span, and slots of a fingerprint (a power of two).
SPAN, SLOTS = 16, 128
#: Values of a slot: 0 is empty.
VALUES = 15
#: Rows of one range of ids, about, and ranges at most: more rows make longer ranges, which are streams.
RANGE_ROWS, RANGES = 2_000, 50_000
#: Odd multipliers of the 64-bit finalizer of MurmurHash3.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_edited long, common_next long"
)


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in MIX:
        x = (x ^ x >> np.uint64(33)) * np.uint64(m)
    return x ^ x >> np.uint64(33)


def sketch(spans: Spans) -> np.ndarray:
    """A digit per slot: of all hashed spans that fall into the slot, the least one's; 0 for none.

    A text shorter than a span is one span.
    """
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    shift = np.uint64(64 - (SLOTS.bit_length() - 1))
    for hashes in spans.windows(min(SPAN, spans.n)) if spans.n else ():
        mixed = _mixed(hashes)
        np.minimum.at(least, (mixed >> shift).astype(np.intp), mixed << np.uint64(7) >> np.uint64(7))
    return np.where(least == np.iinfo(np.uint64).max, 0, least % np.uint64(VALUES) + np.uint64(1)).astype(np.uint8)


def fingerprint(spans: Spans) -> tuple[str, np.ndarray]:
    """Hexadecimal: the hash of the whole text and a digit per slot; and the digits."""
    digits = sketch(spans)
    whole = "".join(f"{h:08x}" for h in spans.span(0, spans.n))
    return f"{whole}{digits.astype(np.uint8).tobytes().hex()[1::2]}", digits


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the spans that two texts have in common, of the spans of both, as their slots show it (0 to 1).

    Texts that are equal in one half come to about one half. Slots that are empty in both say
    nothing; digits that agree by chance are taken off.
    """
    both, either = int(((a > 0) & (b > 0)).sum()), int(((a > 0) | (b > 0)).sum())
    equal = int(((a == b) & (a > 0)).sum())
    if not either:
        return 1.0
    resemblance = min(1.0, max(0.0, (equal - both / VALUES) / (1 - 1 / VALUES) / either))
    return 2 * resemblance / (1 + resemblance)


class _Document:
    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.spans = doc_id, text, Text(text)
        self.fingerprint, self.digits = fingerprint(self.spans)


def _compared(doc: _Document, following: _Document) -> tuple:
    n = len(doc.text)
    rest = min(n // 2, len(following.text))
    cut = n - n // 2
    edited = Joined(doc.spans, cut, following.spans, rest)
    digest = hashlib.sha256(doc.text[:cut].encode("utf-8", "surrogatepass"))
    digest.update(following.text[:rest].encode("utf-8", "surrogatepass"))
    mark, digits = fingerprint(edited)
    return (
        doc.doc_id, n, digest.hexdigest(), doc.fingerprint, mark,
        1.0 if mark == doc.fingerprint else likeness(doc.digits, digits),
        1.0 if following.fingerprint == doc.fingerprint else likeness(doc.digits, following.digits),
        doc.spans.common(edited), doc.spans.common(following.spans),
    )


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row with the one after it; the last of a range is a copy of the next range's first."""
    before = None
    names = [field.split()[0] for field in RESULT.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(field.split()[0], types[field.split()[1]]) for field in RESULT.split(", ")])
    for batch in batches:
        rows = []
        ids, texts, lasts = (batch.column(c) for c in ("doc_id", "text", "last"))
        for i in range(batch.num_rows):
            doc = _Document(ids[i].as_py(), texts[i].as_py())
            if before is not None:
                rows.append(_compared(before, doc))
            before = None if lasts[i].as_py() else doc
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)


def _in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` with ``range_``: ids of range 0 are the largest; null ids have the last range."""
    at = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", at, 20 * ranges).alias("bounds")).first().bounds if at else []
    bounds = np.unique(np.array(found or [], dtype=np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), "left")).astype("int32")

    slot = F.when(F.isnull("doc_id"), len(bounds) + 1).otherwise(place(F.coalesce("doc_id", F.lit(0))))
    return docs.withColumn("range_", slot)


def _with_heads(placed: DataFrame) -> DataFrame:
    """``placed`` and, as the last row of each range, a copy of the first row of the next one.

    The driver sees one id for each range. The last range goes on with the first.
    """
    spark = placed.sparkSession
    tops = sorted(tuple(r) for r in placed.groupBy("range_").agg(F.max("doc_id").alias("top")).collect())
    heads = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]
    sent = F.broadcast(spark.createDataFrame(heads, "top long, to int"))
    same = F.expr("doc_id <=> top")
    firsts = placed.join(sent, same).groupBy("to").agg(
        F.min_by(F.struct("doc_id", "text"), "sha").alias("head"), F.min("sha").alias("sha")
    )
    firsts = firsts.select(F.col("to").alias("range_"), F.lit(True).alias("last"), "head.doc_id", "head.text", "sha")
    return placed.select("range_", F.lit(False).alias("last"), "doc_id", "text", "sha").union(firsts)


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of its edited text, and how alike they are.

    The edited text is the document with its last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document by descending doc_id; the smallest id
    is followed by the largest. A fingerprint is the polynomial hash of the whole
    text and a digit for each of 128 slots of its spans, both taken from prefix arrays. near_edited
    and near_next estimate the share of common spans from the digits.
    common_edited and common_next are the longest common extensions from the start.

    Rows are dealt to ranges of ids and sorted, and each task reads its ranges as a
    stream that holds two documents; the first row of each range is copied to
    the one before it. So texts move once.

    Defined cases: a null text is empty; two empty texts are alike (1), an empty and another one
    are not (0). Null ids come last. Rows with equal ids stand in the order of the SHA-256 of their
    texts; repeated rows follow each other. A single row is followed by itself. A text of any
    length is hashed whole: 8 bytes of arrays for a code point. Other columns are not
    read. No rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = read.count()
    if not rows:
        return docs.sparkSession.createDataFrame([], RESULT)
    ranges = min(rows // range_rows + 1, RANGES)
    placed = _in_ranges(read, ranges).withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    dealt = _with_heads(placed).repartition(max(ranges, parts_of(docs.sparkSession)), "range_")
    in_order = dealt.sortWithinPartitions("range_", "last", F.col("doc_id").desc_nulls_last(), "sha")
    return in_order.select("doc_id", "text", "last").mapInArrow(_run, RESULT)


def op11_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
