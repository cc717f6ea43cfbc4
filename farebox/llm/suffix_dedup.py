"""Removal of byte strings that repeat anywhere in the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.deep_shallow import sort_suffixes
from farebox.llm.shared import Scratch, fresh, parts_of, row_key, table

LENGTH = 200
GRAM = 8
#: Bytes that one scan step works on.
STEP = 1 << 18
#: Odd multipliers of the 64-bit finalizer of MurmurHash3.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
#: Suffixes that one sorting task takes, about, and segments of one key that meet in it at most.
TASK_SUFFIXES, KEY_SEGMENTS = 400_000, 2_000

SEGMENT = pa.schema([("row_key", pa.int64()), ("key", pa.int64()), ("seg", pa.int64()), ("p", pa.int32()), ("n", pa.int32())])
SEGMENT_DDL = "row_key long, key long, seg long, p int, n int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(33)
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(33)
    x *= np.uint64(MIX[1])
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima to and from block ends."""
    n = len(x) - width + 1
    full = np.append(x, np.full(-len(x) % width, np.iinfo(x.dtype).max, dtype=x.dtype)).reshape(-1, width)
    to = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], to[width - 1 : width - 1 + n])


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, step: int = STEP):
    """(anchor, first, last) of runs of string starts with the same anchor, ``step`` bytes at a time.

    The anchor of a ``length``-byte string is the place of its smallest hashed
    8-byte gram, the leftmost if several are equal. So equal strings have it at
    equal places. Strings stay within the texts that ``offsets`` bound. The last
    run of a step is held back, since the next step may go on with it.
    """
    n, grams = len(data), length - GRAM + 1
    change = np.zeros(n + 1, dtype=np.int8)
    long = np.flatnonzero(np.diff(offsets) >= length)
    change[offsets[long]] += 1
    change[offsets[long + 1] - length + 1] -= 1
    low = np.uint64((1 << 24) - 1)
    held = (np.empty(0, np.int64),) * 3
    inside = 0
    for s in range(0, n - length + 1, step):
        e = min(s + step, n - length + 1)
        ok = np.cumsum(change[s:e], dtype=np.int32) + inside
        inside = int(ok[-1])
        if not ok.any():
            continue
        m = e - s + grams - 1
        piece = data[s : s + m + GRAM - 1].tobytes() + bytes(2 * GRAM)
        gram = np.empty(m + GRAM, dtype=np.uint64)
        for o in range(GRAM):
            part = np.frombuffer(piece, dtype="<u8", offset=o, count=(m + GRAM - o) // GRAM)
            gram[o::GRAM][: len(part)] = part
        hashed = _mix(gram[:m]) & ~low | np.arange(m, dtype=np.uint64)
        place = (_sliding_min(hashed, grams) & low).astype(np.int64) + s
        start = np.flatnonzero(ok > 0)
        place, start = place[start], start + s
        new = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (np.diff(start) != 1)))
        runs = [place[new], start[new], start[np.append(new[1:], len(start)) - 1]]
        if len(held[0]) and held[0][0] == runs[0][0] and held[2][0] + 1 == runs[1][0]:
            runs[1][0] = held[1][0]
        elif len(held[0]):
            runs = [np.append(h, r) for h, r in zip(held, runs, strict=True)]
        held = tuple(r[-1:] for r in runs)
        if len(runs[0]) > 1:
            yield tuple(r[:-1] for r in runs)
    if len(held[0]):
        yield held


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segments(length: int):
    """Segments of all strings of each text: ``n`` starts from byte ``p``, whose strings share ``key``.

    A string either holds the half length before its anchor or that from it, and
    hashing this half gives its key: strings with different keys differ. ``seg``
    hashes all the bytes of the segment. Rows leave step by step, so a task holds
    the texts of a batch and the rows of one step, however long a text is.
    """
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            data, offsets = _texts(batch.column("text"))
            raw = memoryview(data)
            owners = batch.column("row_key").to_numpy(zero_copy_only=False)
            for place, first, last in anchor_runs(data, offsets, length):
                text = np.searchsorted(offsets, first, "right") - 1
                for seed, from_, to, key_at in (
                    (1, np.maximum(first, place - half + 1), last, place),
                    (2, first, np.minimum(last, place - half), place - half),
                ):
                    some = np.flatnonzero(from_ <= to)
                    p, stop, k, row = from_[some], to[some] + length, key_at[some], text[some]
                    keys = np.fromiter((digest(raw[a : a + half], seed) for a in k), np.uint64, len(some))
                    segs = np.fromiter((digest(raw[a:b]) for a, b in zip(p, stop, strict=True)), np.uint64, len(some))
                    columns = [owners[row], keys.view(np.int64), segs.view(np.int64), (p - offsets[row]).astype(np.int32), (stop - length - p + 1).astype(np.int32)]
                    yield pa.record_batch([pa.array(c) for c in columns], schema=SEGMENT)

    return run


def _cut(length: int):
    """The bytes of the wanted segments of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                rows = []
                for key, text, wanted in batch.iloc[at : at + 64][["row_key", "text", "wanted"]].itertuples(index=False):
                    data = text.encode("utf-8", "surrogatepass")
                    rows += [(key, w["key"], w["seg"], w["p"], w["n"], w["copies"], data[w["p"] : w["p"] + w["n"] - 1 + length]) for w in wanted]
                yield pd.DataFrame(rows, columns=["row_key", "key", "seg", "p", "n", "copies", "body"])

    return run


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _sorted_repeats(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Repeated starts of the segments of one bucket, from their sorted suffixes."""
        group = group.drop_duplicates(["key", "seg"])
        buf = np.frombuffer(b"".join(group["body"]), dtype=np.uint8)
        n, sizes = group["n"].to_numpy(np.int64), group["body"].str.len().to_numpy(np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        starts = (np.cumsum(sizes) - sizes)[owner] + offset
        order, lcp = sort_suffixes(buf, starts, length)
        same = lcp >= length
        repeated = np.zeros(len(starts), dtype=bool)
        repeated[order] = same | np.append(same[1:], False)
        single = group["copies"].to_numpy() == 1
        flags = repeated & single[owner]
        # a gap after each segment keeps runs apart
        spread = np.zeros(len(flags) + len(n), dtype=bool)
        spread[np.arange(len(flags)) + owner] = flags
        first, stop = _runs(spread)
        at = np.searchsorted(np.cumsum(n + 1), first, "right")
        p = first - (np.cumsum(n + 1) - n - 1)[at] + group["p"].to_numpy(np.int64)[at]
        return pd.DataFrame({"row_key": group["row_key"].to_numpy()[at], "p": p.astype(np.int32), "n": (stop - first).astype(np.int32)})

    return run


def _strings(length: int):
    """Each string of a segment by itself: its start and hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                hashes = [xxhash.xxh3_64_intdigest(r.body[k : k + length], 3) for k in range(r.n)]
                yield pd.DataFrame(
                    {"row_key": r.row_key, "key": r.key, "hash": np.array(hashes, np.uint64).view(np.int64), "p": np.arange(r.p, r.p + r.n, dtype=np.int32), "copies": r.copies}
                )

    return run


def repeated_starts(docs: DataFrame, length: int = LENGTH, key_segments: int = KEY_SEGMENTS) -> DataFrame:
    """(row_key, p, n): at ``n`` bytes from byte ``p`` of a text there start strings that also start elsewhere.

    1. Each task scans its texts and hashes the segments of strings that share an
       anchor: two rows for about 100 bytes.
    2. Keys are counted (partial sums first). A key that occurs once can't repeat and
       goes. Where all segments of a key are equal, all their strings repeat.
    3. Elsewhere equal segments collapse to one with a count, whose bytes are cut
       from one of its texts. The suffixes that start in these are sorted
       deep-shallow, key by key; neighbours that share ``length`` bytes repeat.
       Keys with over ``key_segments`` different segments are not gathered: their
       strings are dealt out one by one and counted.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    half = length // 2
    if half < GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    keyed = docs.select(row_key("doc_id", "text").alias("row_key"), "text").where(F.octet_length("text") >= length)
    segments = scratch.write(keyed.mapInArrow(_segments(length), SEGMENT_DDL), "segments")
    keys = segments.groupBy("key").agg(F.count("*").alias("rows"), F.min("seg").alias("low"), F.max("seg").alias("high"))
    keys = scratch.write(keys.where("rows > 1").select("key", (F.col("low") == F.col("high")).alias("pure")), "keys")
    live = scratch.write(segments.join(keys, "key"), "live")
    scratch.drop("segments", "keys")

    mixed = live.where("not pure").drop("pure")
    classes = mixed.groupBy("key", "seg").agg(F.count("*").alias("copies"), F.min(F.struct("row_key", "p", "n")).alias("one"))
    classes = scratch.write(classes, "classes")
    sizes = scratch.write(classes.groupBy("key").agg(F.count("*").alias("different")).where(F.col("different") > key_segments), "hot")

    wanted = classes.groupBy(F.col("one.row_key").alias("row_key")).agg(
        F.collect_list(F.struct("key", "seg", "one.p", "one.n", "copies")).alias("wanted")
    )
    wanted = scratch.write(wanted, "wanted")
    if not keyed.groupBy("row_key").count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(["row_key"])
    bodies = keyed.join(wanted, "row_key").mapInPandas(
        _cut(length), "row_key long, key long, seg long, p int, n int, copies long, body binary"
    )
    bodies = scratch.write(bodies, "bodies")
    scratch.drop("wanted")
    suffixes = bodies.agg(F.sum("n")).first()[0] or 0
    buckets = max(parts_of(scratch.spark), suffixes // TASK_SUFFIXES)
    cool = bodies.join(sizes, "key", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    by_sort = cool.groupBy("bucket").applyInPandas(_sorted_repeats(length), "row_key long, p int, n int")

    single = bodies.join(sizes, "key", "left_semi").mapInPandas(_strings(length), "row_key long, key long, hash long, p int, copies long")
    counted = single.groupBy("key", "hash").agg(F.sum("copies").alias("copies")).where("copies > 1").select("key", "hash")
    counted = scratch.write(counted, "counted")
    by_count = single.where("copies = 1").join(counted, ["key", "hash"]).select("row_key", "p", F.lit(1).alias("n"))

    several = scratch.write(classes.where("copies > 1").select("key", "seg"), "several")
    by_copy = mixed.join(several, ["key", "seg"]).select("row_key", "p", "n")
    found = live.where("pure").select("row_key", "p", "n").union(by_copy).union(by_sort).union(by_count)
    found = scratch.write(found, "found")
    scratch.drop("live", "classes", "hot", "bodies", "counted", "several")
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row key with a repeat: ``spans``, all its repeated starts as an array of (p, n)."""
    found = repeated_starts(docs, length)
    return found.groupBy("row_key").agg(F.collect_set(F.struct("p", "n")).alias("spans"))


def merged(spans, length: int) -> list[tuple[int, int]]:
    """Byte runs that the strings starting in ``spans`` cover."""
    out: list[list[int]] = []
    for p, n in sorted((s["p"], s["n"]) for s in spans):
        if out and p <= out[-1][1]:
            out[-1][1] = max(out[-1][1], p + n - 1 + length)
        else:
            out.append([p, p + n - 1 + length])
    return [(a, b) for a, b in out]


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in runs)]
    starts = [*(a for a, _ in runs), len(data)]
    return b"".join(data[a:b] for a, b in zip(ends, starts, strict=True))


def _cleaned(length: int, digest: bool):
    kind = "struct<n_bytes:long,n_removed:long,n_spans:long,kept:string>"

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            rows = []
            for text, found in zip(texts, spans, strict=True):
                data = text.encode("utf-8", "surrogatepass")
                runs = merged(found, length) if found is not None else []
                kept = kept_bytes(data, runs)
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "ignore")))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _result(docs: DataFrame, length: int, digest: bool, row: str, out: str) -> DataFrame:
    spans = repeated_spans(docs, length).select(F.col("row_key").alias(row), F.col("spans").alias(f"{row}_spans"))
    joined = docs.withColumn(row, row_key("doc_id", "text")).join(spans, row, "left")
    return joined.withColumn(out, _cleaned(length, digest)(F.coalesce("text", F.lit("")), f"{row}_spans")).drop(row, f"{row}_spans")


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and kept_sha256 of the remaining bytes.

    A byte goes if a ``length``-byte string that covers it also starts anywhere
    else in ``docs``, the same text included. Strings are judged on the input.

    Defined cases: a null text is empty; a text shorter than ``length`` stays
    whole; a text of any length is judged whole, step by step; repeated rows are copies of
    each other; a null doc_id is an id like any other; extra columns are not read; no rows
    give no rows.
    """
    out = _result(docs.select("doc_id", "text"), length, True, "row_key", "found")
    return out.select("doc_id", "found.n_bytes", "found.n_removed", "found.n_spans", F.col("found.kept").alias("kept_sha256"))


def dedup_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings removed from text (n_chars follows, if there).

    A character that loses some of its bytes goes whole. A null text stays null. Columns of any
    names stay as they are; no rows give no rows.
    """
    row, found = fresh(docs, "row"), fresh(docs, "found")
    out = _result(docs, length, False, row, found)
    text: Column = F.when(F.col("text").isNotNull(), F.col(f"{found}.kept"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT r, i, md5_number(substr(h, 2 * i + 1, 400)) AS s
  FROM (SELECT r, h, unnest(generate_series(0, length(h) // 2 - 200)) AS i FROM d)
), starts AS (
  SELECT r, i FROM w WHERE s IN (SELECT s FROM w GROUP BY s HAVING count(*) > 1)
), islands AS (
  SELECT r, i, sum(CASE WHEN i - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS island
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM starts)
), runs AS (
  SELECT r, min(i) AS a, max(i) + 200 AS b FROM islands GROUP BY r, island
), gone AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
), bounds AS (
  SELECT r, a AS stop, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS start FROM runs
  UNION ALL
  SELECT r, CAST(NULL AS BIGINT), max(b) FROM runs GROUP BY r
), kept AS (
  SELECT r, string_agg(substr(h, 2 * start + 1, 2 * (coalesce(stop, length(h) // 2) - start)), '' ORDER BY start) AS h
  FROM bounds JOIN d USING (r) GROUP BY r
)
SELECT doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
