"""SimHash near-duplicates found at the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from farebox.llm.components import components, forest
from farebox.llm.shared import Scratch, fresh, parts_of, row_key, table

#: Fixed value: generator x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code.
#: It is perfect: each of the 2^23 words has exactly one codeword within 3 bits.
GOLAY, BITS, CHECKS, RADIUS = 0b110001110101, 23, 11, 3
SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Homes of one anchor that meet its copies in one cell, about.
#: Fingerprints for each bucket of comparisons, about.
BUCKET_PRINTS = 20_000
BLOCK = 4096


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=False)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(width: int, seed: int):
    @pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, width, seed) for t in batch], dtype="<u8").view("<i8"))

    return of


@cache
def _syndromes() -> np.ndarray:
    """Remainder of each 23-bit word modulo the generator, by bit and thus by xor."""
    table = np.zeros(1 << BITS, dtype=np.uint16)
    for bit in range(BITS):
        rest = 1 << bit
        for high in range(bit, CHECKS - 1, -1):
            if rest >> high & 1:
                rest ^= GOLAY << (high - CHECKS)
        table[1 << bit : 2 << bit] = table[: 1 << bit] ^ rest
    return table


@cache
def _coset(extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns whose weight exceeds the radius by ``extra`` (0: up to it), by syndrome: patterns, first, count."""
    weights = np.bitwise_count(np.arange(1 << BITS, dtype=np.uint32))
    patterns = np.flatnonzero(weights <= RADIUS if extra == 0 else weights == RADIUS + extra)
    of = _syndromes()[patterns]
    counts = np.bincount(of, minlength=1 << CHECKS)
    return patterns[np.argsort(of, kind="stable")], np.cumsum(counts) - counts, counts


def _halves(words: np.ndarray) -> list[np.ndarray]:
    return [(words >> np.uint64(shift) & np.uint64((1 << BITS) - 1)).astype(np.int64) for shift in (0, BITS)]


def homes(words: np.ndarray) -> np.ndarray:
    """The one codeword within the covering radius of each fingerprint."""
    pattern = _coset(0)[0]
    a, b = (h ^ pattern[_syndromes()[h]] for h in _halves(words))
    return a | b << BITS


def anchors(words: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(position, anchor) of the codewords each fingerprint is copied to.

    The code is the product of two Golay codes on bits 0-22 and 23-45. Each
    fingerprint has one home within the covering radius (3 bits a half). If two
    differ in at most ``max_bits``, the home of one is within radius plus
    threshold of the other, with the excess over both halves at most
    ``max_bits``: all those anchors are returned.
    """
    halves = _halves(words)
    syndromes = [_syndromes()[h].astype(np.int64) for h in halves]
    rows, keys = [], []
    for i in range(max_bits + 1):
        for j in range(max_bits + 1 - i):
            (p, p0, pn), (q, q0, qn) = _coset(i), _coset(j)
            n, m = pn[syndromes[0]], qn[syndromes[1]]
            row = np.repeat(np.arange(len(words)), n * m)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            a = halves[0][row] ^ p[p0[syndromes[0][row]] + k // m[row]]
            b = halves[1][row] ^ q[q0[syndromes[1][row]] + k % m[row]]
            rows.append(row)
            keys.append(a | b << BITS)
    return np.concatenate(rows), np.concatenate(keys)


def _home_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"anchor": homes(batch["fp"].to_numpy(np.int64).view(np.uint64))})


def _replicate(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                words = batch["fp"].to_numpy(np.int64)[at : at + 4096]
                row, key = anchors(words.view(np.uint64), max_bits)
                yield pd.DataFrame({"anchor": key, "fp": words[row]})

    return run


def _is_home() -> Column:
    mask = (1 << BITS) - 1
    part = lambda c, shift: F.shiftrightunsigned(c, shift).bitwiseAND(mask)
    apart = lambda shift: F.bit_count(part("fp", shift).bitwiseXOR(part("anchor", shift)))
    return (apart(0) <= RADIUS) & (apart(BITS) <= RADIUS)


def _compare(max_bits: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links between homes and copies at the same anchor and cell, as a forest."""
        group = group.sort_values(["anchor", "cell"], kind="stable")
        new = (group["anchor"].diff().ne(0) | group["cell"].diff().ne(0)).to_numpy()
        of, fp, home = np.cumsum(new) - 1, group["fp"].to_numpy(np.int64), group["home"].to_numpy(bool)
        homes, owner = fp[home], of[home]
        count = np.bincount(owner, minlength=of[-1] + 1) if len(of) else np.zeros(1, int)
        first = np.cumsum(count) - count
        u, v = np.empty(0, np.int64), np.empty(0, np.int64)
        work = count[of]
        at = 0
        while at < len(fp):
            stop = max(at + 1, int(np.searchsorted(np.cumsum(work[at:]), 2_000_000, "right")) + at)
            n = work[at:stop]
            left = np.repeat(fp[at:stop], n)
            k = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            right = homes[np.repeat(first[of[at:stop]], n) + k]
            near = (left != right) & (np.bitwise_count((left ^ right).view(np.uint64)) <= max_bits)
            u, v = np.concatenate([u, left[near]]), np.concatenate([v, right[near]])
            if len(u) > 1_000_000:
                u, v = forest(u, v)
            at = stop
        u, v = forest(u, v)
        return pd.DataFrame({"u": u, "v": v})

    return run


def links(prints: DataFrame, max_bits: int, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) with the same components as all pairs within ``max_bits``.

    ``prints`` holds each fingerprint once (column fp). Homes are counted by anchor
    first; a copy goes on only where its anchor is some fingerprint's home. An
    anchor with more than ``block`` homes is dealt out on a grid: homes to columns
    and copies to rows by hash, and each cell is compared in some task.
    """
    spark = scratch.spark
    prints = scratch.write(prints, "prints")
    sizes = prints.mapInPandas(_home_rows, "anchor long").groupBy("anchor").agg(F.count("*").alias("n"))
    sizes = scratch.write(sizes.select("anchor", F.ceil(F.col("n") / block).cast("int").alias("cuts")), "homes")
    met = prints.mapInPandas(_replicate(max_bits), "anchor long, fp long").join(sizes, "anchor")
    met = met.withColumns({"home": _is_home(), "cut": F.pmod(F.xxhash64("fp"), "cuts")})
    grid = lambda cell: F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), cell)
    as_home = grid(lambda x: F.struct((x * F.col("cuts") + F.col("cut")).cast("int").alias("cell"), F.lit(True).alias("home")))
    as_copy = grid(lambda x: F.struct((F.col("cut") * F.col("cuts") + x).cast("int").alias("cell"), F.lit(False).alias("home")))
    one = F.array(F.struct(F.lit(0).alias("cell"), F.col("home")))
    dealt = F.when(F.col("cuts") == 1, one).when(F.col("home"), F.concat(as_home, as_copy)).otherwise(as_copy)
    near = met.select("anchor", "fp", F.explode(dealt).alias("to")).select("anchor", "fp", "to.cell", "to.home")
    # a fingerprint meets the homes of a few anchors; a bucket is one frame, so their number follows the fingerprints
    buckets = max(parts_of(spark), prints.count() // BUCKET_PRINTS)
    near = near.withColumn("bucket", F.pmod(F.xxhash64("anchor", "cell"), F.lit(buckets)))
    return near.groupBy("bucket").applyInPandas(_compare(max_bits), "u long, v long")


def simhash_groups(
    docs: DataFrame, width: int = SHINGLE, seed: int = SEED, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """Near-duplicate groups: documents linked, directly or in steps, by fingerprints within ``max_bits``.

    Returns one row per row of ``docs``: doc_id, row_key (see ``shared.row_key`` of doc_id and text),
    fingerprint (16 hex digits), component_id (smallest doc_id of the group) and
    component (smallest fingerprint of the group).

    Defined cases: null and word-free texts have fingerprint zero and link like any other;
    repeated rows and ids each give a row; a null doc_id is never the smallest unless the
    group has no other (then component_id is null); texts of any length are hashed whole; other columns are not read; no rows give no rows.

    Equal fingerprints collapse before any comparison, so copies cost one row each.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    of = _fingerprints(width, seed)
    prints = scratch.write(docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), of("text").alias("fp")), "docs")
    unique = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    unique = scratch.write(unique, "unique")
    linked = components(links(unique.select("fp"), max_bits, scratch, block), scratch)
    labelled = unique.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = scratch.write(labelled, "labelled")
    first = scratch.write(labelled.groupBy("label").agg(F.min("first").alias("component_id")), "first")
    classes = scratch.write(labelled.select("fp", "label").join(first, "label"), "classes")
    as_text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return prints.join(classes, "fp").select(
        "doc_id", "row_key", as_text("fp").alias("fingerprint"), "component_id", as_text("label").alias("component")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with one row for each near-duplicate group: that of its smallest doc_id.

    Equal smallest ids within a group (repeated rows) leave one of their rows, by
    the smallest row key; rows that agree in doc_id and text leave one of them. Columns of any
    names stay as they are; nulls are as in ``simhash_groups``; no rows give no rows.
    """
    groups = Scratch(docs.sparkSession, "keep")
    found = groups.write(simhash_groups(docs, **options), "groups")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.write(kept.groupBy("component").agg(F.min("row_key").alias("row_key"), F.count("*").alias("n")), "kept")
    repeated = kept.where("n > 1").select("row_key")
    row = fresh(docs, "row")
    keyed = docs.withColumn(row, row_key("doc_id", "text"))
    single = keyed.join(kept.where("n = 1").select(F.col("row_key").alias(row)), row, "left_semi").drop(row)
    if repeated.isEmpty():
        return single
    several = keyed.join(repeated.select(F.col("row_key").alias(row)), row, "left_semi").dropDuplicates([row])
    return single.unionByName(several.drop(row))


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
