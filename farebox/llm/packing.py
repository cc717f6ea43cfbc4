"""Packing of token sequences by minimum bin slack."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from farebox.llm.shared import Scratch, row_key, table

CAPACITY, END = 2048, 1
#: A window with more slack than this takes a part of a longer piece.
SLACK = 16
#: Pieces of one length that are numbered in one window, about.
GROUP_ROWS = 1_000
RANKS = "byte_bpe_50k.tiktoken"


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file; special tokens' strings are ordinary text.

    Its ids equal those of ``tokenizers`` with byte_bpe_50k.json, several times as fast.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, path: str, end: int = END) -> np.ndarray:
    """Ids of a text and the closing id, as little-endian unsigned 32-bit numbers."""
    return np.array([*encoding(path).encode_ordinary(text or ""), end], dtype="<u4")


def _tokenized(path: str, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, doc_id, text in batch[["row_key", "doc_id", "text"]].itertuples(index=False):
                ids = token_ids(text, path)
                rows += [(key, doc_id, len(ids), a, min(capacity, len(ids) - a), zlib.crc32(ids[a : a + capacity])) for a in range(0, len(ids), capacity)]
            out = pd.DataFrame(rows, columns=["row_key", "doc_id", "doc_tokens", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def _fill(counts: dict[int, int], first: int, capacity: int) -> list[int]:
    """Lengths, with repeats, whose sum with ``first`` is the closest to ``capacity`` from below.

    Bit s of a set says that sum s can be reached. Lengths join in descending
    order, each as often as it is there (in powers of two), until the capacity is
    reached or none is left; the kept sets lead back from the largest sum.
    """
    mask = (1 << capacity + 1) - 1
    reach = 1 << first
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        many = min(counts[length] - (length == first), (capacity - first) // length)
        take = 1
        while many > 0 and not reach >> capacity & 1:
            take = min(take, many)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            many, take = many - take, take * 2
        if reach >> capacity & 1:
            break
    total, out = reach.bit_length() - 1, [first]
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, ...]]:
    """Places of all pieces, from how many there are of each length.

    Rows (length, low, high, start, part, number, each, sequence, offset): of the
    pieces of ``length`` ranked ``low`` to below ``high``, the ``part`` tokens from
    ``start``: the i-th of them is number n = ``number`` + i, lies in sequence
    ``sequence`` + n div ``each``, at ``offset`` + (n mod each) * part.

    The longest piece left opens a window, and the fill is repeated while the
    lengths last, so there are a few windows for each length however many pieces
    there are. Where the best fill leaves over ``slack`` free, the window takes as
    much of a longer piece, whose rest goes back to the others.
    """
    heaps: dict[int, list[tuple[int, int, int, int]]] = {n: [(n, 0, c, 0)] for n, c in counts.items() if c}
    left = {n: c for n, c in counts.items() if c}
    out, sequence = [], 0

    def take(length: int, many: int) -> list[tuple[int, int, int, int]]:
        """``many`` pieces of a length: (whole length, low, high, start) of each range."""
        left[length] -= many
        got = []
        while many:
            whole, low, high, start = heaps[length].pop()
            n = min(many, high - low)
            got.append((whole, low, low + n, start))
            if low + n < high:
                heaps[length].append((whole, low + n, high, start))
            many -= n
        if not left[length]:
            del left[length], heaps[length]
        return got

    def place(got, part: int, each: int, offset: int) -> None:
        number = 0
        for whole, low, high, start in got:
            out.append((whole, low, high, start, part, number, each, sequence, offset))
            number += high - low

    while left:
        chosen = _fill(left, max(left), capacity)
        uses = {n: chosen.count(n) for n in chosen}
        times = min(left[n] // c for n, c in uses.items())
        free = capacity - sum(chosen)
        # pieces that can give the free tokens and keep some, beside those that the window uses
        spare = {n: left[n] - uses.get(n, 0) for n in left if n > free and left[n] > uses.get(n, 0)}
        longer = max(spare, default=0) if free > slack else 0
        if longer:
            times = min(times, left[longer] // (uses.get(longer, 0) + 1))
        offset = 0
        for n, c in sorted(uses.items(), reverse=True):
            place(take(n, c * times), n, c, offset)
            offset += n * c
        if longer:
            got = take(longer, times)
            place(got, free, 1, offset)
            rest = longer - free
            left[rest] = left.get(rest, 0) + times
            heaps.setdefault(rest, []).extend((whole, low, high, start + free) for whole, low, high, start in got)
        sequence += times
    return out


def _crc(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, wanted in batch[["row_key", "text", "wanted"]].itertuples(index=False):
                ids = token_ids(text, path)
                rows += [(key, w["start"], w["length"], zlib.crc32(ids[w["start"] : w["start"] + w["length"]])) for w in wanted]
            yield pd.DataFrame(rows, columns=["row_key", "start", "length", "ids_crc32"])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Pieces of all documents of ``docs``, packed into sequences of at most ``capacity`` ids.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    A document is cut into whole sequences and a remaining piece. Only the count
    of pieces per length (at most ``capacity`` numbers) comes to the driver, which
    plans the windows; pieces are numbered per length in groups of bounded size
    and find their places by number.

    Defined cases: a null or empty text has the closing id only; repeated rows are
    packed each; a null doc_id is kept; extra columns are not read; no rows give
    no rows; texts of any length are cut into as many pieces as they fill, and documents of equal
    length are numbered by their row keys, so reruns agree. A special token's string in a text
    is ordinary text: it never becomes the special id. All sequences but the last are filled up to ``slack`` ids, unless no
    piece is long enough to give the rest.
    """
    path = path or public_tokenizers.path(RANKS)
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    keyed = docs.select(row_key("doc_id", "text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "row_key long, doc_id long, doc_tokens long, start long, length long, ids_crc32 long"
    # the random part is written: a later retry of a task reads the same numbers
    pieces = scratch.write(keyed.mapInPandas(_tokenized(path, capacity), schema).withColumn("part", F.rand(0)), "pieces")

    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # groups by length, so their number follows that of the pieces; a row for each length
    groups = spark.createDataFrame([(n, -(-c // GROUP_ROWS)) for n, c in counts.items()], "length long, groups long")
    pieces = pieces.join(F.broadcast(groups), "length").withColumn("group", F.floor(F.col("part") * F.col("groups"))).drop("groups")
    sizes = pieces.groupBy("length", "group").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "group", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first"))
    firsts = scratch.write(firsts, "firsts")
    within = F.row_number().over(Window.partitionBy("length", "group").orderBy("part"))
    ranked = pieces.withColumn("within", within).join(firsts, ["length", "group"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("within") - 1)

    fields = ("low", "high", "from", "part", "number", "each", "sequence", "at")
    places = spark.createDataFrame(plan(counts, capacity, slack), "whole long, " + ", ".join(f"`{f}` long" for f in fields))
    places = places.groupBy("whole").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("places"))
    # a row for each length and a few places in each, whatever the number of pieces: small enough to send
    own = F.filter("places", lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"]))
    placed = ranked.drop("part").join(F.broadcast(places), F.col("length") == F.col("whole")).withColumn("place", F.explode(own))
    n = F.col("place.number") + F.col("rank") - F.col("place.low")
    placed = placed.select(
        "row_key",
        "doc_id",
        (F.col("start") + F.col("place.from")).alias("start"),
        F.col("place.part").alias("length"),
        F.when(F.col("place.part") == F.col("length"), F.col("ids_crc32")).alias("ids_crc32"),
        "doc_tokens",
        (F.col("place.sequence") + F.floor(n / F.col("place.each"))).cast("long").alias("sequence_id"),
        (F.col("place.at") + n % F.col("place.each") * F.col("place.part")).alias("offset"),
    )
    placed = scratch.write(placed, "placed")
    scratch.drop("pieces", "firsts")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    parts = placed.where("ids_crc32 is null").select("row_key", "start", "length").distinct()
    wanted = scratch.write(parts.groupBy("row_key").agg(F.collect_list(F.struct("start", "length")).alias("wanted")), "wanted")
    whole = placed.where("ids_crc32 is not null").select(columns)
    if wanted.isEmpty():
        return whole
    texts = keyed.select("row_key", "text").join(wanted, "row_key")
    sums = scratch.write(texts.mapInPandas(_crc(path), "row_key long, start long, length long, ids_crc32 long").distinct(), "sums")
    cut = placed.where("ids_crc32 is null").drop("ids_crc32").join(sums, ["row_key", "start", "length"])
    return whole.unionByName(cut.select(columns))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
