"""Language of a text from bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shared import Scratch, fold_of, table

GRAM = 4
#: A language's filter holds the n-grams that are at least this share of all its n-grams:
#: so at most 1 / SHARE for each language, however much text there is.
SHARE = 1e-5
#: ... and at least this part of their largest share in any language: texts with passages
#: in another language don't make its n-grams their own.
PART = 0.25
HASHES, BITS_PER_GRAM = 4, 16
FOLDS, HELD_OUT = 4, 2
#: Code points that one step works on, and distinct n-grams that a task holds at most.
STEP, HELD = 1 << 20, 2_000_000
UNKNOWN = "und"
#: Odd multipliers of the 64-bit finalizer of MurmurHash3.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the n-grams of all words, with a mark at both word ends.

    Words are runs of letters, in lower case. A word shorter than n - 2 has none.
    """
    points = np.frombuffer(" ".join(texts).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points) != sum(map(len, texts)) + max(len(texts) - 1, 0):
        # a letter whose lower case is two code points: text by text, to know the bounds
        parts = [t.lower() for t in texts]
        points = np.frombuffer(" ".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    else:
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    letter = np.concatenate([[False], _letters()[points], [False] * GRAM])
    code = np.concatenate([[0], points, [0] * GRAM]).astype(np.uint64) * letter
    n = len(points)
    # inside, all are letters; an end may be the mark, but not both unless the word has n - 2 letters
    ok = np.ones(n + 1, dtype=bool)
    for k in range(1, GRAM - 1):
        ok &= letter[k : k + n + 1]
    at = np.flatnonzero(ok)
    hashed = np.zeros(len(at), dtype=np.uint64)
    for k in range(GRAM):
        hashed = (hashed ^ code[at + k]) * np.uint64(MIX[0])
        hashed ^= hashed >> np.uint64(32)
    hashed = hashed * np.uint64(MIX[1])
    hashed ^= hashed >> np.uint64(29)
    # a gram belongs to the text of its second code point, which is a letter
    owner = np.searchsorted(np.cumsum(lengths), at, "right")
    return owner, hashed


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about STEP code points; a longer text alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > STEP:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of n-grams per language, summed in the task as far as memory allows."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)

    def out():
        for lang, parts in held.items():
            keys, counts = merged(parts)
            yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": counts})

    for batch in batches:
        for lang, same in batch.groupby("lang"):
            for _, texts in _chunks(same["text"].tolist()):
                keys, counts = np.unique(grams(texts)[1], return_counts=True)
                held.setdefault(lang, []).append((keys, counts))
                size += len(keys)
                if size > HELD:
                    held = {x: [merged(p)] for x, p in held.items()}
                    size = sum(len(p[0][0]) for p in held.values())
                if size > HELD // 2 and all(len(p) == 1 for p in held.values()):
                    yield from out()
                    held, size = {}, 0
    yield from out()


class Filters(NamedTuple):
    """``slices[word, slot]`` has a bit for each language whose Bloom filter has the slot."""

    languages: list[str]
    slices: np.ndarray
    false_positive: np.ndarray


def _slots(hashed: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    step = hashed >> np.uint64(32) | np.uint64(1)
    for k in range(HASHES):
        yield (hashed + np.uint64(k) * step) % np.uint64(slots)


def build_filters(found: dict[str, np.ndarray]) -> Filters:
    languages = sorted(found)
    slots = max(64, BITS_PER_GRAM * max((len(g) for g in found.values()), default=1))
    slices = np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64)
    chance = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        for slot in _slots(found[lang], slots):
            slices[i // 64][slot] |= np.uint64(1 << i % 64)
        chance[i] = ((slices[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()) ** HASHES
    return Filters(languages, slices, chance)


def predict(texts: list[str | None], filters: Filters) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    Each n-gram's slots are looked up once, and their AND is the set of all languages
    that hold it. The count of its bits per language, less what the filter's false
    positives add on average, estimates how many n-grams the language shares with the
    text. The largest share decides (the first language of equal ones); the score is
    the share times what the language has of the two best together.
    """
    languages = filters.languages
    total = np.zeros(len(texts), dtype=np.int64)
    hits = np.zeros((len(texts), max(1, len(languages))), dtype=np.int64)
    plain = [t or "" for t in texts]
    for first, part in _chunks(plain):
        owner, hashed = grams(part)
        total[first : first + len(part)] += np.bincount(owner, minlength=len(part))
        masks = np.full((len(filters.slices), len(hashed)), ~np.uint64(0))
        for slot in _slots(hashed, filters.slices.shape[1]):
            masks &= filters.slices[:, slot]
        for i in range(len(languages)):
            bit = masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)
            hits[first : first + len(part), i] += np.bincount(owner, weights=bit, minlength=len(part)).astype(np.int64)
    out, score = [], np.zeros(len(texts))
    chance = filters.false_positive
    for i, text in enumerate(plain):
        if not languages or not any(map(str.isalpha, text)):
            out.append(UNKNOWN)
            continue
        share = np.clip((hits[i] - total[i] * chance) / (1 - chance) / max(total[i], 1), 0, 1)
        best = int(np.argmax(share))
        second = np.partition(share, -2)[-2] if len(share) > 1 else 0.0
        out.append(languages[best])
        score[i] = share[best] * share[best] / (share[best] + second) if share[best] > 0 else 0.0
    return out, score


def learn_filters(docs: DataFrame, scratch: Scratch) -> Filters:
    """Filters of every language among the rows of ``docs`` (text, lang) whose lang isn't null.

    All texts are counted. The n-grams that pass the two shares are collected: at
    most 1 / SHARE for each language.
    """
    rows = docs.where("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    counts = rows.mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = scratch.write(counts, "counts")
    totals = scratch.write(counts.groupBy("lang").agg(F.sum("n").alias("all")), "totals")
    shared = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("all")).where(F.col("share") >= SHARE)
    shared = scratch.write(shared.select("lang", "gram", "share"), "shares")
    most = shared.groupBy("gram").agg(F.max("share").alias("most"))
    kept = shared.join(most, "gram").where(F.col("share") >= PART * F.col("most")).select("lang", "gram").toPandas()
    found = {lang: g["gram"].to_numpy(np.int64).view(np.uint64) for lang, g in kept.groupby("lang")}
    known = [r.lang for r in rows.select("lang").distinct().collect()]
    return build_filters({lang: found.get(lang, np.empty(0, np.uint64)) for lang in known})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred and score, with filters from ``learn_filters``.

    Defined cases: ``und`` with score 0 for a null text and a text without a
    letter, and everywhere if no language was learned; a text with letters but without n-grams gets the
    first language with score 0; repeated rows each get the same; a null doc_id
    is held out as the empty text's checksum says; of languages with equal shares the first by
    name is given; texts of any length are counted whole, part by part; extra columns are not
    read; no rows give no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, score = predict([None if t is None else t for t in batch], shipped.value)
            yield pd.DataFrame({"lang_pred": langs, "score": score})

    out = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), of("text").alias("found"))
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score")


def language_id(docs: DataFrame) -> DataFrame:
    """``identify`` with filters learned from the rows that are not held out; held-out rows are never read for them."""
    scratch = Scratch(docs.sparkSession, "lang")
    return identify(docs, learn_filters(docs.where(fold_of("doc_id", FOLDS) != HELD_OUT), scratch))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
