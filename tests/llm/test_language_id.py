from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from farebox.llm import language_id as lid
from farebox.llm.shared import Scratch

SCHEMA = "doc_id long, text string, lang string, source string"


def plain_grams(text):
    out, word = Counter(), ""
    for ch in text.lower() + " ":
        if ch.isalpha():
            word += ch
            continue
        marked = f" {word} "
        out.update(marked[i : i + 4] for i in range(len(marked) - 3) if word)
        word = ""
    return out


def test_grams_are_those_of_words():
    texts = ["Ab c de, fgh; ijkl\nMN", "", "İstanbul é٣b", "x", "naïve  Straße 😀"]
    owner, hashed = lid.grams(texts)
    for i, t in enumerate(texts):
        assert sorted(Counter(hashed[owner == i].tolist()).values()) == sorted(plain_grams(t).values()), t
    same = lid.grams(["naïve"])[1].tolist()
    assert same == lid.grams(["NAÏVE!"])[1].tolist() and len(same) == 4


def test_filters_hold_their_grams_and_few_others():
    rng = np.random.default_rng(1)
    found = {f"l{i:02}": rng.integers(0, 1 << 63, 500 + i, dtype=np.uint64) for i in range(70)}
    f = lid.build_filters(found)
    for i, lang in enumerate(f.languages):
        masks = np.full((2, 2000), ~np.uint64(0))
        probe = np.concatenate([found[lang][:500], rng.integers(0, 1 << 63, 1500, dtype=np.uint64)])
        for slot in lid._slots(probe, f.slices.shape[1]):
            masks &= f.slices[:, slot]
        bit = masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)
        assert bit[:500].all() and bit[500:].mean() < 0.02


def test_counts_and_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    f = lid.learn_filters(docs, Scratch(spark, "test"))
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pandas()
    counts = defaultdict(Counter)
    for text, lang in zip(t.text, t.lang):
        counts[lang].update(plain_grams(text))
    share = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    kept = {x: {g for g, s in c.items() if s >= lid.SHARE and s >= lid.PART * max(o.get(g, 0) for o in share.values())} for x, c in share.items()}
    bits = [int(sum(int(x).bit_count() for x in (f.slices[0] >> np.uint64(i) & np.uint64(1)))) for i in range(4)]
    slots = f.slices.shape[1]
    assert slots == lid.BITS_PER_GRAM * max(map(len, kept.values()))
    for lang, b in zip(f.languages, bits):
        assert 0.8 * lid.HASHES * len(kept[lang]) <= b <= lid.HASHES * len(kept[lang])

    out = lid.language_id(docs).collect()
    truth = dict(zip(t.doc_id, t.lang))
    held = [r for r in out if r.held_out]
    assert len(out) == 1000 and len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_predictions_equal_brute_force():
    """Each n-gram looked up by itself, bit by bit, in each language's filter."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdeß"), 4)) for _ in range(300)]
    found = {f"l{i:02}": lid.grams([" ".join(words[i * 3 : i * 3 + 12])])[1] for i in range(70)}
    f = lid.build_filters(found)

    def holds(gram, i):
        return all(int(f.slices[i // 64][int(s[0])]) >> i % 64 & 1 for s in lid._slots(np.array([gram], np.uint64), f.slices.shape[1]))

    texts = [" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(40)] + [None, "", "12 3", "zzzz qqqq"]
    langs, scores = lid.predict(texts, f)
    for text, lang, score in zip(texts, langs, scores):
        if not any(map(str.isalpha, text or "")):
            assert (lang, score) == ("und", 0)
            continue
        grams = lid.grams([text])[1].tolist()
        share = []
        for i, chance in enumerate(f.false_positive):
            hits = sum(holds(g, i) for g in grams)
            share.append(min(1, max(0, (hits - len(grams) * chance) / (1 - chance) / len(grams))))
        first, second = sorted(share, reverse=True)[:2]
        assert lang == f.languages[share.index(first)]
        assert abs(score - (first * first / (first + second) if first else 0)) < 1e-9


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "the word then there this", "en", "a"), (2, "der die das und nicht", "de", "a"), (2, "der die das und nicht", "de", None), (3, None, "de", "a"), (4, "", None, None), (5, "12 %", "en", "a"), (None, "there this", None, None), (7, "x", "fr", "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", score int")
    out = lid.identify(df, lid.learn_filters(df, Scratch(spark, "test"))).collect()
    by = {(r.doc_id, i): r for i, r in enumerate(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id)))}
    langs = [r.lang_pred for r in by.values()]
    assert langs == ["en", "de", "de", "und", "und", "und", "de", "en"]
    assert [r.score for r in by.values()][3:7] == [0, 0, 0, 0]
    nothing = df.withColumn("lang", df.lang.substr(9, 1)).where("lang is null")
    assert {r.lang_pred for r in lid.identify(df, lid.learn_filters(nothing, Scratch(spark, "test"))).collect()} == {"und"}


def test_empty(spark):
    assert lid.language_id(spark.createDataFrame([], SCHEMA)).count() == 0
