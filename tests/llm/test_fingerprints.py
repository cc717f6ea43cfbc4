import hashlib
import random

import numpy as np
import pytest

from farebox.llm import fingerprints
from farebox.llm.prefix_hash import BASES, BLOCK, PRIMES, Joined, Text


def plain_hash(text, base, prime):
    return sum((ord(c) + 1) * pow(base, i, prime) for i, c in enumerate(text)) % prime


def plain_fingerprint(text):
    """The fingerprint from each span's own sum, without prefix arrays."""
    n, low = len(text), {}
    width = min(fingerprints.SPAN, n)
    for i in range(n - width + 1 if n else 0):
        a, b = (plain_hash(text[i : i + width], base, prime) for base, prime in zip(BASES, PRIMES))
        x = a << 31 | b
        for m in fingerprints.MIX:
            x = (x ^ x >> 33) * m & 2**64 - 1
        x ^= x >> 33
        slot, value = x >> 57, x & 2**57 - 1
        low[slot] = min(low.get(slot, value), value)
    digits = "".join(f"{low[s] % 15 + 1:x}" if s in low else "0" for s in range(fingerprints.SLOTS))
    return "".join(f"{plain_hash(text, b, p):08x}" for b, p in zip(BASES, PRIMES)) + digits


def plain_likeness(a, b):
    if a == b:
        return 1.0
    pairs = list(zip(a[16:], b[16:]))
    either = sum(x != "0" or y != "0" for x, y in pairs)
    both = sum(x != "0" and y != "0" for x, y in pairs)
    equal = sum(x == y != "0" for x, y in pairs)
    share = min(1.0, max(0.0, (equal - both / 15) * 15 / 14 / either)) if either else 1.0
    return 2 * share / (1 + share)


def common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute_force(rows):
    """Sorted by descending id, nulls last, then by digest; each is compared with the one after it."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).digest()))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = [plain_fingerprint(t) for t in (text, edited, after)]
        near = [plain_likeness(marks[0], m) for m in marks[1:]]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks[:2], *near, common(text, edited), common(text, after)))
    return out


def check(df, rows, **options):
    out = sorted(map(tuple, fingerprints.fingerprints(df, **options).collect()), key=str)
    want = sorted(brute_force(rows), key=str)
    assert len(out) == len(want)
    for a, b in zip(out, want):
        assert a[:5] == b[:5] and a[7:] == b[7:]
        assert a[5:7] == pytest.approx(b[5:7], abs=1e-9)


def test_spans_and_extensions():
    rng = random.Random(1)
    text = "".join(rng.choice("ab\U0001f600é") for _ in range(3000))
    other = text[500:900] + "!" + text[:700]
    a, b = Text(text), Text(other)
    for _ in range(300):
        i, j, n = rng.randrange(3000), rng.randrange(1100), rng.randrange(40)
        n = min(n, 3000 - i, 1101 - j)
        assert (a.span(i, n) == b.span(j, n)) == (text[i : i + n] == other[j : j + n])
        assert a.common(b, i, j) == common(text[i:], other[j:])
    assert a.common(b, 500) == 400 and a.common(b, 0, 401) == 700


@pytest.mark.parametrize("cut, rest", [(0, 5), (5, 0), (BLOCK - 3, 20), (BLOCK + 7, BLOCK), (10, BLOCK + 30)])
def test_joined_and_blocks(cut, rest):
    rng = random.Random(2)
    first, second = ("".join(rng.choices("abcdefgh ", k=2 * BLOCK + 50)) for _ in range(2))
    joined, whole = Joined(Text(first), cut, Text(second), rest), Text(first[:cut] + second[:rest])
    assert joined.n == whole.n
    for which in range(2):
        assert (joined.entries(which, 0, whole.n + 1) == whole.entries(which, 0, whole.n + 1)).all()
    if whole.n > 16:
        for x, y in zip(joined.windows(16), whole.windows(16), strict=True):
            assert (x == y).all()
    assert fingerprints.fingerprint(joined)[0] == fingerprints.fingerprint(whole)[0]
    plain = tuple(plain_hash(first[:cut] + second[:rest], b, p) for b, p in zip(BASES, PRIMES))
    assert whole.span(0, whole.n) == plain


@pytest.mark.parametrize("range_rows", [1, 7, 1000])
def test_equals_brute_force(spark, range_rows):
    rng = random.Random(range_rows)
    word = lambda: "".join(rng.choices("abcdefé日", k=5))
    pool = ["", "x", "ab", "short", " ".join(word() for _ in range(60))]
    rows = [(rng.choice([*range(-3, 30), None]), rng.choice([None, *pool, " ".join(word() for _ in range(rng.randrange(80)))])) for _ in range(60)]
    rows += [(2**62, "big id"), (-(2**62), "small id"), (7, pool[-1]), (7, pool[-1])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, last int, sha string").repartition(5)
    check(df, rows, range_rows=range_rows)


def test_one_row_and_none(spark):
    for rows in ([(None, None)], [(4, "only one text here, twice as long as a span")], []):
        check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_halves_and_copies_are_alike_and_others_are_not():
    rng = random.Random(9)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=4000)) for _ in range(12)]
    near, far = [], []
    for a, b in zip(texts, texts[1:]):
        x, y = Text(a), Text(b)
        (_, own), (_, edited), (_, other) = map(fingerprints.fingerprint, (x, Joined(x, 2000, y, 2000), y))
        near.append(fingerprints.likeness(own, edited))
        far.append(fingerprints.likeness(own, other))
    assert abs(np.mean(near) - 1 / 2) < 0.05 and np.mean(far) < 0.08
    changed = texts[0][:1000] + "#" + texts[0][1001:]
    assert fingerprints.likeness(fingerprints.sketch(Text(texts[0])), fingerprints.sketch(Text(changed))) > 0.9


def test_very_long_text(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh \n", k=300_000))
    rows = [(1, long), (2, "short"), (3, long[:-1] + "#")]
    out = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].common_next == 299_999 and out[1].near_next > 0.95 and out[1].n_chars == 300_000
    assert out[3].edited_sha256 == hashlib.sha256((long[:150_000] + "short").encode()).hexdigest()
    assert out[3].common_edited == 150_000 + common(long[150_000:], "short")
