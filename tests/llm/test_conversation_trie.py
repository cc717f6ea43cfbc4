import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from farebox.llm import conversation_trie as trie

KIND = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """All prefixes as tuples of turns."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole = tuple(turns.get(base, [])[:h] + own[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved = (len(members[p]) - 1) * words + sum(below[k][0] for k in children[p])
        below[p] = (saved, sum(below[k][1] for k in children[p]) or 1)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), below[p][1], below[p][0],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def check(spark, rows, kind=KIND, extra=()):
    df = spark.createDataFrame([(*r, *extra) for r in rows], kind).repartition(5)
    out = trie.conversation_trie(df)
    assert out.schema.simpleString() == spark.createDataFrame([], trie.OUT).schema.simpleString()
    got = sorted(map(tuple, out.collect()), key=lambda r: r[:2])
    assert got == sorted(brute_force(rows), key=lambda r: r[:2])


@pytest.mark.parametrize("seed, convs, most", [(1, 80, 6), (2, 150, 3), (3, 40, 19)])
def test_equals_brute_force(spark, seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        c = rng.choice([c, c - 30, c + 10**12])
        length = rng.randrange(1, most + 1)
        rows += [(c, d, rng.choice(["u", "a"]), rng.choice(["x", "x y", "z " * 3, ""]) if d else "hi") for d in range(length)]
    check(spark, rows)


def test_long_edges_are_cut_and_extended(spark):
    # conversations that leave a long common path at every depth, end in it, and go beyond it
    rows = []
    for c in range(0, 4000, 20):
        length = c // 20 % 23 + 1
        rows += [(c, d, "u", f"t {d}") for d in range(length)] + ([(c, length, "a", f"own {c % 7}")] if c % 3 else [])
    check(spark, rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (0, None, "u", "first"), (0, 1, None, "b"), (0, 1, "u", None), (0, 1, "u", None), (0, 5, "", "c\x1cd e"),
        (20, None, "u", "first"), (20, None, "u", "first"), (21, 1, "u", "only"), (23, 3, "u", "x"), (24, 1, "u", "y"),
        (None, 1, "u", "nobody"), (None, None, None, None), (43, 1, "u", "no base"), (63, 2, "u", "no base either"),
        (80, 0, "u", "word " * 200_000), (81, 0, "u", "word " * 200_000), (80, 1, "u:", "x"), (100, 1, "u", ":x"),
    ]
    check(spark, rows, KIND + ", path string, len int, a int", ("p", 1, None))


def test_empty(spark):
    assert trie.conversation_trie(spark.createDataFrame([], KIND)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], KIND)).count() == 0


def test_sql_reads_nulls_and_ties_alike(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(120), rng.choice([None, 1, 2, 3]), rng.choice(["u", None]), rng.choice(["a b", "c", None])) for _ in range(300)]
    base = duckdb.connect()
    base.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    base.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = sorted(base.execute(trie.ORACLE).fetchall(), key=lambda r: r[:2])
    assert got == sorted(brute_force(rows), key=lambda r: r[:2])


def test_fattest(spark):
    pairs = [(l, r) for l in range(40) for r in range(l + 1, 41)] + [(-1, 0)]
    df = spark.createDataFrame(pairs, "l int, r int").withColumn("f", trie.fattest("l", "r"))
    for l, r, f in df.collect():
        assert f == max(range(l + 1, r + 1), key=lambda x: (x & -x) if x else 99)


def test_many_ends_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 2)
    check(spark, [(c, 0, "u", f"{c % 2}") for c in [*range(-80, 200, 4), 10**15]])


def test_search_is_logarithmic_and_right(spark, monkeypatch):
    """Every located path leaves the trie where a scan of all prefixes says so."""
    from farebox.llm.shared import Scratch

    rng = random.Random(6)
    rows = [(c, d, "u", rng.choice("ab") if d > 3 else "same") for c in range(0, 2000, 20) for d in range(rng.randrange(1, 14))]
    scratch = Scratch(spark, "test")
    paths = scratch.write(trie.rebuilt(trie.turns_of(spark.createDataFrame(rows, KIND))), "paths")
    end = F.element_at("path", -1)
    paths = scratch.write(paths.join(paths.groupBy(end["a"], end["b"]).agg(F.min("conv_id").alias("conv_id")).select("conv_id"), "conv_id"), "unique")
    old = paths.where("conv_id % 40 = 0")
    nodes = trie.build_trie(old, scratch)
    known = {(e["a"], e["b"]) for r in old.collect() for e in r.path}
    for r in trie.locate(paths, nodes, 13, scratch, "t").collect():
        assert r.x == max(d for d, e in enumerate(r.path) if (e["a"], e["b"]) in known)
    inner = {(r.a, r.b): (r.lo, r.hi) for r in nodes.collect()}
    for r in trie.locate(paths, nodes, 13, scratch, "t2").where("cut_a is not null").collect():
        lo, hi = inner[r.cut_a, r.cut_b]
        assert lo < r.x < hi
