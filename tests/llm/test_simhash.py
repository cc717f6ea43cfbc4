import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from farebox.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    words = []
    for ch in (text or ""):
        if ch in " \t\n\v\f\r":
            words.append("")
        else:
            words[-1:] = [(words[-1] if words else "") + (ch.lower() if "A" <= ch <= "Z" else ch)]
    words = [w for w in words if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(fingerprint, smallest id reachable) per row, over all pairs of fingerprints."""
    prints = [plain_fingerprint(r[1]) for r in rows]
    unique = np.array(sorted(set(prints)), dtype=np.uint64)
    label = np.arange(len(unique))
    near = [np.flatnonzero(np.bitwise_count(unique ^ x) <= 2) for x in unique]
    changed = True
    while changed:
        new = np.array([label[n].min() for n in near])
        changed, label = (new != label).any(), new
    group = {int(x): int(g) for x, g in zip(unique, label)}
    smallest = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            smallest[group[p]] = min(r[0], smallest.get(group[p], r[0]))
    return sorted(((r[0], f"{p:016x}", smallest.get(group[p])) for r, p in zip(rows, prints)), key=str)


def found(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprint_equals_plain_one():
    for text in (None, "", " \n\t", "a", "A b", "x y z", "É é Ab c d", "w " * 50, "a\x1cb c\x85d e"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_anchors_meet_for_every_near_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, i % 3, replace=False):
            y[i] ^= np.uint64(1 << int(bit))
    homes = simhash.homes(x).tolist()
    row, key = simhash.anchors(y)
    reached = set(zip(row.tolist(), key.tolist()))
    assert all((i, homes[i]) in reached for i in range(len(x)))


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_groups_equal_all_pairs(spark, block):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    rows = [(int(a), b, None, None, None) for a, b in zip(table.doc_id, table.text)]
    rng = random.Random(3)
    base = rows[10][1].split()
    for k in range(200):  # a large group of near copies
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = f"w{k}"
        rows.append((10_000 + k, " ".join(words), None, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(simhash.simhash_groups(df, block=block)) == plain_groups(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, None, 0), (5, "", 0), (None, "one two three four", 0), (7, "one two three four", 0), (7, "one two three four", 0), (None, "other words in this text", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumnsRenamed({"fp": "label"})
    assert found(simhash.simhash_groups(df)) == plain_groups([r[:2] for r in rows])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) in (
        sorted([(5, None), (7, rows[3][1]), (None, rows[5][1])], key=str),
        sorted([(5, ""), (7, rows[3][1]), (None, rows[5][1])], key=str),
    )


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_groups(df).count() == 0 and simhash.keep_one(df).count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from farebox.llm.shared import Scratch

    session = lambda master, folder: SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=SimpleNamespace(master=master))
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            Scratch(session(master, None), "x")
        assert Scratch(session(master, "/shared"), "x").folder.startswith("/shared/x-")
    assert Scratch(session("local[4]", None), "x").folder
