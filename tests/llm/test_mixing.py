import hashlib
import math
import re
from collections import defaultdict

import pyarrow.parquet as pq

from farebox.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_chars long"


def rows_of(sf):
    t = pq.read_table(f"/root/testdata/sf{sf}/documents.parquet").to_pandas()
    return [(int(a), b, c, n) for a, b, c, n in zip(t.doc_id, t.text, t.source, t.n_chars)]


def plain_targets(sizes, weights=(5, 2, 1)):
    """The words of the contract: share, stop at twice the size, reshare until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def check(rows, out):
    size = lambda r: len(WORD.findall(r[1] or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += size(r)
    targets, taken = plain_targets(sizes), defaultdict(int)
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(r[0]), size(r)) for r in rows)
    source = {r[0]: r[2] for r in rows}
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, targets[s], rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1 + sum(r[2] == s for r in rows) * 0.02, s


def test_targets_and_sums(spark):
    for sf in ("0.001", "0.01"):
        check(rows_of(sf), mixing.mix(spark.createDataFrame(rows_of(sf), SCHEMA)).collect())


def test_equals_plain_sample(spark, monkeypatch):
    """Epochs, then documents in order of their exponential keys, over many small cells."""
    monkeypatch.setattr(mixing, "CELL_ROWS", 7)
    rows = rows_of("0.01")
    out = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    groups = defaultdict(list)
    for doc_id, text, source, _ in rows:
        u = (int(hashlib.md5(str(doc_id).encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        prose = sum(c.isalpha() or c in " \t\n\v\f\r" for c in text)
        weight = 0.5 + 0.5 * (prose + 1) / (len(text) + 1)
        groups[source].append((-math.log(u) / weight, doc_id))
    for docs in groups.values():
        first = out[docs[0][1]]
        epochs, left = divmod(round(first.target), first.source_size)
        for _, doc_id in sorted(docs):
            r = out[doc_id]
            assert r.taken == epochs * r.size + min(r.size, left)
            left -= min(r.size, left)


def test_reruns_agree_and_documents_follow(spark):
    rows = rows_of("0.01")
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
    assert one == sorted(map(tuple, mixing.mix(df.repartition(3, "doc_id")).collect()))
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns
    words = defaultdict(int)
    for r in docs.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert dict(words) == {r[0]: r[4] for r in one if r[4]}


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "a", 0), (2, "", "a", 0), (None, "w " * 30, None, 0), (None, "w " * 30, None, 0), (4, "x y", "b", 0), (5, "only", "c", 0)]
    rows += [(6, "r " * 9, "d", 0)] * 5
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "target")
    out = mixing.mix(df).collect()
    check(rows, out)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.where("text is null or text = ''").count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 0), (2, " ", None, 0)], SCHEMA)
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mix(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
