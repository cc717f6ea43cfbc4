"""All prefixes that conversations share, from a z-fast trie of their turns.

The trie is compacted: a node stands for an edge of prefixes with the same
conversations. A prefix is known by a 128-bit key of its turns. A table of nodes
is searched by their handles, the key at the two-fattest depth of the edge, so a
conversation finds where it leaves the trie in logarithmic many lookups. Each
batch of conversations is located, cuts edges where they leave, and hangs on what
is new. Only at the end are the edges expanded to single prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.shared import Scratch, table

BLANKS = r"[\x20\x09-\x0D]+"
#: A conversation borrows up to ``BORROWED`` - 1 turns of the one at the start of its family of ids.
FAMILY, BORROWED = 20, 4
#: Shares of the conversations that are inserted together, in quarters: later batches meet a larger trie.
QUARTERS = ((0,), (1,), (2, 3))
#: Ids of one packed chunk of a digest lie in a range of 2 ** CHUNK_BITS.
CHUNK_BITS = 16
#: Lookups after which the state of a search is written, to keep plans short.
LOOKUPS = 6
#: The edge of the root: the empty prefix.
ROOT = "array(named_struct('depth', 0, 'a', 0L, 'b', 0L, 'parent_a', cast(null as long), 'parent_b', cast(null as long), 'words', 0L, 'sum', 0L))"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, rank (from 1), digest of role and text, words: one row per turn, without its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        F.size(F.array_remove(F.split(text, BLANKS), "")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("rank"), "digest", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, len, path.

    ``path[d]`` has the key (a, b) of the first d turns, the words of the d-th turn
    and of all d. A key is the exclusive or of a hash of each turn with its place.
    """
    borrows = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", borrows.alias("h"))
    own = turns.where(F.col("rank") > borrows)
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("rank") < BORROWED)).withColumnRenamed("conv_id", "base")
    wanting = convs.where("h > 0").withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    borrowed = wanting.join(heads, "base").where("rank <= h").select("conv_id", "rank", "digest", "words")
    order = Window.partitionBy("conv_id").orderBy("rank")
    placed = own.union(borrowed).withColumn("depth", F.row_number().over(order))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = placed.select(
        "conv_id",
        "depth",
        F.bit_xor(F.xxhash64("digest", "depth")).over(running).alias("a"),
        F.bit_xor(F.xxhash64("depth", "digest", F.lit(7))).over(running).alias("b"),
        "words",
        F.sum("words").over(running).alias("sum"),
    )
    steps = keyed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "a", "b", "words", "sum"))).alias("steps"))
    start = F.array(F.struct(*[F.lit(0).cast(t).alias(c) for c, t in (("depth", "int"), ("a", "long"), ("b", "long"), ("words", "long"), ("sum", "long"))]))
    path = F.when(F.isnull("steps"), start).otherwise(F.concat(start, "steps"))
    all_convs = convs.join(steps, "conv_id", "left").select("conv_id", path.alias("path"))
    return all_convs.select("conv_id", (F.size("path") - 1).alias("len"), "path")


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    bits = f"length(bin(cast({low} as bigint) ^ cast({high} as bigint))) - 1"
    return F.expr(f"cast(shiftleft(shiftright(cast({high} as bigint), {bits}), {bits}) as int)")


def _same(x: Column, y: Column) -> Column:
    return (x["a"] == y["a"]) & (x["b"] == y["b"])


def _nodes(edges: DataFrame) -> DataFrame:
    """Nodes of the trie from their edges: id (a, b), parent, lo, hi, edge of the depths in (lo, hi]."""
    first, last = F.element_at("edge", 1), F.element_at("edge", -1)
    return edges.select(
        last["a"].alias("a"), last["b"].alias("b"), first["parent_a"].alias("parent_a"), first["parent_b"].alias("parent_b"),
        (first["depth"] - 1).alias("lo"), last["depth"].alias("hi"), "edge",
    )


def _pieces(edge: str, lo: str, cuts: str) -> Column:
    """``edge`` in pieces that end at the sorted depths ``cuts``, the last of which is its own end."""

    def piece(end: Column, i: Column) -> Column:
        start = F.coalesce(F.get(cuts, i - 1), F.col(lo))
        return F.slice(edge, start - F.col(lo) + 1, end - start)

    return F.transform(cuts, piece)


def _lookup(state: DataFrame, nodes: DataFrame, depth: Column, at: Column) -> DataFrame:
    """``state`` with the node whose key is the path's at ``depth``, and ``m``, how deep the path follows its edge.

    ``at`` is the element of a node's edge that holds its key.
    """
    probe = F.get("path", depth)
    keyed = nodes.select(at["a"].alias("at_a"), at["b"].alias("at_b"), F.col("a").alias("id_a"), F.col("b").alias("id_b"), "lo", "hi", "edge")
    found = state.withColumns({"probe_a": probe["a"], "probe_b": probe["b"]})
    found = found.join(keyed, (F.col("probe_a") == F.col("at_a")) & (F.col("probe_b") == F.col("at_b")), "left")
    follows = F.filter("edge", lambda e: F.coalesce(_same(F.get("path", e["depth"]), e), F.lit(False)))
    return found.withColumn("m", F.when(F.col("hi").isNotNull(), F.col("lo") + F.size(follows)))


def locate(paths: DataFrame, nodes: DataFrame, longest: int, scratch: Scratch, label: str) -> DataFrame:
    """``paths`` with x, the depth at which each leaves the trie, and cut_a, cut_b, the node whose edge x is inside of.

    Fat binary search on (l, r]: at the two-fattest depth f of the interval the
    node with that handle is looked up. If the path follows it to its end, so does the search; if
    only in part, the path leaves there; without one, r drops below f. An edge whose handle lies
    beyond r is met last, as the child of the node that the search ends at.
    """
    columns = [*paths.columns, "l", "r", "cut_a", "cut_b"]
    none = F.lit(None).cast("long")
    state = paths.withColumns({"l": F.lit(0), "r": F.col("len"), "cut_a": none, "cut_b": none})
    handle = F.get("edge", fattest("lo", "hi") - F.col("lo") - 1)
    for k in range(longest.bit_length()):
        active, f = F.col("l") < F.col("r"), fattest("l", "r")
        # a search that is over looks its own end up, so that no key collects them
        found = _lookup(state, nodes, F.when(active, f).otherwise(F.col("len")), handle)
        hit = active & F.col("hi").isNotNull()
        inside = hit & (F.col("m") < F.col("hi"))
        after = {
            "l": F.when(hit, F.col("m")).otherwise(F.col("l")),
            "r": F.when(inside, F.col("m")).when(active & ~hit, f - 1).otherwise(F.col("r")),
            "cut_a": F.when(inside, F.col("id_a")).otherwise(F.col("cut_a")),
            "cut_b": F.when(inside, F.col("id_b")).otherwise(F.col("cut_b")),
        }
        state = found.select(*paths.columns, *[c.alias(name) for name, c in after.items()])
        if k % LOOKUPS == LOOKUPS - 1:
            state = scratch.write(state, f"{label}-search{k}")
    open_ = F.isnull("cut_a") & (F.col("l") < F.col("len"))
    found = _lookup(state, nodes, F.when(open_, F.col("l") + 1).otherwise(F.col("len")), F.get("edge", F.lit(0)))
    hit = open_ & F.col("hi").isNotNull()
    after = {
        "l": F.when(hit, F.col("m")).otherwise(F.col("l")),
        "r": F.col("r"),
        "cut_a": F.when(hit, F.col("id_a")).otherwise(F.col("cut_a")),
        "cut_b": F.when(hit, F.col("id_b")).otherwise(F.col("cut_b")),
    }
    state = found.select(*paths.columns, *[c.alias(name) for name, c in after.items()])
    return state.select(*columns).withColumnRenamed("l", "x").drop("r")


def insert(located: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes after a located batch: edges cut where paths leave them, and edges of what is new."""
    cuts = located.where("cut_a is not null").groupBy("cut_a", "cut_b").agg(F.collect_set("x").alias("xs"))
    cut = nodes.join(cuts, (F.col("a") == F.col("cut_a")) & (F.col("b") == F.col("cut_b")), "left")
    ends = F.array_sort(F.array_union(F.coalesce("xs", F.array().cast("array<int>")), F.array("hi")))
    old = cut.select("edge", "lo", ends.alias("ends")).select(F.explode(_pieces("edge", "lo", "ends")).alias("edge"))

    depths = F.explode(F.sequence(F.col("x") + 1, F.col("len"))).alias("depth")
    rows = located.where("len > x").select("conv_id", "path", depths)
    here, before, after = (F.get("path", F.col("depth") + k) for k in (0, -1, 1))
    rows = rows.select(
        "conv_id", "depth", here["a"].alias("a"), here["b"].alias("b"), before["a"].alias("parent_a"), before["b"].alias("parent_b"),
        after["a"].alias("next_a"), after["b"].alias("next_b"), here["words"].alias("words"), here["sum"].alias("sum"),
    )
    # a prefix ends a node where a path ends or paths part; the smallest id of those through it owns it
    stops = F.max(F.isnull("next_a")) | (F.min("next_a") != F.max("next_a")) | (F.min("next_b") != F.max("next_b"))
    same = [F.any_value(c).alias(c) for c in ("depth", "parent_a", "parent_b", "words", "sum")]
    prefixes = rows.groupBy("a", "b").agg(F.min("conv_id").alias("owner"), stops.alias("stops"), *same)
    run = F.sort_array(F.collect_list(F.struct("depth", "a", "b", "parent_a", "parent_b", "words", "sum", "stops")))
    runs = prefixes.groupBy("owner").agg(run.alias("run"))
    # an owner owns all depths from its first to its end, and all of an edge has one owner
    keep = ("depth", "a", "b", "parent_a", "parent_b", "words", "sum")
    runs = runs.select(
        F.transform("run", lambda e: F.struct(*[e[c].alias(c) for c in keep])).alias("edge"),
        (F.element_at("run", 1)["depth"] - 1).alias("lo"),
        F.transform(F.filter("run", lambda e: e["stops"]), lambda e: e["depth"]).alias("ends"),
    )
    new = runs.select(F.explode(_pieces("edge", "lo", "ends")).alias("edge"))
    return _nodes(old.union(new))


def _digests(paths: DataFrame) -> DataFrame:
    """ends_sha256 per key of a whole conversation.

    Ids are packed in chunks first. SHA-256 is sequential, so the chunks of one key pass
    through one task, in order and as a stream: memory stays bounded by a chunk.
    """
    end = F.element_at("path", -1)
    ids = paths.select(end["a"].alias("a"), end["b"].alias("b"), F.shiftright("conv_id", CHUNK_BITS).alias("chunk"), "conv_id")
    packed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ids.groupBy("a", "b", "chunk").agg(packed.alias("ids"))
    in_order = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "chunk")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for a, b, ids in batch[["a", "b", "ids"]].itertuples(index=False):
                if key != (a, b):
                    out += [(*key, state.hexdigest())] if key else []
                    key, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=["a", "b", "ends_sha256"])

    return in_order.mapInPandas(run, "a long, b long, ends_sha256 string")


def build_trie(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of the compacted trie of ``paths``, which are all different."""
    spark = paths.sparkSession
    longest = paths.agg(F.max("len")).first()[0] or 0
    nodes = _nodes(spark.range(1).select(F.expr(ROOT).alias("edge")))
    quarter = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    for k, quarters in enumerate(QUARTERS):
        batch = paths.where(quarter.isin(*quarters)).select("conv_id", "len", "path")
        if k:
            located = scratch.write(locate(batch, nodes, longest, scratch, f"{k}"), f"{k}-located")
        else:  # all leave the empty trie at its root
            none = F.lit(None).cast("long")
            located = batch.withColumns({"x": F.lit(0), "cut_a": none, "cut_b": none})
        nodes = scratch.write(insert(located, nodes), f"{k}-nodes")
    return nodes


def measure(nodes: DataFrame, paths: DataFrame, scratch: Scratch) -> DataFrame:
    """Per node: conv_id, n_convs, n_leaves and saved (saved tokens at its end).

    ``paths`` has n, how many conversations are equal to each. All are sums over paths,
    partially aggregated. Saved words of a subtree are those of all members less
    those of all its prefixes, and a prefix is counted with the member that owns it.
    """
    ids = nodes.select("a", "b", "lo")
    steps = paths.select("conv_id", F.explode("path").alias("at")).select("conv_id", "at.depth", "at.a", "at.b")
    passed = steps.join(ids, ["a", "b"]).groupBy("conv_id").agg(F.collect_list(F.struct("depth", "lo")).alias("nodes"))
    paths = scratch.write(paths.join(passed, "conv_id"), "passed")
    through = paths.select("conv_id", "n", "len", "path", F.inline("nodes"))
    at = F.get("path", F.col("depth"))
    members = through.select("conv_id", "n", "len", "depth", "lo", at["a"].alias("a"), at["b"].alias("b")).groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("lo").alias("lo"), (F.max("len") == F.min("depth")).alias("childless"),
    )
    members = scratch.write(members, "members")
    owned = members.groupBy("conv_id").agg((F.min("lo") + 1).alias("since"), F.max("childless").alias("leaf"))
    through = paths.join(owned, "conv_id", "left").select("n", "len", "path", "since", "leaf", F.inline("nodes"))
    from_ = lambda d: F.element_at("path", -1)["sum"] - F.get("path", d)["sum"] + F.get("path", d)["words"]
    sums = through.select(
        at["a"].alias("a"),
        at["b"].alias("b"),
        (F.col("n") * from_(F.col("depth"))).alias("all"),
        F.when(F.isnull("since"), 0).otherwise(from_(F.greatest("depth", "since"))).alias("once"),
        F.coalesce(F.col("leaf").cast("long"), F.lit(0)).alias("leaf"),
    ).groupBy("a", "b").agg(F.sum(F.col("all") - F.col("once")).alias("saved"), F.sum("leaf").alias("n_leaves"))
    return members.select("a", "b", "conv_id", "n_convs").join(sums, ["a", "b"])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per prefix of the rebuilt conversations: the nodes of their (uncompacted) trie.

    A conversation c starts with the first h turns of conversation c - c % 20
    (h = crc32 of the decimal c, modulo 4) and goes on with its own turns after the first
    h. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Equal conversations collapse to one path with a count before the trie is
    built. A conversation is one record: the keys of its turns (not their texts) meet in one row.

    Defined cases: a null turn comes first; equal turn numbers stand in the order of the SHA-256
    of role and text, so repeated rows are turns one after the other. A null role
    or text is empty. Rows without conv_id belong to no conversation and are left
    out. Texts of any length are hashed whole where they are read. Other columns
    are not read. No conversations give no rows, not even the root.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    turns = scratch.write(turns_of(conversations), "turns")
    every = scratch.write(rebuilt(turns), "every")
    scratch.drop("turns")
    end = F.element_at("path", -1)
    firsts = every.groupBy(end["a"].alias("a"), end["b"].alias("b")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    paths = scratch.write(every.join(firsts.select("conv_id", "n"), "conv_id"), "paths")
    if paths.isEmpty():
        return spark.createDataFrame([], OUT)
    nodes = build_trie(paths, scratch)
    measured = scratch.write(measure(nodes, paths, scratch), "measured")

    of = ["a", "b"]
    parent = ["parent_a", "parent_b"]
    children = nodes.where("parent_a is not null").groupBy(*parent).agg(F.count("*").alias("children"))
    children = children.toDF(*of, "children")
    above = measured.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("above"))
    whole = nodes.join(measured, of).join(children, of, "left").join(_digests(every), of, "left").join(above, parent, "left")
    last = F.element_at("edge", -1)
    rows = whole.select("*", F.explode("edge").alias("at"))
    ends, starts = F.col("at")["depth"] == F.col("hi"), F.col("at")["depth"] == F.col("lo") + 1
    inner = (last["sum"] - last["words"]) - (F.col("at")["sum"] - F.col("at")["words"])
    return rows.select(
        "conv_id",
        F.col("at")["depth"].cast("long").alias("depth"),
        F.when(starts, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(ends, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * inner).alias("saved_tokens"),
        F.when(ends, F.col("ends_sha256")).alias("ends_sha256"),
    ).fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])


OUT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)

#: The checksum is folded over the bytes of the decimal id, bit by bit, with the reversed polynomial of CRC-32.
ORACLE = """
WITH t AS (
  SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS rank FROM t
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, (4294967295 - list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(str_split(CAST(conv_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
    lambda c, s: list_reduce([xor(c, s), 1, 1, 1, 1, 1, 1, 1, 1],
      lambda d, i: xor(d >> 1, CASE WHEN d & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, rank, digest, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND rank > h
  UNION ALL
  SELECT c.conv_id, rank, digest, words FROM convs c JOIN turns t ON t.conv_id = c.base AND rank <= h
), p AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, row_number() OVER w, string_agg(digest, '') OVER w, words FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY rank)
), ends AS (
  SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM p GROUP BY conv_id) GROUP BY prefix
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY prefix, depth
), linked AS (
  SELECT n.*, CASE WHEN n.depth > 0 THEN substr(prefix, 1, 64 * (CAST(n.depth AS INTEGER) - 1)) END AS parent FROM nodes n
), children AS (
  SELECT parent AS prefix, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT a.prefix, sum((v.n_convs - 1) * v.words) AS saved, count(*) FILTER (WHERE c.prefix IS NULL) AS n_leaves
  FROM linked v JOIN p a ON a.conv_id = v.conv_id AND a.depth <= v.depth LEFT JOIN children c ON c.prefix = v.prefix
  GROUP BY a.prefix
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM linked n LEFT JOIN nodes u ON u.prefix = n.parent LEFT JOIN children c ON c.prefix = n.prefix
LEFT JOIN ends e ON e.prefix = n.prefix JOIN sums s ON s.prefix = n.prefix
"""


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
