"""Prefix trie of conversations and totals of its subtrees by parallel tree contraction.

Each conversation is a sequence of turns (role, text); a node is a distinct sequence of
first turns.  Nodes are found without a trie in memory: turns are numbered and hashed by
blocks whose carries are added up afterwards, and a prefix is the exclusive-or of two
64-bit hashes of (role, text, place) per turn, so that equal prefixes of all conversations
meet in one aggregate.

Subtree totals come from rounds on the table of live nodes.  A round compresses every
chain of nodes with one live child into the edge above the chain's end, then rakes all
leaves into their parents; what is left has fewer than half the nodes.  Chains are summed
inside blocks of places by windows and then across blocks by pointer doubling.  When only
the root is left, the rounds are undone in reverse: a compressed node's total is what its
chain held below it plus the total of the chain's end.  Every join is on a key that is
unique on one side; edges to nodes with very many children are met apart.

Turns are ordered by turn, null first; ties by a hash of role and text, so repeated rows
are repeated turns.  Null role or text is empty.  Rows without conv_id belong to no
conversation.  Negative ids are allowed.  Empty table: no rows.  Other columns are not
read.  The members that end at one node are hashed in one stream, as SHA-256 must be, in
constant memory; lists of ids are joined beforehand in bounded pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import crc32_of, read_table, staged

BLOCK = 4096  # places of a chain or conversation that one window holds
HEAVY = 1000  # a node with over 1/HEAVY of all edges is met apart: fewer than HEAVY nodes
PIECE = 1 << 14  # ids joined to one string
SHARED = 6  # a conversation takes fewer than so many turns from its base
MOST_ROUNDS = 64


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, local, a, b, chars): turns in order, numbered from 1 in each part.

    Parts are ranges of (conv_id, order), so a long conversation has many.  Rows that are
    equal in all these columns are interchangeable, so a row number may split them.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = [F.asc_nulls_first("turn"), "a", "b"]
    turns = (
        conversations.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.xxhash64(F.lit(1), role, text).alias("a"),
            F.xxhash64(F.lit(2), role, text).alias("b"),
            F.length(text).cast("bigint").alias("chars"),
            F.monotonically_increasing_id().alias("row"),
        )
        .repartitionByRange("conv_id", *order, "row")
        .withColumn("part", F.spark_partition_id())
    )
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return turns.withColumn("local", local.cast("bigint")).drop("turn", "row")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share the first turns of conversation c - c % 100.

    Returns (conv_id, place, a, b, chars, last) and (conv_id, turns), one row per id.
    ``turns`` is read several times and should be stored.
    """
    counts = turns.groupBy("conv_id", "part").agg(F.max("local").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = counts.groupBy("conv_id").agg(F.sum("n").alias("n_own"))
    convs = (
        sizes.select(
            "conv_id",
            "n_own",
            (crc32_of(F.col("conv_id").cast("string")) % SHARED).alias("h"),
            (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
        )
        .join(sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base")), "base", "left")
        .withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
        .withColumn("turns", F.col("shared") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
        .drop("n_base")
    )
    parts = counts.select(
        "conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    ).join(convs, "conv_id")
    placed = turns.join(parts, ["conv_id", "part"]).withColumn(
        "rank", F.col("offset") + F.col("local") - 1
    )
    own = placed.where("rank >= h").withColumn("place", F.col("shared") + F.col("rank") - F.col("h"))
    heads = placed.where(f"rank < {SHARED} and conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.col("rank").alias("place"), "a", "b", "chars"
    )
    inherited = convs.join(heads, "base").where("place < shared")
    columns = ["conv_id", "place", "a", "b", "chars", (F.col("place") == F.col("turns") - 1).alias("last")]
    return own.select(*columns).unionByName(inherited.select(*columns)), convs.select(
        "conv_id", "turns"
    )


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars, last): key of each prefix and of its parent."""
    hashed = rebuilt.select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        F.floor(F.col("place") / BLOCK).alias("block"),
        F.xxhash64("a", "b", "place", F.lit(1)).alias("x1"),
        F.xxhash64("b", "a", "place", F.lit(2)).alias("x2"),
        "chars",
        "last",
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        hashed.groupBy("conv_id", "block")
        .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
        .select(
            "conv_id",
            "block",
            F.bit_xor("x1").over(before).alias("c1"),
            F.bit_xor("x2").over(before).alias("c2"),
        )
        .where("block > 0")
    )
    keyed = hashed.withColumns(
        {f"s{i}": F.bit_xor(f"x{i}").over(upto) for i in (1, 2)}
    ).join(carried, ["conv_id", "block"], "left")
    key = [F.col(f"s{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)]
    return keyed.select(
        "conv_id",
        "depth",
        *[key[i].alias(f"k{i + 1}") for i in (0, 1)],
        *[key[i].bitwiseXOR(F.col(f"x{i + 1}")).alias(f"p{i + 1}") for i in (0, 1)],
        "chars",
        "last",
    )


def trie_nodes(keyed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, parent_conv_id, n_convs, n_children, chars), root included.

    ``keyed`` is read several times and should be stored.
    """
    nodes = keyed.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        F.lit(0).cast("bigint").alias("depth"),
        *[F.lit(0).cast("bigint").alias(k) for k in ("k1", "k2")],
        "conv_id",
        "n_convs",
        F.lit(0).cast("bigint").alias("chars"),
        *[F.lit(None).cast("bigint").alias(p) for p in ("p1", "p2")],
    )
    nodes = nodes.unionByName(root.where("conv_id is not null"))
    n_children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = staged(
        nodes.join(n_children, ["depth", "k1", "k2"], "left").fillna(0, ["n_children"]), "nodes"
    )
    most = nodes.count() // HEAVY + 1
    above = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
        "n_children",
    )
    edge = ["depth", "p1", "p2"]
    # Numbers of children add up to the number of nodes: fewer than HEAVY rows here.
    heavy = F.broadcast(above.where(F.col("n_children") > most).drop("n_children"))
    light = above.where(F.col("n_children") <= most).drop("n_children")
    children = nodes.where("depth > 0")
    met = children.join(heavy, edge).unionByName(
        children.join(heavy, edge, "left_anti").join(light, edge)
    )
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    return met.unionByName(top.select(*met.columns)).drop("p1", "p2")


def _end(name: str) -> list[Column]:
    return [F.col(f"{name}_conv").alias("conv_id"), F.col(f"{name}_depth").alias("depth")]


def _compress(unary: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contract all chains of nodes with one live child.

    Returns per node (conv_id, depth, seg_conv, seg_depth, sums from it to the end of its
    segment), per segment (seg_conv, seg_depth, end_conv, end_depth, sums beyond it), and
    per chain (conv_id, depth of its end, the parent and sums the end takes over).
    """
    block = Window.partitionBy("conv_id", F.floor(F.col("depth") / BLOCK)).orderBy(F.desc("depth"))
    linked = (F.col("next_conv") == F.col("conv_id")) & (
        F.col("next_depth") == F.lag("depth").over(block)
    )
    cut = unary.withColumn("cut", F.when(linked, 0).otherwise(1)).withColumn(
        "segment", F.sum("cut").over(block)
    )
    same = Window.partitionBy(
        "conv_id", F.floor(F.col("depth") / BLOCK), "segment"
    ).orderBy(F.desc("depth"))
    inner = staged(
        cut.select(
            "conv_id",
            "depth",
            F.col("conv_id").alias("seg_conv"),
            F.first("depth").over(same).alias("seg_depth"),
            F.sum(F.col("leaves") + F.col("next_up_leaves")).over(same).alias("leaves"),
            F.sum(F.col("saved") + F.col("next_up_saved")).over(same).alias("saved"),
            *["p_conv", "p_depth", "up_leaves", "up_saved"],
            F.first("next_conv").over(same).alias("end_conv"),
            F.first("next_depth").over(same).alias("end_depth"),
        ),
        "chains",
    )
    # The top of a segment has all of its sums.
    top = inner.groupBy("seg_conv", "seg_depth").agg(
        F.min_by(
            F.struct("depth", "leaves", "saved", "p_conv", "p_depth", "up_leaves", "up_saved"),
            "depth",
        ).alias("top"),
        F.first("end_conv").alias("end_conv"),
        F.first("end_depth").alias("end_depth"),
    )
    segments = staged(
        top.select(
            "seg_conv",
            "seg_depth",
            F.col("top.depth").alias("top_depth"),
            "end_conv",
            "end_depth",
            F.col("end_conv").alias("first_conv"),
            F.col("end_depth").alias("first_depth"),
            *[F.col(f"top.{c}").alias(c) for c in ("leaves", "saved", "p_conv", "p_depth", "up_leaves", "up_saved")],
            F.lit(0).cast("bigint").alias("beyond_leaves"),
            F.lit(0).cast("bigint").alias("beyond_saved"),
            F.lit(True).alias("moved"),
        ),
        "segments",
    )
    # An end that is the top of another segment points on to that segment's own end.
    for _ in range(MOST_ROUNDS):
        onward = segments.select(
            F.col("seg_conv").alias("end_conv"),
            F.col("top_depth").alias("end_depth"),
            F.col("end_conv").alias("to_conv"),
            F.col("end_depth").alias("to_depth"),
            *[(F.col(c) + F.col(f"beyond_{c}")).alias(f"add_{c}") for c in ("leaves", "saved")],
        )
        joined = segments.join(onward, ["end_conv", "end_depth"], "left")
        segments = staged(
            joined.select(
                *["seg_conv", "seg_depth", "top_depth", "first_conv", "first_depth"],
                *[F.coalesce(f"to_{c}", f"end_{c}").alias(f"end_{c}") for c in ("conv", "depth")],
                *["leaves", "saved", "p_conv", "p_depth", "up_leaves", "up_saved"],
                *[
                    (F.col(f"beyond_{c}") + F.coalesce(f"add_{c}", F.lit(0))).alias(f"beyond_{c}")
                    for c in ("leaves", "saved")
                ],
                F.col("to_conv").isNotNull().alias("moved"),
            ),
            "segments",
        )
        if segments.where("moved").isEmpty():
            break
    else:
        raise RuntimeError("chains did not settle")
    # The first segment of a chain is no other segment's next one.
    pointed = segments.select(
        F.col("first_conv").alias("seg_conv"), F.col("first_depth").alias("top_depth")
    )
    ends = segments.join(pointed, ["seg_conv", "top_depth"], "left_anti").select(
        *_end("end"),
        F.col("p_conv").alias("new_conv"),
        F.col("p_depth").alias("new_depth"),
        *[
            (F.col(f"up_{c}") + F.col(c) + F.col(f"beyond_{c}")).alias(f"new_{c}")
            for c in ("leaves", "saved")
        ],
    )
    return inner.drop("p_conv", "p_depth", "up_leaves", "up_saved"), segments, ends


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(conv_id, depth, leaves, saved): sums over each subtree, its top included.

    ``tree`` has one row per node: conv_id, depth (together its name), p_conv, p_depth
    (null for the one root), leaves, saved (its own amounts).
    """
    key = ["conv_id", "depth"]
    live = tree.select(
        *key,
        "p_conv",
        "p_depth",
        "leaves",
        "saved",
        F.lit(0).cast("bigint").alias("up_leaves"),
        F.lit(0).cast("bigint").alias("up_saved"),
    )
    done: list[DataFrame] = []
    rounds: list[tuple[DataFrame, DataFrame]] = []
    for _ in range(MOST_ROUNDS):
        below = (
            live.where("p_conv is not null")
            .groupBy(*_end("p"))
            .agg(
                F.count(F.lit(1)).alias("n_live"),
                F.max(F.struct("depth", "conv_id", "up_leaves", "up_saved")).alias("next"),
            )
        )
        state = staged(
            live.join(below, key, "left").select(
                *live.columns,
                F.coalesce("n_live", F.lit(0)).alias("n_live"),
                F.col("next.conv_id").alias("next_conv"),
                F.col("next.depth").alias("next_depth"),
                F.col("next.up_leaves").alias("next_up_leaves"),
                F.col("next.up_saved").alias("next_up_saved"),
            ),
            "state",
        )
        inner_node = F.col("p_conv").isNotNull()
        inner, segments, ends = _compress(state.where(inner_node & (F.col("n_live") == 1)))
        rounds.append((inner, segments))
        rest = staged(
            state.where(~inner_node | (F.col("n_live") != 1))
            .join(ends, key, "left")
            .select(
                *key,
                F.coalesce("new_conv", "p_conv").alias("p_conv"),
                F.coalesce("new_depth", "p_depth").alias("p_depth"),
                "leaves",
                "saved",
                # The chain's sums hold what the end carried before.
                F.coalesce("new_leaves", "up_leaves").alias("up_leaves"),
                F.coalesce("new_saved", "up_saved").alias("up_saved"),
                "n_live",
            ),
            "rest",
        )
        leaf = inner_node & (F.col("n_live") == 0)
        raked = rest.where(leaf)
        done.append(raked.select(*key, "leaves", "saved"))
        given = raked.groupBy(*_end("p")).agg(
            F.sum(F.col("leaves") + F.col("up_leaves")).alias("add_leaves"),
            F.sum(F.col("saved") + F.col("up_saved")).alias("add_saved"),
        )
        live = staged(
            rest.where(~leaf)
            .join(given, key, "left")
            .select(
                *key,
                "p_conv",
                "p_depth",
                *[
                    (F.col(c) + F.coalesce(f"add_{c}", F.lit(0))).alias(c)
                    for c in ("leaves", "saved")
                ],
                "up_leaves",
                "up_saved",
            ),
            "live",
        )
        if live.where("p_conv is not null").isEmpty():
            break
    else:
        raise RuntimeError("the tree did not contract")
    done.append(live.select(*key, "leaves", "saved"))
    for inner, segments in reversed(rounds):
        known = reduce(DataFrame.unionByName, done)
        beyond = segments.join(
            known.select(
                F.col("conv_id").alias("end_conv"),
                F.col("depth").alias("end_depth"),
                F.col("leaves").alias("t_leaves"),
                F.col("saved").alias("t_saved"),
            ),
            ["end_conv", "end_depth"],
        ).select(
            "seg_conv",
            "seg_depth",
            *[(F.col(f"t_{c}") + F.col(f"beyond_{c}")).alias(f"b_{c}") for c in ("leaves", "saved")],
        )
        grown = inner.join(beyond, ["seg_conv", "seg_depth"]).select(
            *key, *[(F.col(c) + F.col(f"b_{c}")).alias(c) for c in ("leaves", "saved")]
        )
        done.append(staged(grown, "expanded"))
    return reduce(DataFrame.unionByName, done)


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): hash of the sorted ids of ``ends`` (depth, k1, k2, conv_id)."""
    name = ["depth", "k1", "k2"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows to pieces of at most PIECE ids."""
        open_key, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict(
                {
                    **{n: pa.array([v], pa.int64()) for n, v in zip(name, open_key, strict=True)},
                    "first": pa.array([ids[0]], pa.int64()),
                    "listed": [",".join(map(str, ids))],
                }
            )

        for batch in batches:
            ready = []
            for *key, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (key != open_key or len(ids) == PIECE):
                    ready.append(piece())
                    ids = []
                open_key = key
                ids.append(conv_id)
            if ready:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted pieces to one hash per node."""
        open_key, state, found = None, None, []

        def rows():
            columns = list(zip(*found, strict=True)) if found else [[]] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                [*name, "ends_sha256"],
            )

        for batch in batches:
            for *key, _, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == open_key:
                    state.update(b"," + listed.encode())
                    continue
                if open_key is not None:
                    found.append((*open_key, state.hexdigest()))
                open_key, state = key, hashlib.sha256(listed.encode())
            yield rows()
            found.clear()
        if open_key is not None:
            found.append((*open_key, state.hexdigest()))
        yield rows()

    keys = "depth bigint, k1 bigint, k2 bigint"
    pieces = (
        ends.select(*name, "conv_id")
        .repartitionByRange(*name, "conv_id")
        .sortWithinPartitions(*name, "conv_id")
        .mapInArrow(join, f"{keys}, first bigint, listed string")
    )
    return (
        pieces.repartition(*name)
        .sortWithinPartitions(*name, "first")
        .mapInArrow(digest, f"{keys}, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    turns = staged(numbered_turns(conversations), "turns")
    rebuilt, convs = rebuilt_turns(turns)
    convs = staged(convs, "conversations")
    keyed = staged(prefixes(rebuilt), "prefixes")
    nodes = staged(trie_nodes(keyed, convs), "trie")
    parent_depth = F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1)
    totals = subtree_totals(
        nodes.select(
            "conv_id",
            "depth",
            F.col("parent_conv_id").alias("p_conv"),
            parent_depth.alias("p_depth"),
            F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )
    )
    none = [F.lit(0).cast("bigint").alias(c) for c in ("depth", "k1", "k2")]
    ends = keyed.where("last").select("depth", "k1", "k2", "conv_id")
    ends = ends.unionByName(convs.where("turns = 0").select(*none, "conv_id"))
    return (
        nodes.join(totals, ["conv_id", "depth"])
        .join(hashed_ends(ends), ["depth", "k1", "k2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# The bits of crc32 are folded one by one; ancestors of a node are the prefixes of its
# smallest member.
ORACLE_SQL = r"""with src as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
ranked as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as rank from src),
convs as (
  select conv_id, count(*) as n_own,
    (4294967295 - list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
        lambda c: list_transform(range(8), lambda i: ((ascii(c) >> i::integer) & 1)::bigint)))),
      lambda crc, b: case when (crc & 1) <> b then xor(crc >> 1, 3988292384::bigint) else crc >> 1 end)) % 6 as h
  from src group by conv_id),
rebuilt as (
  select c.conv_id, r.rank as place, r.role, r.text from convs c
  join ranked r on r.conv_id = c.conv_id - c.conv_id % 100 and r.rank < c.h
  union all
  select c.conv_id, least(c.h, coalesce(b.n_own, 0)) + r.rank - c.h as place, r.role, r.text
  from convs c join ranked r on r.conv_id = c.conv_id and r.rank >= c.h
  left join convs b on b.conv_id = c.conv_id - c.conv_id % 100),
prefixes as (
  select conv_id, place + 1 as depth, length(text) as chars,
    sha256(string_agg(sha256(role) || sha256(text), '') over (
      partition by conv_id order by place rows unbounded preceding)) as node,
    count(*) over (partition by conv_id) as turns
  from rebuilt
  union all
  select conv_id, 0, 0, '', (select count(*) from rebuilt r where r.conv_id = c.conv_id) from convs c),
nodes as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = turns), '')) as ends_sha256
  from prefixes group by node, depth),
edges as (
  select c.node, p.node as parent, p.conv_id as parent_conv_id
  from nodes c join prefixes q on q.conv_id = c.conv_id and q.depth = c.depth - 1
  join nodes p on p.node = q.node and p.depth = q.depth),
children as (select parent as node, count(*) as n_children from edges group by parent),
totals as (
  select a.node, sum((n.n_convs - 1) * n.chars)::bigint as saved_tokens,
    count(*) filter (where k.n_children is null) as n_leaves
  from nodes n left join children k on k.node = n.node
  join prefixes a on a.conv_id = n.conv_id and a.depth <= n.depth
  group by a.node)
select n.conv_id, n.depth, e.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
  t.n_leaves, t.saved_tokens, n.ends_sha256
from nodes n join totals t on t.node = n.node
left join children k on k.node = n.node left join edges e on e.node = n.node"""
