"""The prefix trie of conversations, and totals over its subtrees by parallel tree contraction.

Contraction works on all of a forest at once. A round first rakes: leaves leave the tree
and add their totals to their parents. Then it compresses: in every chain of nodes with
one child each, nodes that no neighbour in the chain outranks are spliced out, and their
values move to the edge below them. Chains shrink by a third a round on average and
every leaf goes, so rounds grow with the logarithm of the tree's size, not with its
depth. Afterwards the spliced nodes are expanded, last round first: the total of a node
is that of the child it was spliced over, and what lay on the edge between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written
from tideline.operators.scan import Count, OrderedScan, Sum

FAMILY = 5
HEAD = 9


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """``node`` and, for each of ``values``, its sum over the node's subtree, the node included.

    ``tree`` has one row for each node with ``node``, ``parent`` (null, or no node of the tree, for a root) and the
    numbers; it may be a forest, or empty. Nodes are of any type that can be hashed. A cycle is an error. Every round
    writes what is left of the tree, so a lost executor costs one round at most; all joins are on different nodes,
    and what many children give to one parent is summed before the shuffle.
    """
    acc, edge = [f"acc_{v}" for v in values], [f"edge_{v}" for v in values]
    active = tree.select("node", "parent", *[F.col(v).alias(a) for v, a in zip(values, acc)])
    active = active.withColumns({e: F.col(a) * 0 for e, a in zip(edge, acc)})
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while True:
        parents = active.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
        marked = written(active.join(parents.withColumn("inner", F.lit(True)), "node", "left"), "rake")
        leaves = marked.where("inner IS NULL")
        raked = leaves.select("node", *[F.col(a).alias(v) for v, a in zip(values, acc)])
        if marked.where("inner").isEmpty():
            rounds.append((raked, None))
            break
        if leaves.isEmpty():
            raise ValueError("the tree has a cycle")
        given = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
        given = given.agg(*[F.sum(F.col(a) + F.col(e)).alias(f"given_{a}") for a, e in zip(acc, edge)])
        rest = marked.where("inner").join(given, "node", "left")
        rest = rest.select("node", "parent", *[_plus(a, f"given_{a}") for a in acc], *edge)
        rest = written(rest, "raked")

        only = rest.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
        only = only.agg(F.count("*").alias("n"), F.min("node").alias("child")).where("n = 1").drop("n")
        rank = [F.xxhash64(c, F.lit(len(rounds))) for c in ("node", "parent", "child")]
        chosen = rest.where("parent IS NOT NULL").join(only, "node").where((rank[0] < rank[1]) & (rank[0] < rank[2]))
        over = chosen.select(
            F.col("child").alias("node"),
            F.col("node").alias("spliced"),
            F.col("parent").alias("above"),
            *[F.col(x).alias(f"over_{x}") for x in (*acc, *edge)],
        )
        over = written(over, "chosen")
        below = rest.join(over, "node", "left")
        gone = over.select(F.col("spliced").alias("node"))
        moved = [_plus(e, f"over_{a}", f"over_{e}") for a, e in zip(acc, edge)]
        parent = F.coalesce("above", "parent").alias("parent")
        active = written(below.join(gone, "node", "left_anti").select("node", parent, *acc, *moved), "compressed")
        # The edge below a spliced node, from the node on: what its total has more than the child's.
        more = [(F.col(e) + F.col(f"over_{a}")).alias(v) for v, a, e in zip(values, acc, edge)]
        spliced = rest.join(over, "node").select(F.col("spliced").alias("node"), F.col("node").alias("child"), *more)
        rounds.append((raked, written(spliced, "spliced")))

    known, _ = rounds.pop()
    while rounds:
        raked, spliced = rounds.pop()
        total = known.select(F.col("node").alias("child"), *[F.col(v).alias(f"child_{v}") for v in values])
        expanded = spliced.join(total, "child")
        expanded = written(expanded.select("node", *[(F.col(v) + F.col(f"child_{v}")).alias(v) for v in values]), "expanded")
        known = known.unionByName(raked).unionByName(expanded)
    return known


def _plus(first: str, *more: str) -> Column:
    total = F.col(first)
    for name in more:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total.alias(first)


def rebuilt(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: their turns (``conv``, ``d``, ``what``, ``bytes``) and all of them (``conv``, ``n``).

    A conversation c starts with the first h turns of conversation c - c % 5, where h is the unsigned crc32 of its
    decimal number % 9 (all of them if there are fewer, none if there is no such conversation); its own turns after
    its first h follow. ``d`` counts the rebuilt turns from 1, ``what`` is the SHA-256 of role and text, ``bytes`` the
    UTF-8 length of the text; ``n`` is the number of rebuilt turns, which may be 0.
    """
    blank = F.lit("")
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text).cast("string"), blank).alias("text"),
    )
    what = F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256))
    rows = rows.withColumns({"what": what, "bytes": F.octet_length("text").cast("long")})
    # Equal turns are ordered by role and text; a long conversation is cut into slices.
    own = OrderedScan(rows, ["conv"], ["turn", "role", "text"]).add(n=Count()).result()
    own = written(own.select("conv", "n", "what", "bytes"), "turns")
    head = (F.crc32(F.col("conv").cast("string")) % HEAD).alias("head")
    convs = own.groupBy("conv").agg(F.count("*").alias("own"))
    convs = convs.select("conv", "own", head, (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = convs.where(f"conv % {FAMILY} = 0").select(F.col("conv").alias("base"), F.col("own").alias("had"))
    lent = F.least("head", F.coalesce("had", F.lit(0)))
    convs = written(convs.join(bases, "base", "left").select("conv", "base", "own", "head", lent.alias("lent")), "conversations")
    heads = own.where(f"n < {HEAD} AND conv % {FAMILY} = 0").withColumnRenamed("conv", "base")
    heads = convs.join(heads, "base").where("n <= lent").select("conv", F.col("n").alias("d"), "what", "bytes")
    tails = own.join(convs, "conv").where("n > head")
    tails = tails.select("conv", (F.col("n") - F.col("head") + F.col("lent")).alias("d"), "what", "bytes")
    n = F.col("lent") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return heads.unionByName(tails), convs.select("conv", n.alias("n"))


def _node(depth: Column, *sums: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's numbers with commas between; rows come ordered by node and number, none is kept."""
    node, sha = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends"])

    for batch in batches:
        nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start = 0
        while start < len(nodes):
            stop = start
            while stop < len(nodes) and nodes[stop] == nodes[start]:
                stop += 1
            text = ",".join(map(str, convs[start:stop])).encode()
            if nodes[start] != node:
                if node is not None:
                    yield out()
                node, sha = nodes[start], hashlib.sha256(text)
            else:
                sha.update(b"," + text)
            start = stop
    if node is not None:
        yield out()


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations that :func:`rebuilt` gives, one row for each node.

    A node is a different sequence of first turns (role and text); the root is the sequence of none. ``conv_id`` is the
    smallest of the ``n_convs`` conversations that start with it, ``depth`` its number of turns, ``parent_conv_id`` the
    parent's ``conv_id`` (null for the root), ``n_children`` its children, ``n_leaves`` the childless nodes of its
    subtree, ``saved_tokens`` the bytes that storing each turn once saves in the subtree ((n_convs - 1) times the
    bytes of a node's last text), ``ends_sha256`` digests the decimal numbers of the conversations that end there.

    Turns are ordered by ``turn``, nulls first, equal ones by role and text. Null roles and texts count as empty,
    repeated rows are turns of their own, rows without a conversation are left out. An empty table gives an empty
    result. Sequences are told apart by 120-bit sums of SHA-256 digests, one of every turn with its place, so no
    conversation is ever gathered in one row. Other columns are not read.
    """
    turns, convs = rebuilt(df, conv, turn, role, text)
    placed = F.sha2(F.concat(F.col("d").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("what")), 256)
    limb = {f"x{k}": F.conv(F.substring("placed", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)") for k in range(2)}
    turns = turns.withColumn("placed", placed).withColumns(limb).drop("placed", "what")
    scan = OrderedScan(turns, ["conv"], ["d"]).add(s0=Sum("x0"), s1=Sum("x1")).result()
    above = [F.col(f"s{k}") - F.col(f"x{k}") for k in range(2)]
    sums = [F.col(f"s{k}").cast("decimal(38,0)") for k in range(2)]
    above = [a.cast("decimal(38,0)") for a in above]
    members = scan.join(convs, "conv").select(
        "conv", "d", "bytes", _node(F.col("d"), *sums).alias("node"), _node(F.col("d") - 1, *above).alias("parent"), (F.col("d") == F.col("n")).alias("end")
    )
    zero = F.lit(0).cast("decimal(38,0)")
    root = convs.select(
        "conv",
        F.lit(0).cast("long").alias("d"),
        F.lit(0).cast("long").alias("bytes"),
        _node(F.lit(0), zero, zero).alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        (F.col("n") == 0).alias("end"),
    )
    members = written(members.unionByName(root), "members")
    nodes = members.groupBy("node").agg(
        F.min("conv").alias("conv_id"), F.first("d").alias("depth"), F.first("parent").alias("parent"),
        F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"),
    )
    nodes = written(nodes, "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "counted-nodes")
    own = nodes.select(
        "node",
        "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    ends = members.where("end").select("node", "conv").repartition("node").sortWithinPartitions("node", "conv")
    ends = ends.mapInArrow(_end_digests, "node binary, ends string")
    names = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(totals, "node").join(ends, "node", "left").join(names, "parent", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", nothing).alias("ends_sha256")
    )
