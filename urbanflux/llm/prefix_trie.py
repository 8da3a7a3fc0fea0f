"""The trie of conversation prefixes, measured by an Euler tour.

Every distinct sequence of first turns is a node. The tour enters and leaves each node by an arc of its
own; children follow one another by their smallest conversation. Ranking the list of arcs gives, at every
arc, the sum of what lies between it and the end of the tour: a subtree holds what stands at its enter arc
less what stands at its exit arc. The list is ranked in two steps. Nodes lie in ranges of (smallest
conversation, depth), which the tour follows closely, so each range first links its arcs to chains and sums
them up; then the chains jump over one another, twice as far in every round, until all see the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import ship_package
from urbanflux.llm.mixing import word_count
from urbanflux.llm.ordered import following, in_order, join_counted, running
from urbanflux.session import materialize

#: A conversation continues the first one of its family of so many ids.
FAMILY = 20
MOST_SHARED = 4
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "code_1", "code_2"]


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, digest, words`` per turn; ``pos`` counts from 1 in the order of ``turn``, null first.

    Null roles and texts become empty. Equal turns of a conversation stand in the order of their digests.
    Rows without a conversation are left out.
    """
    role, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, said).cast("binary"))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), word_count(said).alias("words")
    )
    placed = in_order(materialize(rows, "turns"), ["conv", "turn", "digest"], "turns")
    return running(placed, "conv", {"pos": ("sum", F.lit(1))}).select("conv", "pos", "digest", "words")


def rebuilt_conversations(numbered: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations that share the first turns of the first one of their family.

    Returns ``conv, length`` and ``conv, pos, digest, words``. A conversation takes ``crc32(id) % most`` turns
    from the family's first (all if there are fewer), then its own turns after as many.
    """
    counts = materialize(numbered.groupBy("conv").agg(F.max("pos").alias("own")), "lengths")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = counts.withColumns({"shared": shared, "first": F.col("conv") - F.col("conv") % family})
    given = counts.select(F.col("conv").alias("first"), F.least("own", F.lit(most - 1)).alias("given"))
    convs = convs.join(given, "first", "left").withColumn("taken", F.least("shared", F.coalesce("given", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    convs = materialize(convs.select("conv", "first", "shared", "taken", "own", length.alias("length")), "conversations")
    openings = numbered.where(F.col("pos") < most).withColumnRenamed("conv", "first")
    opened = convs.where("taken > 0").select("conv", "first", "taken").join(openings, "first").where("pos <= taken")
    total = counts.agg(F.coalesce(F.sum("own"), F.lit(0)).alias("n")).first()["n"]
    own = join_counted(numbered, convs.select("conv", "shared", "taken", "own"), ["conv"], "own", total).where("pos > shared")
    own = own.withColumn("pos", F.col("pos") - F.col("shared") + F.col("taken"))
    columns = ["conv", "pos", "digest", "words"]
    return convs.select("conv", "length"), opened.select(*columns).unionByName(own.select(*columns))


def prefix_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node: ``conv_id, depth, parent_conv_id, n_convs, n_children, first_child, words, ends_sha256``.

    A sequence of turns is known by two running codes that mix place and digest of each turn.
    """
    rows = in_order(materialize(turns, "rebuilt"), ["conv", "pos"], "rebuilt")
    for k in (1, 2):
        rows = rows.withColumn(f"term_{k}", F.xxhash64(F.lit(k), "pos", "digest"))
    rows = running(rows, "conv", {f"code_{k}": ("bit_xor", F.col(f"term_{k}")) for k in (1, 2)})
    above = [F.col(f"code_{k}").bitwiseXOR(F.col(f"term_{k}")).alias(f"above_{k}") for k in (1, 2)]
    zero = F.lit(0).cast("long")
    members = rows.select("conv", F.col("pos").alias("depth"), "code_1", "code_2", *above, "words")
    members = members.unionByName(
        convs.select("conv", *(zero.alias(c) for c in (*NODE, "above_1", "above_2", "words")))
    )
    members = materialize(members, "members")
    same = [F.first(c).alias(c) for c in ("above_1", "above_2", "words")]  # alike in all members
    nodes = materialize(members.groupBy(*NODE).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *same), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("above_1").alias("code_1"), F.col("above_2").alias("code_2")]
    children = nodes.where("depth > 0").select(*up, "conv_id").groupBy(*NODE)
    children = children.agg(F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.join(_endings(convs, members), NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))), "nodes")
    parents = nodes.where("n_children > 0").select(*NODE, F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    columns = ["n_convs", "n_children", "first_child", "words", "ends_sha256"]
    below = nodes.where("depth > 0").select(*up, "conv_id", *columns)
    found = join_counted(below, parents, NODE, "siblings", nodes.count()).withColumn("depth", F.col("depth") + 1)
    roots = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", *columns]
    return found.select(*columns).unionByName(roots.select(*columns))


def _endings(convs: DataFrame, members: DataFrame) -> DataFrame:
    """``ends_sha256`` per node at which conversations end: ids are joined per range and digested in order."""
    ends = members.join(convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]).select(*NODE, "conv")
    placed = in_order(materialize(ends, "ends"), [*NODE, "conv"], "ends")
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    pieces = placed.groupBy(*NODE, "part").agg(ids.alias("ids"))
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, node, state = [*NODE, "ends_sha256"], None, None
        for batch in batches:
            done = []
            for *key, _, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in done], schema=kind)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*node, state.hexdigest()), strict=True))], schema=kind)

    kind = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])
    return pieces.select(*NODE, "part", "ids").mapInArrow(digest, "depth long, code_1 long, code_2 long, ends_sha256 string")


CHAINED = "conv_id long, depth long, " + ", ".join(
    f"{a}_{c}" for a in ("enter", "exit") for c in ("leaves long", "saved long", "head boolean", "stop boolean", "conv long", "depth long", "out boolean")
)


def _chain(nodes: pd.DataFrame) -> pd.DataFrame:
    """Links the arcs of one range of nodes as far as they follow one another inside it.

    Per arc: what it and those after it in its chain hold, the arc outside that the chain leads to (unless
    the tour stops there), and whether it begins a chain.
    """
    n = len(nodes)
    conv, depth, child, sibling, parent = (nodes[c].to_numpy(np.int64) for c in ("conv_id", "depth", "first_child", "next_conv_id", "parent_conv_id"))
    has_child, has_sibling = nodes["has_child"].to_numpy(bool), nodes["has_sibling"].to_numpy(bool)
    # Arcs 0..n-1 enter, n..2n-1 leave; the target of an arc as (conversation, depth, whether it leaves).
    to_conv = np.concatenate([np.where(has_child, child, conv), np.where(has_sibling, sibling, parent)])
    to_depth = np.concatenate([np.where(has_child, depth + 1, depth), np.where(has_sibling, depth, depth - 1)])
    to_out = np.concatenate([~has_child, ~has_sibling])
    stops = np.concatenate([np.zeros(n, bool), depth == 0])
    at = pd.MultiIndex.from_arrays([conv, depth]).get_indexer(pd.MultiIndex.from_arrays([to_conv, to_depth]))
    nowhere = 2 * n
    target = np.where((at < 0) | stops, nowhere, at + n * to_out)
    head = np.ones(2 * n + 1, bool)
    head[target] = False
    sums = np.zeros((2 * n + 1, 2), np.int64)
    sums[:n, 0], sums[:n, 1] = ~has_child, nodes["saved"].to_numpy(np.int64)
    jump, last = np.append(target, nowhere), np.arange(2 * n + 1)
    last = np.where(jump == nowhere, last, jump)
    while (jump != nowhere).any():
        sums, jump, last = sums + sums[jump], jump[jump], last[last]
    out = {"conv_id": conv, "depth": depth}
    for name, arcs in (("enter", slice(0, n)), ("exit", slice(n, 2 * n))):
        end = last[arcs]
        out |= {f"{name}_leaves": sums[arcs, 0], f"{name}_saved": sums[arcs, 1], f"{name}_head": head[arcs], f"{name}_stop": stops[end]}
        out |= {f"{name}_conv": to_conv[end], f"{name}_depth": to_depth[end], f"{name}_out": to_out[end]}
    return pd.DataFrame(out)


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``conv_id, depth, n_leaves, saved_tokens`` of ``conv_id, depth, parent_conv_id, first_child, n_children, saved``."""
    by_parent = in_order(nodes.select("parent_conv_id", "depth", "conv_id"), ["parent_conv_id", "depth", "conv_id"], "siblings")
    beside = following(by_parent, ["parent_conv_id", "depth", "conv_id"])
    beside = beside.where("next_parent_conv_id = parent_conv_id AND next_depth = depth").select("conv_id", "depth", "next_conv_id")
    rows = nodes.join(beside, ["conv_id", "depth"], "left")
    known = [F.coalesce(c, F.lit(0)).alias(c) for c in ("parent_conv_id", "first_child", "next_conv_id")]
    there = [F.col(c).isNotNull().alias(name) for name, c in (("has_child", "first_child"), ("has_sibling", "next_conv_id"))]
    rows = rows.select("conv_id", "depth", *known, *there, "saved")
    placed = in_order(materialize(rows, "tour"), ["conv_id", "depth"], "tour")
    chained = materialize(placed.groupBy("part").applyInPandas(_chain, CHAINED), "chains")
    arc = lambda a: F.when(~F.col(f"{a}_stop"), F.struct(*(F.col(f"{a}_{c}").alias(c) for c in ("conv", "depth", "out"))))
    chained = chained.select(
        "conv_id", "depth", "enter_leaves", "enter_saved", "exit_leaves", "exit_saved", "enter_head", "exit_head",
        arc("enter").alias("enter_next"), arc("exit").alias("exit_next"),
    )
    chains = None
    for a in ("enter", "exit"):
        start = F.struct(F.col("conv_id").alias("conv"), "depth", F.lit(a == "exit").alias("out"))
        part = chained.where(f"{a}_head").select(start.alias("arc"), F.col(f"{a}_next").alias("next"), F.col(f"{a}_leaves").alias("leaves"), F.col(f"{a}_saved").alias("saved"))
        chains = part if chains is None else chains.unionByName(part)
    ranked = _ranked(materialize(chains, "chains"))
    here = chained.where("enter_next <=> exit_next")
    apart = chained.where("NOT (enter_next <=> exit_next)")
    for a in ("enter", "exit"):
        beyond = ranked.select(F.col("arc").alias(f"{a}_next"), F.col("leaves").alias(f"{a}_l"), F.col("saved").alias(f"{a}_s"))
        apart = apart.join(beyond, f"{a}_next", "left")
        for w in ("leaves", "saved"):
            apart = apart.withColumn(f"{a}_{w}", F.col(f"{a}_{w}") + F.coalesce(f"{a}_{w[0]}", F.lit(0)))
    done = [(F.col("enter_leaves") - F.col("exit_leaves")).alias("n_leaves"), (F.col("enter_saved") - F.col("exit_saved")).alias("saved_tokens")]
    return here.select("conv_id", "depth", *done).unionByName(apart.select("conv_id", "depth", *done))


def _ranked(chains: DataFrame) -> DataFrame:
    """``arc, leaves, saved`` summed up to the end of the list, by jumping twice as far in each round."""
    while not chains.where("next IS NOT NULL").isEmpty():
        far = chains.select(F.col("arc").alias("next"), F.col("next").alias("far"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        chains = chains.join(far, "next", "left").select(
            "arc", F.col("far").alias("next"),
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
        )
        chains = materialize(chains, "chains")
    return chains


def prefix_trie(turns: DataFrame, family: int = FAMILY, most: int = MOST_SHARED, rebuild: bool = True) -> DataFrame:
    """A row per node of the trie of conversations: every distinct sequence of first turns, the empty one too.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored. ``conv_id`` is the smallest
    conversation that begins so, ``parent_conv_id`` that of the sequence without its last turn (null at the
    root), ``n_convs`` counts conversations, ``n_children`` and ``n_leaves`` nodes, ``saved_tokens`` the words
    of a subtree that copies share, ``ends_sha256`` digests the ids that end at the node. With ``rebuild``
    each conversation first takes turns from the first of its family.

    Turns stand in the order of ``turn``, null first, equal ones by digest, repeated rows each as a turn of its
    own. Null roles and texts are empty ones; rows without a conversation are left out. An empty table has no
    nodes. Very long conversations are followed range by range like any other rows.
    """
    ship_package(turns.sparkSession)
    numbered = materialize(numbered_turns(turns), "numbered")
    if rebuild:
        convs, rows = rebuilt_conversations(numbered, family, most)
    else:
        convs, rows = numbered.groupBy("conv").agg(F.max("pos").alias("length")), numbered
    nodes = prefix_nodes(convs, rows).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = materialize(nodes, "trie")
    found = nodes.join(subtree_sums(nodes), ["conv_id", "depth"])
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

