"""Prefix trie of conversations, rolled up by centroid decomposition (operator 12).

A node of depth d is a distinct sequence of the first d turns; the conversations that
start with it are its members. A node goes by its smallest member, and by a key: two
64-bit sums over its turns of hashes of (place, SHA-256 of role and text), so all nodes of
all conversations come from one running sum and one aggregate, at any depth.

Totals over subtrees come from a centroid decomposition of the parent edges. A node weighs
as much as it has members, so the weight of its whole subtree is known at once: the turns
that its members have from it on. In every component, nodes whose subtree holds more than
half of the component's weight form a path from its top; the last one is the centroid. What
is left of the centroid's subtree is summed and added along the path from the centroid to
the top; then the centroid is done, each of its children is the top of a new component, and
the rest stays under the old top, lighter by what was cut off. So a component is at most
half as heavy after each round, and a chain of any length takes logarithmically many.

Rounds run over all components at once, as joins and aggregates (a component's own row
tells its weight, and a node finds its new top where the path of its smallest member meets
the level below the centroid). Components of at most ``LOCAL`` weight are finished in tasks,
by the same steps. Every round is written to the shared folder.

Defined cases: a null role or text is empty; turns with the same number (or none) are taken
in the order of their SHA-256; repeated turns all count; rows without a conversation id
belong to none and are ignored; a conversation whose turns are all replaced has none and is
a member of the root only; very long texts only enter a hash and a length; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship
from .running import running_sums

#: Weight up to which a component is finished in one task.
LOCAL = 1 << 16
#: Open components whose centroids are broadcast (about 60 bytes each); more of them are joined by shuffle.
BROADCAST = 1 << 16

_STATE = ["id", "parent", "m", "d", "comp", "r", "leaf", "saved", "leaves", "tokens"]


def _turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``c, q, digest, chars``: the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("q"))
    return running_sums(scratch.write(rows, "turns"), "c", [F.col("turn").asc_nulls_first(), F.col("digest")], ["q"], scratch, "places")


def borrowed_turns(c: Column, most: int) -> Column:
    """How many first turns a conversation takes from the first of its block."""
    return F.crc32(c.cast("string").cast("binary")) % most


def rebuild(turns: DataFrame, block: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation ``(c, n)`` with its length, and its turns ``(c, d, digest, chars)`` after the exchange."""
    own = turns.groupBy("c").agg(F.max("q").alias("own"))
    own = own.select("c", "own", borrowed_turns(F.col("c"), most).alias("h"), (F.col("c") - F.col("c") % block).alias("base"))
    firsts = own.where("c = base").select(F.col("base").alias("b"), F.col("own").alias("has"))
    convs = own.join(firsts, F.col("base") == F.col("b"), "left").select(
        "c", "h", "base", F.least(F.col("h"), F.coalesce("has", F.lit(0))).cast("long").alias("p"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).cast("long").alias("kept"))
    # at most ``most - 1`` turns of one conversation in a block
    lent = turns.where((F.col("c") % block == 0) & (F.col("q") < most)).select(F.col("c").alias("base"), "q", "digest", "chars")
    first = convs.where("p > 0").select("c", "base", "p").join(lent, "base").where("q <= p").select("c", F.col("q").alias("d"), "digest", "chars")
    # of the own turns those after h; a very long conversation is a hot key, which Spark splits
    rest = turns.join(convs.select("c", "h", "p"), "c").where("q > h").select(
        "c", (F.col("q") - F.col("h") + F.col("p")).alias("d"), "digest", "chars")
    return convs.select("c", (F.col("p") + F.col("kept")).alias("n")), first.unionByName(rest)


def _paths(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``c, d, chars, k1, k2, p1, p2``: each turn with the key of its node and of the node above."""
    terms = rows.select("c", "d", "chars", F.xxhash64("digest", "d").alias("t1"), F.xxhash64("d", F.lit("second"), "digest").alias("t2"))
    terms = scratch.write(terms.withColumns({"k1": F.col("t1"), "k2": F.col("t2")}), "terms")
    summed = running_sums(terms, "c", [F.col("d")], ["k1", "k2"], scratch, "sums")
    half, span = (F.lit(str(x)).cast("decimal(20,0)") for x in (1 << 63, 1 << 64))

    def prior(k: str, t: str) -> Column:
        """The sum before this turn: the difference wraps as the sums did."""
        x = F.col(k).cast("decimal(20,0)") - F.col(t).cast("decimal(20,0)")
        return F.when(x >= half, x - span).when(x < -half, x + span).otherwise(x).cast("long")

    return scratch.write(summed.select("c", "d", "chars", "k1", "k2", prior("k1", "t1").alias("p1"), prior("k2", "t2").alias("p2")), "paths")


def _nodes(convs: DataFrame, paths: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, m, d, k1, k2, parent, parent_conv, n_convs, r, chars, n_children`` of every node."""
    long = paths.join(convs, "c")
    below = long.groupBy("d", "k1", "k2").agg(
        F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n") - F.col("d") + 1).alias("r"),
        F.max("chars").alias("chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    root = convs.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n") + 1).alias("r")).where("m IS NOT NULL").select(
        F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "m", "n_convs", "r",
        F.lit(0).cast("long").alias("chars"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = scratch.write(below.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    up = nodes.select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("m").alias("parent_conv"))
    linked = scratch.write(nodes.where("d > 0").join(up, ["d", "p1", "p2"]).unionByName(
        nodes.where("d = 0"), allowMissingColumns=True).drop("p1", "p2"), "linked")
    children = linked.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    return scratch.write(linked.join(children.withColumnRenamed("parent", "id"), "id", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of small components; the rows of a component follow one another."""

    def totals(rows: dict[str, list]) -> pa.RecordBatch:
        ids, r = rows["id"], rows["r"]
        place = {x: i for i, x in enumerate(ids)}
        leaves, tokens = rows["leaves"], rows["tokens"]
        children: list[set[int]] = [set() for _ in ids]
        tops = []
        for i, (x, p, comp) in enumerate(zip(ids, rows["parent"], rows["comp"])):
            tops.append(i) if x == comp else children[place[p]].add(i)
        while tops:
            top = tops.pop()
            path = [top]
            while (heavy := next((k for k in children[path[-1]] if 2 * r[k] > r[top]), None)) is not None:
                path.append(heavy)
            centroid = path[-1]
            held, leaf, saved = [centroid], 0, 0
            while held:
                at = held.pop()
                leaf += rows["leaf"][at]
                saved += rows["saved"][at]
                held += children[at]
            for at in path:
                leaves[at] += leaf
                tokens[at] += saved
            tops += children[centroid]
            if len(path) > 1:
                children[path[-2]].discard(centroid)
                weight = r[centroid]
                for at in path[:-1]:
                    r[at] -= weight
                tops.append(top)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, leaves, tokens)], names=["id", "leaves", "tokens"])

    held: dict[str, list] = defaultdict(list)
    for batch in batches:
        own = batch.to_pydict()
        # whole components go; the last one may go on in the next batch
        comps = own["comp"]
        cut = next((i for i in range(len(comps) - 1, 0, -1) if comps[i - 1] != comps[-1]), 0) if comps else 0
        if comps and held["comp"] and (cut or held["comp"][-1] != comps[0]):
            take = cut
            for k, v in own.items():
                held[k] += v[:take]
            yield totals(held)
            held = defaultdict(list, {k: v[take:] for k, v in own.items()})
        else:
            for k, v in own.items():
                held[k] += v
    if held["comp"]:
        yield totals(held)


def rollup(nodes: DataFrame, lookup: DataFrame, scratch: Scratch, local: int = LOCAL) -> DataFrame:
    """``id, leaves, tokens``: the sums of ``leaf`` and ``saved`` over every node's subtree.

    ``nodes`` holds ``id, parent, m, d, r, leaf, saved``: ``r`` is the weight of the whole subtree (a node's own
    weight is at least 1), and ``m`` names a path that runs from the root through the node. ``lookup`` holds
    ``m, d, id, parent``: the nodes of those paths.
    """
    roots = nodes.where("parent IS NULL").select("id", "r")
    zero = F.lit(0).cast("long")
    # one tree: its root's row is the only one without a parent
    top = roots.first()
    if top is None:
        return nodes.select("id", F.col("leaf").alias("leaves"), F.col("saved").alias("tokens")).limit(0)
    state = nodes.select("id", "parent", "m", "d", F.lit(top["id"]).alias("comp"), "r", "leaf", "saved", zero.alias("leaves"), zero.alias("tokens"))
    state, finished, small, step = scratch.write(state, "round-0"), [], [], 0
    open_count = int(top["r"] > local)
    if not open_count:
        small.append(state)
    while open_count:
        step += 1
        near = (lambda df: F.broadcast(df)) if open_count <= BROADCAST else (lambda df: df)
        comps = state.where("id = comp").select("comp", F.col("r").alias("w"))
        rows = state.join(near(comps), "comp")
        path = rows.where("2 * r > w")
        centroid = path.groupBy("comp").agg(F.max_by(F.struct("id", "d", "r"), "d").alias("x")).select(
            "comp", F.col("x.id").alias("cid"), F.col("x.d").alias("cd"), F.col("x.r").alias("cr"))
        centroid = scratch.write(centroid, f"centroid-{step}")
        rows = rows.join(near(centroid), "comp")
        on_path = 2 * F.col("r") > F.col("w")
        # nodes off the path and deeper than the centroid look where their own path meets the level below it
        at = lookup.select(F.col("m").alias("lm"), F.col("d").alias("ld"), F.col("id").alias("new"), F.col("parent").alias("under"))
        deep = ~on_path & (F.col("d") > F.col("cd"))
        asked = rows.where(deep).join(at, (F.col("m") == F.col("lm")) & (F.col("cd") + 1 == F.col("ld")))
        none = F.lit(None).cast("long")
        moved = asked.withColumn("new", F.when(F.col("under") == F.col("cid"), F.col("new"))).drop("lm", "ld", "under").unionByName(
            rows.where(~deep).withColumn("new", none))
        moved = scratch.write(moved, f"cut-{step}")
        inside = F.col("new").isNotNull() | (F.col("id") == F.col("cid"))
        total = scratch.write(moved.where(inside).groupBy("comp").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("t")), f"total-{step}")
        moved = moved.join(near(total), "comp")
        gain = lambda c, t: (F.col(c) + F.when(on_path, F.col(t)).otherwise(F.lit(0))).alias(c)
        nxt = moved.select(
            "id", "parent", "m", "d", F.coalesce("new", "comp").alias("comp"),
            (F.col("r") - F.when(on_path & (F.col("id") != F.col("cid")), F.col("cr")).otherwise(F.lit(0))).alias("r"),
            "leaf", "saved", gain("leaves", "l"), gain("tokens", "t"), (F.col("id") == F.col("cid")).alias("done"))
        nxt = scratch.write(nxt, f"round-{step}")
        finished.append(nxt.where("done").select("id", "leaves", "tokens"))
        live = nxt.where("NOT done").drop("done")
        heavy = live.where((F.col("id") == F.col("comp")) & (F.col("r") > local)).select("comp")
        heavy = scratch.write(heavy, f"heavy-{step}")
        open_count = heavy.count()
        if not open_count:
            small.append(live)
            break
        near = (lambda df: F.broadcast(df)) if open_count <= BROADCAST else (lambda df: df)
        small.append(live.join(near(heavy), "comp", "left_anti").select(*_STATE))
        state = scratch.write(live.join(near(heavy), "comp", "left_semi").select(*_STATE), f"open-{step}")
        scratch.drop(f"cut-{step}")
    rest = small[0].select(*_STATE)
    for s in small[1:]:
        rest = rest.unionByName(s.select(*_STATE))
    done = rest.repartition("comp").sortWithinPartitions("comp").select("id", "parent", "comp", "r", "leaf", "saved", "leaves", "tokens").mapInArrow(
        _finish, "id long, leaves long, tokens long")
    for f in finished:
        done = done.unionByName(f)
    return scratch.write(done, "totals")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``d, k1, k2, ends``: SHA-256 over the ids of the conversations that end at each node, ascending.

    Tasks join the ids of their own range first; what a node's task reads then are a few long strings, one after another.
    """
    keys = ["d", "k1", "k2"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(x).to_numpy() for x in keys])
            c = batch.column("c").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (k[:, 1:] != k[:, :-1]).any(axis=0)]))
            stops = np.append(starts[1:], len(c))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(row[starts]) for row in k), pa.array(c[starts]),
                 pa.array([",".join(map(str, c[a:b].tolist())) for a, b in zip(starts, stops)])], names=[*keys, "c", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(x).to_pylist() for x in (*keys, "ids"))):
                if key == last:
                    state.update(b",")
                else:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*keys, "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*last, state.hexdigest())], names=[*keys, "ends"])

    key = "d long, k1 long, k2 long"
    joined = ends.repartitionByRange(*keys, "c").sortWithinPartitions(*keys, "c").mapInArrow(chunks, f"{key}, c long, ids string")
    return joined.repartition(*keys).sortWithinPartitions(*keys, "c").mapInArrow(digests, f"{key}, ends string")


def trie(conversations: DataFrame, block: int = 100, most: int = 6, local: int = LOCAL) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    A conversation c is rebuilt first: it takes the first crc32(c) mod ``most`` turns of conversation
    c - c mod ``block`` in place of as many of its own.
    """
    spark = conversations.sparkSession
    ship(spark)
    scratch = Scratch(spark, "prefix-trie")
    convs, rows = rebuild(_turns(conversations, scratch), block, most)
    convs = scratch.write(convs, "convs")
    paths = _paths(rows, scratch)
    nodes = _nodes(convs, paths, scratch)
    # the paths of smallest members, by node; only rounds over many tasks ask for them
    asked = paths.join(nodes.select("m").distinct().withColumnRenamed("m", "c"), "c", "left_semi")
    lookup = asked.join(nodes.where("d > 0").select("d", "k1", "k2", "id", "parent"), ["d", "k1", "k2"]).select(
        F.col("c").alias("m"), "d", "id", "parent")
    weight = nodes.where("d = 0").select("r").first()
    if weight is not None and weight["r"] > local:
        lookup = scratch.write(lookup, "lookup")
    totals = rollup(nodes.select("id", "parent", "m", "d", "r", (F.col("n_children") == 0).cast("long").alias("leaf"),
                                 ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), lookup, scratch, local)
    ends = paths.select("c", "d", "k1", "k2").join(convs, "c").where("d = n").select("c", "d", "k1", "k2").unionByName(
        convs.where("n = 0").select("c", *[F.lit(0).cast("long").alias(x) for x in ("d", "k1", "k2")]))
    hashed = _end_hashes(scratch.write(ends, "ends"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(totals, "id").join(hashed, ["d", "k1", "k2"], "left").select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"), F.coalesce("ends", F.lit(none)).alias("ends_sha256"))
