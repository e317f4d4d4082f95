"""N-gram Jaccard join over whole documents (operator 9): a grouped prefix join.

1. *Sets.* Each document becomes the set of its ``k``-word shingles as 64-bit hashes.
2. *Order.* Shingles are ordered by how many documents hold them, rare first,
   then by hash. Documents are counted exactly for the part of the hash space
   that prefixes come from; the most frequent ``order_size`` shingles of that
   count are broadcast (a fixed bound). Any common order gives exact results;
   the counts only keep common shingles out of the prefixes.
3. *Groups.* Equal sets are one representative. Representatives with the same
   size and the same prefix are one group, and only groups enter the prefix index.
4. *Group pairs.* Two sets at the threshold share a shingle in their prefixes, so
   only shingles in the prefixes of two groups or more matter. A shingle's list
   is dealt in blocks of bounded size, so that a long list is many tasks.
5. *Members.* Groups are expanded to members with a parity bitmap each: a bit per
   hash class holds the parity of its members. Two bitmaps differ in at most as
   many bits as the sets have unshared elements, so sizes, prefix places and
   bitmaps drop pairs without losing one.
6. *Verification.* What is left is verified on the whole sets, in two rounds. The
   first takes a spanning forest of each task's pairs; its verified links give
   first components. The second takes every pair that still spans two components.
   So a group of thousands of near copies costs about as many verified pairs as
   it has members, and no link between components is lost.

Defined cases: null or empty texts have no shingles, no links and their own id as
component; texts shorter than ``k`` words are one shingle; rows with the same id
are one node, linked by any of their texts, so all have one component; rows without
an id are returned with null component; equal texts are linked; very long texts are
taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, gathered, id_text, map_text, ship
from .components import components
from .hashing import U, mix, shingle_sets

#: Shingles in the broadcast order (16 bytes each), at most.
ORDER_SIZE = 1 << 19
#: Bits of a parity bitmap, members of a block of a shingle's list, and pairs compared at once in a task.
BITS, BLOCK, AT_ONCE = 1024, 1024, 1 << 18
#: log2 of the bits of the filter that picks the documents whose sets are needed (a fixed 1 MB).
FILTER_BITS = 23


def least_overlap(a, b, percent: int):
    """Smallest intersection with 100 * both >= percent * (a + b - both)."""
    return -((-percent * (a + b)) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """Elements of a set of ``n`` of which one at least is in any other set at the threshold."""
    return n - -((-percent * n) // 100) + 1 if n else 0


def bitmap(s: np.ndarray) -> bytes:
    odd = np.bincount((s >> U(20)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


# ---- order -------------------------------------------------------------------------------------------------

def _frequent(docs: DataFrame, k: int, percent: int, size: int) -> tuple[np.ndarray, np.ndarray, U]:
    """The most frequent shingles (sorted keys) and the bit length of their document counts, ``size`` at most.

    Counted over all documents for hashes below a share of the hash space. Tasks
    send hashes as packed 32-bit rests under a bucket number, so a bucket is a
    bounded run that one numpy sort counts.
    """
    share = min(1.0, 2.5 * (100 - percent) / 100)
    limit = U(min(int(share * 2**64), 2**64 - 1))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    buckets = 1 << (parts * 4 - 1).bit_length()

    def emit(batch: pa.RecordBatch) -> dict | None:
        sets = [s[s < limit] for s in shingle_sets(batch.column("text"), k)]
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        if not len(every):
            return None
        bucket = (every % U(buckets)).astype(np.int32)
        rest = (every >> U(32)).astype(np.uint32)
        by = np.argsort(bucket, kind="stable")
        bucket, rest = bucket[by], rest[by]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        return {"bucket": bucket[cuts], "rests": [r.tobytes() for r in np.split(rest, cuts[1:])]}

    def count(key: tuple[np.int32, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rest, n = np.unique(np.concatenate([np.frombuffer(r, np.uint32) for r in rows["rests"]]), return_counts=True)
        level = np.floor(np.log2(n)).astype(np.int32) + 1
        own = [int(x) for x in np.unique(level[n > 2])]
        return pd.DataFrame({"bucket": np.full(len(own), key[0], np.int32), "level": np.array(own, np.int32),
                             "rests": [rest[(level == x) & (n > 2)].tobytes() for x in own]})

    spread = map_text(docs, "text", emit, "bucket int, rests binary")
    scratch = Scratch(docs.sparkSession, "jaccard-order")
    counted = scratch.write(
        spread.groupBy("bucket").applyInPandas(count, "bucket int, level int, rests binary"), "frequent")
    # the lowest level from which all levels above fit the bound (at most 64 rows come back)
    levels = sorted(((r["level"], r["n"] // 4) for r in counted.groupBy("level").agg(
        F.sum(F.length("rests")).alias("n")).collect()), reverse=True)
    total, lowest = 0, 99
    for level, n in levels:
        if total + n > size:
            break
        total, lowest = total + n, level
    key, rank = [np.array([2**64 - 1], np.uint64)], [np.zeros(1, np.uint64)]
    for r in counted.where(F.col("level") >= lowest).collect():  # packed: 4 bytes a shingle
        rest = np.frombuffer(r["rests"], np.uint32).astype(np.uint64)
        key.append(rest << U(32) | U(r["bucket"]))
        rank.append(np.full(len(rest), r["level"], np.uint64))
    keys, ranks = np.concatenate(key), np.concatenate(rank)
    scratch.drop()
    by = np.argsort(keys, kind="stable")
    mask = U(0xFFFFFFFF << 32 | (buckets - 1))
    return keys[by], ranks[by], mask


def _signatures(docs: DataFrame, k: int, percent: int, order) -> DataFrame:
    """Per document: set size, set and prefix fingerprints, prefix in order, parity bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batch: pa.RecordBatch) -> dict:
        keys, levels, mask = shared.value
        n, fp1, fp2, px, prefix, bits = [], [], [], [], [], []
        for s in shingle_sets(batch.column("text"), k):
            n.append(len(s))
            fp1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
            fp2.append(int(mix(s ^ U(0xABCD)).sum(dtype=np.uint64).astype(np.int64)))
            p = prefix_size(len(s), percent)
            key = s & mask
            at = np.searchsorted(keys, key)
            level = np.where(keys[at] == key, levels[at], U(0))
            rank = (level << U(58)) | (s >> U(6))
            first = np.argsort(rank, kind="stable")[:p]
            own = s[first].astype(np.int64)
            px.append(int(mix(s[first]).sum(dtype=np.uint64).astype(np.int64)))
            prefix.append(own)
            bits.append(bitmap(s))
        ends = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
        flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
        return {"doc_id": batch.column("doc_id"), "n": n, "fp1": fp1, "fp2": fp2, "px": px,
                "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "bits": bits}

    return map_text(docs, "text", run, "doc_id long, n long, fp1 long, fp2 long, px long, prefix array<long>, bits binary")


# ---- candidate pairs ---------------------------------------------------------------------------------------

def _near(t: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs within the lists of ``t`` (rows sorted by list) that sizes, places and bitmaps let through, with their distance."""
    n = len(t["rep"])
    new = np.ones(n, bool)
    new[1:] = (t["token"][1:] != t["token"][:-1]) | (t["x"][1:] != t["x"][:-1]) | (t["y"][1:] != t["y"][:-1])
    start = np.flatnonzero(new)
    end = np.repeat(np.append(start[1:], n), np.diff(np.append(start, n)))
    whole = t["x"] == t["y"]
    found = []
    active = np.arange(n)
    step = 0
    while True:
        step += 1
        active = active[active + step < end[active]]
        if not len(active):
            break
        for at in range(0, len(active), AT_ONCE):
            i = active[at:at + AT_ONCE]
            j = i + step
            ok = (t["comp"][i] != t["comp"][j]) & (whole[i] | (t["block"][i] != t["block"][j]))
            i, j = i[ok], j[ok]
            a, b = t["n"][i], t["n"][j]
            need = least_overlap(a, b, percent)
            ok = np.minimum(a - t["pos"][i], b - t["pos"][j]) >= need
            i, j, room = i[ok], j[ok], (a + b - 2 * need)[ok]
            if len(i):
                apart = np.bitwise_count(t["bits"][i] ^ t["bits"][j]).sum(axis=1, dtype=np.int64)
                ok = apart <= room
                found.append((t["rep"][i[ok]], t["rep"][j[ok]], apart[ok]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    a, b, apart = map(np.concatenate, zip(*found))
    a, b = np.minimum(a, b), np.maximum(a, b)
    by = np.lexsort((b, a))
    a, b, apart = a[by], b[by], apart[by]
    own = np.ones(len(a), bool)
    own[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[own], b[own], apart[own]


def _forest(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Places of the pairs of a spanning forest, closest pairs first."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = x = root.get(y, y)
        return x

    kept = []
    for k, x, y in zip(by := np.argsort(apart, kind="stable").tolist(), a[by].tolist(), b[by].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(sorted(kept), np.int64)


def _pairs(lists: DataFrame, percent: int, forest: bool) -> DataFrame:
    """``a, b`` (a < b): pairs of different components worth verifying, each once."""
    fields = ("token", "x", "y", "block", "rep", "comp", "n", "pos")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        t = {f: batch.column(f).to_numpy().astype(np.int64, copy=False) for f in fields}
        bits = b"".join(batch.column("bits").to_pylist())
        t["bits"] = np.frombuffer(bits, np.uint64).reshape(-1, BITS // 64)
        return t

    def answer(t: dict[str, np.ndarray]) -> pa.RecordBatch:
        a, b, apart = _near(t, percent)
        if forest and len(a):
            own = _forest(a, b, apart)
            a, b = a[own], b[own]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # the last list of a batch may go on in the next; its length is bounded by the block size
        for batch in gathered(batches):
            t = columns(batch)
            if carry is not None:
                t = {f: np.concatenate([carry[f], t[f]]) for f in t}
            last = np.flatnonzero((t["token"] != t["token"][-1]) | (t["x"] != t["x"][-1]) | (t["y"] != t["y"][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            carry = {f: v[cut:] for f, v in t.items()}
            if cut:
                yield answer({f: v[:cut] for f, v in t.items()})
        if carry is not None:
            yield answer(carry)

    dealt = lists.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    return dealt.select(*fields, "bits").mapInArrow(run, "a long, b long").distinct()


def _lists(entries: DataFrame, members: DataFrame) -> DataFrame:
    """The entries of shared shingles, expanded from groups to members and dealt in pairs of blocks."""
    whole = entries.join(members, "gid").withColumn("block", F.expr("pmod(xxhash64(rep), blocks)").cast("int"))
    other = F.explode(F.expr("if(blocks = 1, array(0), sequence(0, blocks - 1))")).alias("other")
    return whole.select("*", other).select(
        "*", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))


# ---- verification ------------------------------------------------------------------------------------------

def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold. Sets are made for the pairs' documents only (a fixed-size filter)."""
    cell = "pmod(xxhash64({}), {})".format("{}", 1 << FILTER_BITS)
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    rows = ids.select(F.expr(cell.format("id")).alias("cell")).groupBy(F.expr("bitmap_bucket_number(cell + 1)").alias("at")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(cell + 1))").alias("bits")).collect()
    wanted = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for r in rows:
        own = np.frombuffer(r["bits"], np.uint8)
        wanted[(r["at"] - 1) * 4096:(r["at"] - 1) * 4096 + len(own)] = own
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def sets(batch: pa.RecordBatch) -> dict | None:
        at = batch.column("cell").to_numpy()
        own = np.flatnonzero(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        if not len(own):
            return None
        part = batch.take(pa.array(own))
        return {"doc_id": part.column("doc_id"), "elements": [s.tobytes() for s in shingle_sets(part.column("text"), k)]}

    of = map_text(docs.withColumn("cell", F.expr(cell.format("doc_id"))), "text", sets, "doc_id long, elements binary")
    both = (pairs.join(of.select(F.col("doc_id").alias("a"), F.col("elements").alias("of_a")), "a")
            .join(of.select(F.col("doc_id").alias("b"), F.col("elements").alias("of_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("of_a"), batch.column("of_b")):
                left, right = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                every = np.concatenate([left, right])
                every.sort(kind="stable")
                common = int((every[1:] == every[:-1]).sum())
                keep.append(100 * common >= percent * (len(every) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long").distinct()


# ---- the operator ------------------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 90, order_size: int = ORDER_SIZE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document: components of the links with Jaccard >= percent / 100.

    ``component_id`` is the smallest id reachable by links, its own included.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    ship(docs.sparkSession)
    texts = id_text(docs)
    scratch = Scratch(docs.sparkSession, "jaccard")
    sig = scratch.write(_signatures(texts, k, percent, _frequent(texts, k, percent, order_size)), "signatures")
    own = sig.where("n > 0 AND doc_id IS NOT NULL")
    equal = own.groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.min("px").alias("px"))
    groups = equal.groupBy("n", "px").agg(F.min("rep").alias("gid"), F.count("*").alias("m"))
    reps = scratch.write(
        own.select("doc_id", "n", "px", "prefix", "bits").join(
            equal.join(groups, ["n", "px"]).select(F.col("rep").alias("doc_id"), "n", "px", "gid", "m"), ["doc_id", "n", "px"])
        .select(F.col("doc_id").alias("rep"), "n", "gid", "m", F.expr("if(doc_id = gid, prefix, NULL)").alias("prefix"), "bits"),
        "representatives")

    # the prefix index of groups; what one group alone holds is needed once, for the pairs within a group
    index = reps.where("rep = gid").select("gid", "m", F.posexplode("prefix").alias("pos", "token"))
    held = index.groupBy("token").agg(F.count(F.lit(1)).alias("groups"), F.sum("m").alias("members")).where("members > 1")
    held = scratch.write(held, "held")  # so that the join with a very common shingle's entries is one that Spark splits
    entries = scratch.write(
        index.join(held, "token").where("groups > 1 OR (m > 1 AND pos = 0)")
        .select("token", "gid", "pos", F.expr(f"CAST(ceil(members / {BLOCK}) AS int)").alias("blocks")), "entries")

    members = reps.select("gid", "rep", "n", "bits", F.col("rep").alias("comp"))
    first = scratch.write(_pairs(_lists(entries, members), percent, forest=True), "pairs-1")
    links = scratch.write(_verified(first, texts, k, percent), "links-1")
    comps = components(links, scratch, "components-1")

    # second round: only lists that still hold two components
    label = reps.select("gid", "rep").join(comps.select(F.col("id").alias("rep"), "component_id"), "rep", "left").select(
        "gid", "rep", F.coalesce("component_id", "rep").alias("comp"))
    open_ = entries.join(label, "gid").groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    left = entries.join(open_.select("token"), "token", "left_semi")
    members = reps.select("rep", "n", "bits").join(label, "rep").select("gid", "rep", "n", "bits", "comp")
    second = scratch.write(_pairs(_lists(left, members), percent, forest=False).join(first, ["a", "b"], "left_anti"), "pairs-2")
    scratch.drop("representatives", "entries", "held")
    more = scratch.write(_verified(second, texts, k, percent), "links-2")
    # rows with the same id and different texts are one node
    valued = sig.where("doc_id IS NOT NULL")
    value = F.struct("n", "fp1", "fp2")
    repeated = scratch.write(valued.groupBy("doc_id").agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where("lo < hi").select("doc_id"), "repeated")
    several = not repeated.isEmpty()
    if several:
        nodes = scratch.write(own.join(repeated, "doc_id", "left_semi").join(equal.select("n", "fp1", "fp2", "rep"), ["n", "fp1", "fp2"])
                              .select("doc_id", "rep").distinct(), "nodes")
        more = more.unionByName(nodes.join(nodes.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").where("rep <> b").select(
            F.col("rep").alias("a"), "b"))
    if not more.isEmpty():
        comps = components(links.unionByName(more), scratch, "components-2")
    # the result reads the signatures and the components only
    scratch.drop("pairs-1", "pairs-2", "links-1", "links-2")

    # every document by its representative; equal sets share it
    known = equal.select("n", "fp1", "fp2", "rep").join(comps.select(F.col("id").alias("rep"), "component_id"), "rep", "left").select(
        F.col("n").alias("n_shingles"), "fp1", "fp2", F.coalesce("component_id", "rep").alias("component_id"))
    found = sig.select("doc_id", F.col("n").alias("n_shingles"), "fp1", "fp2").join(known, ["n_shingles", "fp1", "fp2"], "left")
    if several:
        of = nodes.join(comps.select(F.col("id").alias("rep"), "component_id"), "rep", "left").groupBy("doc_id").agg(
            F.min(F.coalesce("component_id", "rep")).alias("node"))
        found = found.join(of, "doc_id", "left").withColumn("component_id", F.coalesce("node", "component_id"))
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
