"""Path-to-root index: one row per (node, path from the root).

``build_index`` walks down from the root one level per round. A round is one
equi-join of the current level with the edges on ``dst`` (salted on hot
parents), written to the checkpoint folder; the driver only learns the round's
row count from an ``Observation`` on that same write, so no extra job runs and
nothing but a number comes back. Columns:

    id bigint, path string, depth int, parent bigint, ancestors array<bigint>

``path`` lists the ancestors root-first between slashes, without the node
itself: the root is ``"/"``, its child ``"/1/"``, a grandchild ``"/1/10239/"``.
A node with two parents that both reach the root gets one row per path. An
edge back to the root or to a node already on the path (a cycle) is not
followed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.columns import PATH_SEP, ancestors_of, child_path, depth_of, parent_of
from ..hierarchy import Hierarchy
from ..plans.layout import keyed
from ..plans.materialize import RoundWriter
from ..plans.skew import SALT, salt_one
from ..sources.edges import clustered

INDEX_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("path", StringType(), False),
    StructField("depth", IntegerType(), False),
    StructField("parent", LongType(), True),
    StructField("ancestors", ArrayType(LongType(), False), False),
])

DEFAULT_MAX_LEVEL = 3
# Range key of a stored index: path first (subtrees contiguous), then id (a shared path is split).
INDEX_CLUSTERING = ["path", "id"]
#: A question set whose plan is estimated at no more bytes is stored and looked at before the search,
#: and if it has no more different ids, these are pushed to the scan.
FEW_BYTES, FEW_IDS = 1 << 16, 256
#: Ids of one pushed list: longer ones Spark turns into a range from the smallest to the largest.
LIST_IDS = 10
#: Layers of nodes without children that are taken off before the rounds of a whole index.
PEELS = 3
#: A layer is taken off while it has one in so many of the edges that are left.
PEEL_SHARE = 4
#: Different ids that a row group's Bloom filter is made for.
BLOOM_IDS = 1 << 17
#: A join of the build is left to Spark's size check while its finished rows are no more than this. That check goes by the
#: bytes of files, which packed rows have few of: a hundred times as much would be gathered on the driver.
FEW_ROWS = 1 << 16
#: How a stored index is written: next to each other, sorted paths and ids differ little, which zstd finds in the plain
#: values; a dictionary of nearly unique values only hides it.
PACKED = {"compression": "zstd", "parquet.enable.dictionary": "false"}


def root_row(spark: SparkSession, root: int) -> DataFrame:
    return spark.createDataFrame([(int(root), PATH_SEP, 0, None, [])], INDEX_SCHEMA)


def build_index(h: Hierarchy, max_level: int = DEFAULT_MAX_LEVEL, method: str = "auto") -> DataFrame:
    """Rows for the root and every node at depth 1..``max_level`` (-1: all depths, 0: root only).

    ``method='levels'`` walks down one level per round (rounds = depth);
    ``method='doubling'`` (unlimited depth only) joins partial chains with
    partial chains, doubling their length each round (rounds = log2 depth).
    ``'auto'`` picks levels for a depth limit and doubling without one.
    """
    if method not in ("auto", "levels", "doubling"):
        raise ValueError(f"method must be 'auto', 'levels' or 'doubling', got {method!r}")
    if method == "doubling" and max_level >= 0:
        raise ValueError("doubling builds the whole index; use max_level=-1 or method='levels'")
    if max_level < 0 and method in ("auto", "doubling"):
        return _build_by_doubling(h)
    return _build_by_levels(h, max_level)


def _build_by_levels(h: Hierarchy, max_level: int) -> DataFrame:
    spark = h.spark
    writer = RoundWriter(spark, "index")
    hot = h.hot_parents()
    if hot is None:
        edges = keyed(h.edges.select(F.col("src").alias("_c"), F.col("dst").alias("_p")), "_p")
    else:
        edges = keyed(h.salted_edges().select(F.col("src").alias("_c"), F.col("dst").alias("_p"),
                                              F.col(SALT).alias("_s")), "_p", "_s")
    try:
        frontier = writer.write(root_row(spark, h.root), "level-0")
        tags = ["level-0"]
        level = 0
        while max_level < 0 or level < max_level:
            f = frontier.select("id", "path", "depth", "ancestors")
            if hot is None:
                j = f.join(edges, F.col("id") == F.col("_p"))
            else:
                f = salt_one(f, "id", hot)
                j = f.join(edges, (F.col("id") == F.col("_p")) & (F.col(SALT) == F.col("_s")))
            upto = F.concat(F.col("ancestors"), F.array(F.col("id")))
            nxt = j.where((F.col("_c") != F.lit(h.root)) & ~F.array_contains(upto, F.col("_c"))).select(
                F.col("_c").alias("id"),
                child_path(F.col("path"), F.col("id")).alias("path"),
                (F.col("depth") + 1).cast("int").alias("depth"),
                F.col("id").alias("parent"),
                upto.alias("ancestors"),
            )
            obs = Observation(f"level{level + 1}")
            written = writer.write(nxt.observe(obs, F.count(F.lit(1)).alias("rows")), f"level-{level + 1}")
            if obs.get["rows"] == 0:
                break
            tags.append(f"level-{level + 1}")
            frontier = written
            level += 1
    finally:
        edges.unpersist()
    return writer.read(tags, INDEX_SCHEMA)


def peeled(edges: DataFrame, writer: RoundWriter) -> tuple[DataFrame, list[DataFrame]]:
    """``(id, top)`` edges as those of a core, and layers around it whose nodes have no children further in.

    A layer is one join of the edges left with their own parents. Layers are taken off while they have at least one in
    ``PEEL_SHARE`` of what is left, ``PEELS`` at most: the many nodes at the bottom of a wide tree then never enter the
    rounds, nor do nodes with several parents that have only such nodes below them. The edges are stored before the
    first join, so that what makes them runs once."""
    layers: list[DataFrame] = []
    edges = writer.write(edges, "peel-edges")
    while len(layers) < PEELS:
        parents = edges.select(F.col("top").alias("id")).distinct().withColumn("_p", F.lit(True))
        flagged = edges.join(parents, "id", "left").select("id", "top", F.col("_p").isNull().alias("outer"))
        seen = Observation(f"peel{len(layers)}")
        outer = F.sum(F.when(F.col("outer"), 1).otherwise(0)).alias("outer")
        cut = writer.write(flagged.observe(seen, F.count(F.lit(1)).alias("rows"), outer), f"peel-{len(layers)}", split="outer")
        layers.append(cut.where("outer").select("id", "top"))
        edges = cut.where("NOT outer").select("id", "top")
        if PEEL_SHARE * (seen.get["outer"] or 0) < seen.get["rows"] or seen.get["outer"] == seen.get["rows"]:
            break
    return edges, layers


def _build_by_doubling(h: Hierarchy) -> DataFrame:
    """Pointer jumping over partial ancestor chains, for the nodes that have others below them.

    A row ``(id, top, anc)`` says: going up from ``id`` through ``anc`` (root-first,
    ending at the parent) reaches ``top = anc[0]``. It is complete when ``top`` is
    the root. Each round extends every incomplete row by each row of its ``top``
    (an equi-join on ``top = id``), so chain lengths double; a chain with a
    repeated node (a cycle) is dropped, and a chain whose ``top`` has no parent
    (a component cut off from the root) finds no partner and is dropped. For each
    node, every simple path to the root extends exactly one row, so the result
    has one row per root path, as the level walk gives. Complete rows are written
    once, to their round's ``done=true`` partition, and never moved again; the
    partial chains are in ``done=false`` and are deleted at the end.

    Nodes without children are on nobody's path: they are taken off before the rounds
    (:func:`peeled`) and get their parents' complete rows in one join each. Their rows are
    written as paths, one step longer than the parent's; chains are for the rounds alone.
    """
    spark = h.spark
    root = F.lit(h.root)
    writer = RoundWriter(spark, "index-doubling")
    edges, layers = peeled(h.edges.where(F.col("src") != root).select(F.col("src").alias("id"), F.col("dst").alias("top")), writer)
    start = edges.select("id", "top", F.array(F.col("top")).alias("anc"))
    # the root's own row rides along as complete (never joined: no open row has the root as top)
    seed = spark.range(1).select(root.cast("bigint").alias("id"), root.cast("bigint").alias("top"),
                                 F.array().cast("array<bigint>").alias("anc"))
    cur = writer.write(start.unionByName(seed).withColumn("done", F.col("top") == root), "round-0", split="done")
    schema = cur.schema
    tags = ["round-0"]
    k = 0
    while True:
        undone = cur.where(~F.col("done"))
        earlier = tags[:-1]
        look = cur
        if earlier:
            # of the rows finished before, only those at which an open chain has arrived: after the first rounds these
            # are few (nodes that have others 2^k below), so the join sees a small side and leaves the rest where it is
            tops = writer.write(undone.select(F.col("top").alias("_t")).distinct(), f"tops-{k}")
            done = writer.read(earlier, schema).where(F.col("done"))
            look = done.join(tops, F.col("id") == F.col("_t"), "left_semi").unionByName(cur)
        look = look.select(
            F.col("id").alias("_lid"), F.col("top").alias("_ltop"), F.col("anc").alias("_lanc"),
            F.col("done").alias("_ldone"))
        j = undone.join(look, F.col("top") == F.col("_lid"))
        simple = ~F.arrays_overlap(F.col("_lanc"), F.col("anc")) & ~F.array_contains(F.col("_lanc"), F.col("id"))
        ext = j.where(simple).select(
            "id", F.col("_ltop").alias("top"), F.concat(F.col("_lanc"), F.col("anc")).alias("anc"),
            F.col("_ldone").alias("done"))
        k += 1
        obs = Observation(f"doubling{k}")
        counted = ext.observe(obs, F.sum(F.when(F.col("done"), 0).otherwise(1)).alias("open"),
                              F.count(F.lit(1)).alias("rows"))
        cur = writer.write(counted, f"round-{k}", split="done")
        tags.append(f"round-{k}")
        if not obs.get["open"]:
            break
    schema = StructType([*schema.fields, StructField("path", StringType())])  # rounds have none
    joined = F.concat(F.lit(PATH_SEP), F.array_join(F.col("anc"), PATH_SEP),
                      F.when(F.size("anc") > 0, F.lit(PATH_SEP)).otherwise(F.lit("")))
    path = F.coalesce(F.col("path"), joined).alias("path")
    # a node of a layer has its parents in the core or in a layer further in
    total = writer.read(tags, schema).where(F.col("done")).count() if layers else 0
    for n, layer in reversed(list(enumerate(layers))):
        above = writer.read(tags, schema).where(F.col("done")).select(F.col("id").alias("_lid"), path)
        rows = layer.join(above.hint("merge") if total > FEW_ROWS else above, F.col("top") == F.col("_lid")).select(
            "id", child_path(F.col("path"), F.col("top")).alias("path"), F.lit(True).alias("done"))
        obs = Observation(f"layer{n}")
        writer.write(rows.observe(obs, F.count(F.lit(1)).alias("rows")), f"layer-{n}", split="done")
        total += obs.get["rows"]
        tags.append(f"layer-{n}")
    # the partial chains have been extended; only finished rows are the index
    writer.release("done", keep=("true",))
    for tag in [t for t in writer.paths if t.startswith(("tops-", "peel-"))]:
        writer.drop(tag)
    done = writer.read(tags, schema).where(F.col("done"))
    return with_derived(done.select("id", path)).select(*INDEX_SCHEMA.names)


def write_index(index: DataFrame, path: str) -> None:
    """Store the index as Parquet clustered by ``path``: a subtree is one contiguous, prunable range.

    All children of a node share one ``path``, so the range key is ``(path, id)``: a node with a
    third of all rows as children is still cut into many ranges, written by many tasks."""
    spread(index, INDEX_CLUSTERING).write.mode("overwrite").options(**PACKED).parquet(path)


def spread(index: DataFrame, keys: list[str]) -> DataFrame:
    """Index rows as they are stored, range-partitioned and sorted on ``keys``.

    Ids, paths and keys alone are shuffled; what else the rows have is read off the path after that."""
    sent = index.select(*dict.fromkeys(["id", "path", *keys]))
    return with_derived(clustered(sent, keys)).select(*index.columns)


def with_derived(rows: DataFrame) -> DataFrame:
    """Rows with ``(id, path)`` and the other columns of an index, as the path says them where they are missing."""
    said = {"ancestors": ancestors_of, "depth": depth_of, "parent": parent_of}
    return rows.withColumns({c: of(F.col("path")) for c, of in said.items() if c not in rows.columns})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored index; an index holding only ``(id, path)`` gets the derived columns added."""
    return with_derived(spark.read.parquet(path))


def is_small(questions: DataFrame) -> bool:
    """Spark estimates a question set at ``FEW_BYTES`` at most: sets read from a few small files, or made from such."""
    return int(str(questions._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= FEW_BYTES


def few_ids(questions: DataFrame, column: str) -> list[int] | None:
    """The different ids of a stored question set, or ``None`` if they are more than ``FEW_IDS``."""
    found = [r[0] for r in questions.select(F.col(column).cast("bigint")).distinct().take(FEW_IDS + 1)]
    return None if len(found) > FEW_IDS else sorted(x for x in found if x is not None)


def among(column: str, ids: list[int]) -> Column:
    """``column`` is one of ``ids``, as lists that Spark pushes to a Parquet scan value by value."""
    out = F.lit(False)
    for i in range(0, len(ids), LIST_IDS):
        out = out | F.col(column).isin(ids[i:i + LIST_IDS]) if i else F.col(column).isin(ids[:LIST_IDS])
    return out


class StoredIndex:
    """An index stored three ways, so that every search prunes its scan.

    * ``path``: clustered by ``(path, id)``; a subtree is one range of paths.
    * ``id``: sorted by ``id``; lookups of nodes.
    * ``parent``: ``(id, path, parent)`` sorted by ``(parent, path, id)``, so that children under one path lie side by
      side; lookups of children and siblings. A parent with very many children is cut into many files.

    Files follow the data's size. Row groups of the lookup copies are found by their smallest and
    largest key and by Bloom filters. A path lists the ancestors already: what a copy's rows have besides
    :attr:`STORED` is read off it, by searches that use it.
    """

    LOOKUPS = {"id": INDEX_SCHEMA, "parent": StructType([INDEX_SCHEMA[c] for c in ("id", "path", "parent")])}
    STORED = {"path": ["id", "path", "depth", "parent"], "id": ["id", "path"], "parent": ["id", "path", "parent"]}
    KEYS = {"path": INDEX_CLUSTERING, "id": ["id", "path"], "parent": ["parent", "path", "id"]}

    def __init__(self, spark: SparkSession, path: str, files: dict[str, list[str]] | None = None):
        """``files`` lists the files of each copy, where an update left some of them in place."""
        self.spark, self.path, self.files = spark, path.rstrip("/"), files or {}

    def copy(self, name: str) -> DataFrame:
        return self.read(name, *self.files.get(name, [f"{self.path}/{name}"]))

    def read(self, name: str, *files: str) -> DataFrame:
        """Files of a copy, with the columns that it has for searches."""
        stored = self.spark.read.schema(StructType([INDEX_SCHEMA[c] for c in self.STORED[name]])).parquet(*files)
        return with_derived(stored).select(*self.LOOKUPS.get(name, INDEX_SCHEMA).names)

    @property
    def by_path(self) -> DataFrame:
        return self.copy("path")

    def lookup(self, copy: str) -> DataFrame:
        return self.copy(copy)

    def write_copy(self, rows: DataFrame, name: str, folder: str, row_group: int | None = None) -> None:
        out = spread(rows.select(*self.STORED[name]), self.KEYS[name]).write.mode("overwrite").options(**PACKED)
        if name in self.LOOKUPS:
            out = out.option(f"parquet.bloom.filter.enabled#{name}", "true").option(
                f"parquet.bloom.filter.expected.ndv#{name}", str(BLOOM_IDS))
        (out.option("parquet.block.size", str(row_group)) if row_group else out).parquet(folder)

    def looked(self, questions: DataFrame, column: str) -> tuple[DataFrame, list[int] | None]:
        """The questions, and their different ids where these are few.

        Only a set that is estimated to be small is looked at, and it is stored before that, so that the
        search reads what was looked at: no question set is run twice, and a large one is not run early."""
        if not is_small(questions):
            return questions, None
        stored = RoundWriter(questions, "asked").write(questions, "questions")
        return stored, few_ids(stored, column)

    def rows_of(self, copy: str, few: list[int] | None) -> DataFrame:
        """Rows as a lookup copy has them: those whose key is in ``few``, pushed to its scan, or all, left to the join.

        All rows are read from the copy sorted by path, where what lies side by side is alike and so is shuffled in little room."""
        return self.by_path.select(*self.LOOKUPS[copy].names) if few is None else self.lookup(copy).where(among(copy, few))


def store_index(index: DataFrame, path: str, row_group: int | None = None) -> StoredIndex:
    """Write the three copies of an index and open them; ``row_group`` sets the lookup copies' row group size in bytes.

    The lookup copies are made from the first one: there, rows of one path lie side by side and so are shuffled in little room."""
    path = path.rstrip("/")
    stored = StoredIndex(index.sparkSession, path)
    stored.write_copy(index, "path", f"{path}/path")
    for name, schema in StoredIndex.LOOKUPS.items():
        stored.write_copy(stored.by_path.select(*schema.names), name, f"{path}/{name}", row_group)
    return stored
