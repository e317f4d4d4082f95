"""Registered queries over the driver's tables (the geo, dag and heap trees of
:mod:`arbor.sources.tables`). Each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame; iterative ones (index build, walks) run their rounds when called.

Question sets come from the tables themselves, so the work grows with the data:
every tree node, every vertex, every (customer, supplier nation) pair bought
from. Siblings are asked for one child of every parent (the smallest), so that
the answers are at most as many as the edges: asking every node for its siblings
emits all pairs inside each parent's children.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hierarchy import Hierarchy
from .operators import direct, documents, indexed, interval, jump, motif, trigrams
from .operators.index import StoredIndex, build_index, read_index, store_index
from .operators.rejects import index_rejects
from .operators.update import update_stored
from .operators.vertices import build_vertices, find_id_like, find_ids, name_rows_of, names_of
from .plans.materialize import RoundWriter, drop_runs
from .plans.skew import SkewConf
from .sources.dump import read_edges, read_names
from .sources.edges import edges_from, read_snapshot, write_snapshot
from .sources.tables import (
    CUSTOMER, LINE, NATION, ORDER, PART, REGION, ROOT, dag_edges, geo_edges, geo_names, geo_raw_edges, heap_edges, line_key, node_id, read_table,
)

# Thresholds low enough that the driver's small tables run the salted and the hot-node plans.
FORCED_SKEW = SkewConf(min_rows=200, max_keys=8, max_buckets=64)

_PREPARED: dict[tuple, object] = {}


def _prepared(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What several queries of a table folder share, made once per session; another folder's is released first."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _PREPARED if k[:2] != (app, sf_dir)]:
        old = _PREPARED.pop(key)
        if isinstance(old, Hierarchy) and key[0] == app:
            old.release()
    key = (app, sf_dir, name)
    if key not in _PREPARED:
        _PREPARED[key] = make()
    return _PREPARED[key]


def release_all(spark: SparkSession | None = None) -> None:
    """Drop everything the queries of this module prepared; with a session, also every folder that its runs wrote.

    Answers that were returned before are read from those folders, so they end with them."""
    for key in list(_PREPARED):
        old = _PREPARED.pop(key)
        if isinstance(old, Hierarchy):
            old.release()
    if spark is not None:
        drop_runs(spark)


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geo vertex table, written once as a snapshot: searches read it and never group names again."""
    def make() -> DataFrame:
        path = f"{RoundWriter(spark, 'vertices').base}/vertices"
        write_snapshot(build_vertices(geo_names(spark, sf_dir)), path, sort_by="id")
        return read_snapshot(spark, path)

    return _prepared(spark, sf_dir, "vertices", make)


def geo(spark: SparkSession, sf_dir: str) -> Hierarchy:
    """The geo hierarchy of a table folder, with its stored vertex table."""
    return _prepared(spark, sf_dir, "geo", lambda: Hierarchy(geo_edges(spark, sf_dir), vertices(spark, sf_dir), root=ROOT))


def geo_skewed(spark: SparkSession, sf_dir: str) -> Hierarchy:
    """The geo hierarchy under thresholds that make its larger parents hot."""
    return _prepared(spark, sf_dir, "geo-skewed", lambda: Hierarchy(
        geo_edges(spark, sf_dir), vertices(spark, sf_dir), root=ROOT, skew=FORCED_SKEW))


def dag(spark: SparkSession, sf_dir: str) -> Hierarchy:
    return _prepared(spark, sf_dir, "dag", lambda: Hierarchy(dag_edges(spark, sf_dir), vertices(spark, sf_dir), root=ROOT))


def stored_index(h: Hierarchy, sf_dir: str, max_level: int, name: str = "geo") -> StoredIndex:
    """An index as searches use it: built once per session and table folder, stored with its lookup copies."""
    return _prepared(h.spark, sf_dir, f"index-{name}-{max_level}", lambda: store_index(
        build_index(h, max_level), f"{RoundWriter(h.spark, 'stored-index').base}"))


def labels(h: Hierarchy, sf_dir: str, name: str = "geo") -> interval.Labels:
    """The interval labels of an index, made once per session and table folder."""
    return _prepared(h.spark, sf_dir, f"labels-{name}", lambda: interval.label_index(stored_index(h, sf_dir, -1, name).by_path))


def postings(spark: SparkSession, sf_dir: str) -> trigrams.Postings:
    return _prepared(spark, sf_dir, "postings", lambda: trigrams.build_postings(vertices(spark, sf_dir)))


def heap(spark: SparkSession, sf_dir: str) -> Hierarchy:
    return _prepared(spark, sf_dir, "heap", lambda: Hierarchy(heap_edges(spark, sf_dir)))


def broken_geo(spark: SparkSession, sf_dir: str) -> Hierarchy:
    """The geo tree and, apart from it, parts in pairs that are each other's parent, with their line items below:
    a part whose partner is missing has a parent that nothing is above."""
    part = read_table(spark, sf_dir, "part").select("p_partkey")
    partner = F.col("p_partkey").cast("bigint").bitwiseXOR(F.lit(1))
    loops = part.select(node_id("p_partkey", PART).alias("src"), node_id(partner, PART).alias("dst"))
    lines = read_table(spark, sf_dir, "lineitem").select(node_id(line_key(), LINE).alias("src"), node_id("l_partkey", PART).alias("dst")).distinct()
    return Hierarchy(edges_from(geo_raw_edges(spark, sf_dir).unionByName(loops).unionByName(lines)))


def tree_nodes(h: Hierarchy) -> DataFrame:
    """Every node of the tree: each child of an edge, and the root."""
    return h.edges.select(F.col("src").alias("vid")).unionByName(
        h.spark.range(1).select(F.lit(h.root).cast("bigint").alias("vid")))


def vertex_ids(h: Hierarchy) -> DataFrame:
    return h.require_vertices().select(F.col("id").alias("vid"))


def first_children(h: Hierarchy) -> DataFrame:
    """The smallest child of every parent."""
    return h.edges.groupBy("dst").agg(F.min("src").alias("vid")).select("vid")


def purchase_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer node, nation node of a supplier the customer bought from), from every line item."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    return j.select(node_id("o_custkey", CUSTOMER).alias("target"), node_id("s_nationkey", NATION).alias("source"))


def asked_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every market segment, nation and region name."""
    seg = read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"))
    nat = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    reg = read_table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return seg.unionByName(nat).unionByName(reg)


# ---- queries ---------------------------------------------------------------------------------

def q_edges(spark, sf):
    return geo(spark, sf).edges


def q_vertices(spark, sf):
    return geo(spark, sf).vertices


def q_index_l3(spark, sf):
    return build_index(geo(spark, sf), 3)


def q_index_full(spark, sf):
    return build_index(geo(spark, sf), -1)


def q_index_heap(spark, sf):
    return build_index(Hierarchy(heap_edges(spark, sf)), -1)


def q_children_direct(spark, sf):
    h = geo(spark, sf)
    return direct.children(h, vertex_ids(h))


def q_children_index(spark, sf):
    h = geo(spark, sf)
    return indexed.children(stored_index(h, sf, -1), vertex_ids(h), hot=h.hot_parents())


def q_children_salted(spark, sf):
    """Direct children with every larger parent spread over buckets."""
    h = geo_skewed(spark, sf)
    return direct.children(h, vertex_ids(h))


def q_children_index_salted(spark, sf):
    h = geo_skewed(spark, sf)
    return indexed.children(stored_index(geo(spark, sf), sf, -1), vertex_ids(h), hot=h.hot_parents())


def q_children_dag(spark, sf):
    """Children of every order in a tree with several parents, over the index."""
    h = dag(spark, sf)
    orders = read_table(spark, sf, "orders").select(node_id("o_orderkey", ORDER).alias("vid"))
    return indexed.children(stored_index(h, sf, -1, "dag"), orders)


def q_children_dag_direct(spark, sf):
    h = dag(spark, sf)
    return direct.children(h, read_table(spark, sf, "orders").select(node_id("o_orderkey", ORDER).alias("vid")))


def q_children_motif(spark, sf):
    h = geo(spark, sf)
    return motif.children(h, vertex_ids(h))


def q_siblings_direct(spark, sf):
    h = geo(spark, sf)
    return direct.siblings(h, first_children(h))


def q_siblings_index(spark, sf):
    h = geo(spark, sf)
    return indexed.siblings(stored_index(h, sf, -1), first_children(h), hot=h.hot_parents())


def q_siblings_motif(spark, sf):
    h = geo(spark, sf)
    return motif.siblings(h, first_children(h))


def q_subtree_members(spark, sf):
    h = geo(spark, sf)
    return indexed.subtree_members(stored_index(h, sf, -1), vertex_ids(h))


def q_subtree_members_few(spark, sf):
    """The five regions' subtrees: few enough that the scan reads their path ranges only."""
    h = geo(spark, sf)
    regions = read_table(spark, sf, "region").select(node_id("r_regionkey", REGION).alias("vid"))
    return indexed.subtree_members(stored_index(h, sf, -1), regions)


def q_find_id(spark, sf):
    return find_ids(geo_names(spark, sf), asked_names(spark, sf))


def q_find_id_like(spark, sf):
    return find_id_like(geo(spark, sf).vertices, "FURNITURE")


def q_motif_edge(spark, sf):
    m = motif.edge_motif(geo(spark, sf))
    return m.select(F.col("src.id").alias("src_id"), F.col("dst.id").alias("dst_id"),
                    F.col("src.name").alias("src_name"), F.col("dst.name").alias("dst_name"))


def q_path_names(spark, sf):
    h = geo(spark, sf)
    return indexed.path_names(stored_index(h, sf, -1), h.vertices)


def q_path_to_root_direct(spark, sf):
    h = geo(spark, sf)
    return direct.path_to_root(h, tree_nodes(h))


def q_path_to_root_hot(spark, sf):
    """The walk with its larger nodes routed through a broadcast."""
    h = geo_skewed(spark, sf)
    return direct.path_to_root(h, tree_nodes(h))


def q_path_to_root_index(spark, sf):
    h = geo(spark, sf)
    return indexed.path_to_root(stored_index(h, sf, -1), tree_nodes(h))


def q_path_to_root_motif(spark, sf):
    h = geo(spark, sf)
    return motif.path_to_root(h, tree_nodes(h))


def q_path_to_root_heap(spark, sf):
    h = Hierarchy(heap_edges(spark, sf))
    # every node of a deep tree is asked: pointer jumping instead of one round per level
    return direct.path_to_root(h, tree_nodes(h), method="doubling")


def q_is_subtree_direct(spark, sf):
    return direct.is_subtree(geo(spark, sf), purchase_pairs(spark, sf))


def q_is_subtree_index(spark, sf):
    return indexed.is_subtree(stored_index(geo(spark, sf), sf, -1), purchase_pairs(spark, sf))


def q_is_subtree_motif(spark, sf):
    return motif.is_subtree(geo(spark, sf), purchase_pairs(spark, sf))


def q_names_of(spark, sf):
    h = geo(spark, sf)
    return names_of(h.vertices, tree_nodes(h))


def q_children_doc(spark, sf):
    h = geo(spark, sf)
    return documents.children_doc(stored_index(h, sf, -1), h.vertices, tree_nodes(h), hot=h.hot_parents())


def q_path_doc(spark, sf):
    h = geo(spark, sf)
    return documents.path_doc(stored_index(h, sf, -1), h.vertices, tree_nodes(h))


def q_sibling_doc(spark, sf):
    h = geo(spark, sf)
    return documents.sibling_doc(stored_index(h, sf, -1), h.vertices, first_children(h), hot=h.hot_parents())


def q_nested_doc(spark, sf):
    h = geo(spark, sf)
    return documents.nested_doc(stored_index(h, sf, -1), h.vertices, vertex_ids(h), depth=2, hot=h.hot_parents())


def _dump_lines(spark, name: str, fields: list, rows: DataFrame) -> str:
    """``rows`` as lines of a dump file (padded fields between bars) in the shared folder."""
    path = f"{RoundWriter(spark, name).base}/dump"
    parts = [p for f in fields for p in (f, F.lit("\t|\t"))]
    rows.select(F.concat(*parts).alias("value")).write.text(path)
    return path


def q_edges_text(spark, sf):
    """The tables as a nodes dump, read back by the text reader."""
    raw = geo_raw_edges(spark, sf)
    return read_edges(spark, _dump_lines(
        spark, "nodes-dump", [F.col("src").cast("string"), F.col("dst").cast("string"), F.lit("no rank")], raw))


def q_vertices_text(spark, sf):
    """The name records as a names dump, read back and grouped; one line per name, an id's names in their order."""
    names = geo_names(spark, sf).repartitionByRange("id").sortWithinPartitions("id", "ord")
    return build_vertices(read_names(spark, _dump_lines(
        spark, "names-dump", [F.col("id").cast("string"), F.col("name"), F.lit(""), F.lit("scientific name")], names)))


def q_edges_snapshot(spark, sf):
    path = f"{RoundWriter(spark, 'edges-snapshot').base}/edges"
    write_snapshot(geo(spark, sf).edges, path, sort_by=["dst", "src"])
    return read_snapshot(spark, path)


def q_index_minimal(spark, sf):
    """An index stored as ``(id, path)`` alone: the reader derives the other columns from the path."""
    path = f"{RoundWriter(spark, 'index-minimal').base}/index"
    stored_index(geo(spark, sf), sf, -1).by_path.select("id", "path").write.parquet(path)
    return read_index(spark, path).select("id", "path", "depth", "parent", "ancestors")


def q_name_rows(spark, sf):
    """Every name of every node as a row of its own, from the name records."""
    return name_rows_of(geo_names(spark, sf), tree_nodes(geo(spark, sf)))


def q_subtree_members_interval(spark, sf):
    h = geo(spark, sf)
    return interval.subtree_members(labels(h, sf), vertex_ids(h))


def q_subtree_members_dag(spark, sf):
    """Members below every vertex of a tree with several parents: each once, over the intervals of all their paths."""
    h = dag(spark, sf)
    return interval.subtree_members(labels(h, sf, "dag"), vertex_ids(h))


def q_is_subtree_interval(spark, sf):
    return interval.is_subtree(labels(geo(spark, sf), sf), purchase_pairs(spark, sf))


def q_interval_labels(spark, sf):
    return labels(geo(spark, sf), sf).rows


def q_path_to_root_jump(spark, sf):
    h = geo(spark, sf)
    return jump.path_to_root(jump.tree_jumps(h), tree_nodes(h), h.root)


def q_path_to_root_jump_heap(spark, sf):
    h = heap(spark, sf)
    return jump.path_to_root(jump.tree_jumps(h), tree_nodes(h), h.root)


def q_is_subtree_near(spark, sf):
    """The walk with known depths: a customer's walk ends at the nations' depth."""
    h = geo(spark, sf)
    depths = _prepared(spark, sf, "depths", lambda: jump.depths(jump.tree_jumps(h), h))
    return direct.is_subtree(h, purchase_pairs(spark, sf), depths=depths)


def q_sibling_classes(spark, sf):
    h = geo(spark, sf)
    return indexed.sibling_classes(stored_index(h, sf, -1), hot=h.hot_parents())


def q_find_ids_like(spark, sf):
    """Every market segment, and the beginning and the end of every nation's name, as patterns."""
    seg = read_table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name"))
    nat = read_table(spark, sf, "nation").select("n_name")
    head = nat.select(F.concat(F.substring("n_name", 1, 4), F.lit("%")).alias("name"))
    tail = nat.select(F.concat(F.lit("%"), F.expr("right(n_name, 3)")).alias("name"))
    return trigrams.find_ids_like(postings(spark, sf), seg.unionByName(head).unionByName(tail))


def q_index_rejects(spark, sf):
    return index_rejects(broken_geo(spark, sf), 3)


def q_index_updated(spark, sf):
    """The stored index after all customers of nation 1, and so their orders, have moved to nation 2."""
    h = geo(spark, sf)
    moved = read_table(spark, sf, "customer").where("c_nationkey = 1")
    edge = lambda nation: moved.select(node_id("c_custkey", CUSTOMER).alias("src"), node_id(F.lit(nation), NATION).alias("dst"))
    return update_stored(stored_index(h, sf, -1), h, edge(2), edge(1)).by_path


def q_edges_text_permissive(spark, sf):
    """A nodes dump in which every nation adds a line without numbers, read in permissive mode."""
    raw = geo_raw_edges(spark, sf).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    bad = read_table(spark, sf, "nation").select(F.col("n_name").alias("src"), F.col("n_nationkey").cast("string").alias("dst"))
    return read_edges(spark, _dump_lines(spark, "bad-dump", [F.col("src"), F.col("dst"), F.lit("no rank")], raw.unionByName(bad)), mode="permissive")


QUERIES = {
    "edges": q_edges,
    "vertices": q_vertices,
    "index_l3": q_index_l3,
    "index_full": q_index_full,
    "index_heap": q_index_heap,
    "children_direct": q_children_direct,
    "children_index": q_children_index,
    "children_motif": q_children_motif,
    "children_salted": q_children_salted,
    "children_index_salted": q_children_index_salted,
    "children_dag": q_children_dag,
    "children_dag_direct": q_children_dag_direct,
    "siblings_direct": q_siblings_direct,
    "siblings_index": q_siblings_index,
    "siblings_motif": q_siblings_motif,
    "subtree_members": q_subtree_members,
    "subtree_members_few": q_subtree_members_few,
    "find_id": q_find_id,
    "find_id_like": q_find_id_like,
    "motif_edge": q_motif_edge,
    "path_names": q_path_names,
    "path_to_root_direct": q_path_to_root_direct,
    "path_to_root_index": q_path_to_root_index,
    "path_to_root_hot": q_path_to_root_hot,
    "path_to_root_motif": q_path_to_root_motif,
    "path_to_root_heap": q_path_to_root_heap,
    "is_subtree_direct": q_is_subtree_direct,
    "is_subtree_index": q_is_subtree_index,
    "is_subtree_motif": q_is_subtree_motif,
    "names_of": q_names_of,
    "children_doc": q_children_doc,
    "path_doc": q_path_doc,
    "sibling_doc": q_sibling_doc,
    "nested_doc": q_nested_doc,
    "edges_text": q_edges_text,
    "vertices_text": q_vertices_text,
    "edges_snapshot": q_edges_snapshot,
    "index_minimal": q_index_minimal,
    "name_rows": q_name_rows,
    "subtree_members_interval": q_subtree_members_interval,
    "subtree_members_dag": q_subtree_members_dag,
    "is_subtree_interval": q_is_subtree_interval,
    "interval_labels": q_interval_labels,
    "path_to_root_jump": q_path_to_root_jump,
    "path_to_root_jump_heap": q_path_to_root_jump_heap,
    "is_subtree_near": q_is_subtree_near,
    "sibling_classes": q_sibling_classes,
    "find_ids_like": q_find_ids_like,
    "index_rejects": q_index_rejects,
    "index_updated": q_index_updated,
    "edges_text_permissive": q_edges_text_permissive,
}
