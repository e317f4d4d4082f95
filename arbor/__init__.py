"""arbor: questions about large trees held as Spark tables.

Typical use::

    from arbor import Hierarchy, read_edges, read_names, build_vertices, build_index
    from arbor.operators import direct, indexed, motif, documents, interval, jump, trigrams, update, rejects

    h = Hierarchy(read_edges(spark, "nodes.dmp"), build_vertices(read_names(spark, "names.dmp")), root=1)
    index = build_index(h, max_level=-1)
    write_index(index, "s3://bucket/tree-index")
    answers = indexed.path_to_root(read_index(spark, "s3://bucket/tree-index"), ids_df)
"""

from .hierarchy import Hierarchy
from .operators.index import build_index, read_index, store_index, write_index
from .operators.interval import label_index
from .operators.jump import tree_jumps
from .operators.rejects import index_rejects
from .operators.trigrams import build_postings, find_ids_like
from .operators.update import update_index, update_stored
from .operators.vertices import build_vertices, find_id_like, find_ids, name_rows_of, names_of
from .sources.dump import read_edges, read_names
from .sources.edges import edges_from, read_snapshot, write_snapshot

__all__ = [
    "Hierarchy",
    "build_index",
    "read_index",
    "store_index",
    "write_index",
    "update_index",
    "update_stored",
    "index_rejects",
    "label_index",
    "tree_jumps",
    "build_postings",
    "find_ids_like",
    "build_vertices",
    "find_ids",
    "find_id_like",
    "names_of",
    "name_rows_of",
    "read_edges",
    "read_names",
    "edges_from",
    "read_snapshot",
    "write_snapshot",
]
