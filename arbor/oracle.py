"""DuckDB SQL computing the same answers as :mod:`arbor.workloads`, written
independently (recursive CTEs instead of rounds of joins). Tables ``region
nation customer supplier orders lineitem`` are views on the same Parquet files.
Column names match the Spark queries."""

from __future__ import annotations

GEO = """
WITH RECURSIVE raw(src, dst) AS (
  SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT)
  UNION ALL SELECT CAST(r_regionkey AS BIGINT) * 8 + 2, CAST(1 AS BIGINT) FROM region
  UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 8 + 3, CAST(n_regionkey AS BIGINT) * 8 + 2 FROM nation
  UNION ALL SELECT CAST(c_custkey AS BIGINT) * 8 + 4, CAST(c_nationkey AS BIGINT) * 8 + 3 FROM customer
  UNION ALL SELECT CAST(s_suppkey AS BIGINT) * 8 + 5, CAST(s_nationkey AS BIGINT) * 8 + 3 FROM supplier
  UNION ALL SELECT CAST(o_orderkey AS BIGINT) * 8 + 6, CAST(o_custkey AS BIGINT) * 8 + 4 FROM orders
  {more_edges}),
e AS (SELECT src, dst, 'parent' AS relationship FROM raw WHERE src <> dst),
p(id, path, depth, parent, ancestors) AS (
  SELECT CAST(1 AS BIGINT), '/', 0, CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT e.src, p.path || p.id || '/', p.depth + 1, p.id, list_append(p.ancestors, p.id)
  FROM p JOIN e ON e.dst = p.id
  WHERE e.src <> 1 AND NOT list_contains(list_append(p.ancestors, p.id), e.src) {depth_limit}),
nm(id, ord, name) AS (
  SELECT CAST(1 AS BIGINT), 0, 'all' UNION ALL SELECT CAST(1 AS BIGINT), 1, 'root'
  UNION ALL SELECT CAST(r_regionkey AS BIGINT) * 8 + 2, 0, r_name FROM region
  UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 8 + 3, 0, n_name FROM nation
  UNION ALL SELECT CAST(c_custkey AS BIGINT) * 8 + 4, 0, c_name FROM customer
  UNION ALL SELECT CAST(c_custkey AS BIGINT) * 8 + 4, 1, c_mktsegment FROM customer
  UNION ALL SELECT CAST(s_suppkey AS BIGINT) * 8 + 5, 0, s_name FROM supplier),
v AS (SELECT id, ',' || string_agg(name, ',' ORDER BY ord) || ',' AS name, list(name ORDER BY ord) AS names
      FROM nm GROUP BY id),
nodes AS (SELECT src AS vid FROM e UNION ALL SELECT CAST(1 AS BIGINT)),
me AS (SELECT e.* FROM e WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v)),
first_child AS (SELECT min(src) AS vid FROM e GROUP BY dst),
order_ids AS (SELECT CAST(o_orderkey AS BIGINT) * 8 + 6 AS vid FROM orders),
pairs AS (SELECT DISTINCT CAST(o.o_custkey AS BIGINT) * 8 + 4 AS target, CAST(s.s_nationkey AS BIGINT) * 8 + 3 AS source
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)
"""

HEAP = """
WITH RECURSIVE e AS (
  SELECT CAST(o_orderkey + 1 AS BIGINT) AS src, CAST((o_orderkey + 1) // 2 AS BIGINT) AS dst FROM orders
  WHERE o_orderkey + 1 <> (o_orderkey + 1) // 2),
p(id, path, depth, parent, ancestors) AS (
  SELECT CAST(1 AS BIGINT), '/', 0, CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT e.src, p.path || p.id || '/', p.depth + 1, p.id, list_append(p.ancestors, p.id)
  FROM p JOIN e ON e.dst = p.id
  WHERE e.src <> 1 AND NOT list_contains(list_append(p.ancestors, p.id), e.src)),
nodes AS (SELECT src AS vid FROM e UNION ALL SELECT CAST(1 AS BIGINT))
"""

NODE = "{{'ID': {i}, 'Name': replace(coalesce({n}, ''), ',', ' ')}}"
EMPTY_NODES = "CAST([] AS STRUCT(\"ID\" BIGINT, \"Name\" VARCHAR)[])"
# the dag tree's further edges: order below its line items' suppliers, line item below its order
DAG_EDGES = """UNION SELECT CAST(l_orderkey AS BIGINT) * 8 + 6, CAST(l_suppkey AS BIGINT) * 8 + 5 FROM lineitem
  UNION SELECT (CAST(l_orderkey AS BIGINT) * 64 + l_linenumber) * 8 + 7, CAST(l_orderkey AS BIGINT) * 8 + 6 FROM lineitem"""


def _geo(body: str, depth_limit: str = "", more_edges: str = "") -> str:
    return GEO.format(depth_limit=depth_limit, more_edges=more_edges) + body


# parts in pairs (2, 3), (4, 5), .. that are each other's parent, and their line items below them
BROKEN_EDGES = """UNION ALL SELECT CAST(p_partkey AS BIGINT) * 8, xor(CAST(p_partkey AS BIGINT), CAST(1 AS BIGINT)) * 8 FROM part
  UNION SELECT (CAST(l_orderkey AS BIGINT) * 64 + l_linenumber) * 8 + 7, CAST(l_partkey AS BIGINT) * 8 FROM lineitem"""


def _moved(sql: str) -> str:
    """The geo tree with the customers of nation 1 in nation 2."""
    return sql.replace("CAST(c_nationkey AS BIGINT) * 8 + 3", "CAST(CASE WHEN c_nationkey = 1 THEN 2 ELSE c_nationkey END AS BIGINT) * 8 + 3")


def _doc_rows(rows: str) -> str:
    # ``rows``: SELECTs of (vid, level, parent, id); the node's JSON comes from one join with the vertices
    return (f"SELECT d.vid, CAST(d.level AS INTEGER) AS level, d.parent, d.id, "
            f"CAST(to_json({NODE.format(i='d.id', n='v.name')}) AS VARCHAR) AS json "
            f"FROM ({rows}) d LEFT JOIN v ON v.id = d.id")


def _path_expr() -> str:
    # root and unknown ids: empty; else ancestors then the id itself
    return "CASE WHEN p.id IS NULL OR len(p.ancestors) = 0 THEN CAST([] AS BIGINT[]) " \
           "ELSE list_append(p.ancestors, q.vid) END"


ORACLE = {
    "edges": _geo("SELECT src, dst, relationship FROM e"),
    "vertices": _geo("SELECT id, name, names FROM v"),
    "index_l3": _geo("SELECT id, path, depth, parent, ancestors FROM p", "AND p.depth < 3"),
    "index_full": _geo("SELECT id, path, depth, parent, ancestors FROM p"),
    "index_heap": HEAP + "SELECT id, path, depth, parent, ancestors FROM p",
    "children_direct": _geo("SELECT v.id AS vid, e.src AS child FROM v JOIN e ON e.dst = v.id"),
    "children_index": _geo("SELECT v.id AS vid, c.id AS child FROM v JOIN p pv ON pv.id = v.id "
                           "JOIN p c ON c.parent = v.id AND c.path = pv.path || v.id || '/'"),
    "children_salted": _geo("SELECT v.id AS vid, e.src AS child FROM v JOIN e ON e.dst = v.id"),
    "children_index_salted": _geo("SELECT v.id AS vid, e.src AS child FROM v JOIN e ON e.dst = v.id"),
    "children_dag": _geo("SELECT q.vid, e.src AS child FROM order_ids q JOIN e ON e.dst = q.vid", "", DAG_EDGES),
    "children_dag_direct": _geo("SELECT q.vid, e.src AS child FROM order_ids q JOIN e ON e.dst = q.vid", "", DAG_EDGES),
    "children_motif": _geo("SELECT v.id AS vid, me.src AS child FROM v JOIN me ON me.dst = v.id"),
    "siblings_direct": _geo("SELECT DISTINCT q.vid, b.src AS sibling FROM first_child q "
                            "JOIN (SELECT src, min(dst) AS dst FROM e WHERE src <> 1 GROUP BY src) a ON a.src = q.vid "
                            "JOIN e b ON b.dst = a.dst AND b.src <> q.vid"),
    "siblings_index": _geo("SELECT DISTINCT q.vid, s.id AS sibling FROM first_child q "
                           "JOIN p m ON m.id = q.vid JOIN p s ON s.parent = m.parent AND s.path = m.path "
                           "AND s.id <> q.vid"),
    "siblings_motif": _geo("SELECT q.vid, b.src AS sibling FROM first_child q "
                           "JOIN me a ON a.src = q.vid JOIN me b ON b.dst = a.dst AND b.src <> q.vid"),
    "subtree_members": _geo("SELECT DISTINCT v.id AS vid, x.member FROM v JOIN "
                            "(SELECT p.id AS member, unnest(list_append(p.ancestors, p.id)) AS above FROM p) x ON x.above = v.id"),
    "subtree_members_few": _geo("SELECT DISTINCT q.vid, p.id AS member FROM "
                                "(SELECT CAST(r_regionkey AS BIGINT) * 8 + 2 AS vid FROM region) q "
                                "JOIN p ON list_contains(p.ancestors, q.vid) OR p.id = q.vid"),
    "find_id": _geo("SELECT q.name, CASE WHEN q.name = '' THEN CAST(-1 AS BIGINT) "
                    "ELSE coalesce(min(vn.id), CAST(-1 AS BIGINT)) END AS vid FROM "
                    "(SELECT c_mktsegment AS name FROM customer UNION SELECT n_name FROM nation "
                    "UNION SELECT r_name FROM region) q "
                    "LEFT JOIN (SELECT id, unnest(names) AS name FROM v) vn ON vn.name = q.name GROUP BY q.name"),
    "find_id_like": _geo("SELECT 'FURNITURE' AS name, coalesce(min(id), CAST(-1 AS BIGINT)) AS vid FROM v "
                         "WHERE name LIKE '%,FURNITURE,%'"),
    "motif_edge": _geo("SELECT e.src AS src_id, e.dst AS dst_id, s.name AS src_name, d.name AS dst_name "
                       "FROM e JOIN v s ON s.id = e.src JOIN v d ON d.id = e.dst"),
    "path_names": _geo("SELECT a.vid, CAST(a.pos - 1 AS INTEGER) AS pos, a.ancestor, "
                       "coalesce(v.name, '') AS name FROM (SELECT p.id AS vid, unnest(p.ancestors) AS ancestor, "
                       "generate_subscripts(p.ancestors, 1) AS pos FROM p) a LEFT JOIN v ON v.id = a.ancestor"),
    "path_to_root_direct": _geo(f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                                "LEFT JOIN p ON p.id = q.vid"),
    "path_to_root_index": _geo(f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                               "LEFT JOIN p ON p.id = q.vid"),
    "path_to_root_hot": _geo(f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                             "LEFT JOIN p ON p.id = q.vid"),
    # orders are not vertices, so a motif walk from an order finds no first hop
    "path_to_root_motif": _geo(f"SELECT q.vid, CASE WHEN q.vid NOT IN (SELECT id FROM v) THEN CAST([] AS BIGINT[]) "
                               f"ELSE {_path_expr()} END AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                               "LEFT JOIN p ON p.id = q.vid"),
    "path_to_root_heap": HEAP + f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                                "LEFT JOIN p ON p.id = q.vid",
    "is_subtree_direct": _geo("SELECT q.target, q.source, (q.target = q.source OR "
                              "coalesce(list_contains(p.ancestors, q.source), false)) AS is_subtree "
                              "FROM pairs q LEFT JOIN p ON p.id = q.target"),
    "is_subtree_index": _geo("SELECT q.target, q.source, (q.target = q.source OR "
                             "coalesce(list_contains(p.ancestors, q.source), false)) AS is_subtree "
                             "FROM pairs q LEFT JOIN p ON p.id = q.target"),
    "is_subtree_motif": _geo("SELECT q.target, q.source, (q.target = q.source OR "
                             "coalesce(list_contains(p.ancestors, q.source), false)) AS is_subtree "
                             "FROM pairs q LEFT JOIN p ON p.id = q.target"),
    "names_of": _geo("SELECT q.vid, CASE WHEN q.vid < 1 THEN '' ELSE coalesce(v.name, '') END AS name "
                     "FROM (SELECT DISTINCT vid FROM nodes) q LEFT JOIN v ON v.id = q.vid"),
    "children_doc": _geo(_doc_rows(
        "SELECT vid, 0 AS level, CAST(NULL AS BIGINT) AS parent, vid AS id FROM (SELECT DISTINCT vid FROM nodes) "
        "UNION ALL SELECT c.parent, 1, c.parent, c.id FROM p c WHERE c.parent IS NOT NULL")),
    "path_doc": _geo(
        f"SELECT q.vid, CAST(to_json(coalesce(d.nodes, {EMPTY_NODES})) AS VARCHAR) AS json "
        "FROM (SELECT DISTINCT vid FROM nodes) q LEFT JOIN "
        f"(SELECT h.vid, list({NODE.format(i='h.step', n='v.name')} ORDER BY h.pos) AS nodes FROM "
        "(SELECT p.id AS vid, unnest(list_append(p.ancestors, p.id)) AS step, "
        "generate_subscripts(list_append(p.ancestors, p.id), 1) AS pos FROM p WHERE len(p.ancestors) > 0) h "
        "LEFT JOIN v ON v.id = h.step GROUP BY h.vid) d ON d.vid = q.vid"),
    "sibling_doc": _geo(_doc_rows(
        "SELECT vid, 0 AS level, CAST(NULL AS BIGINT) AS parent, vid AS id FROM first_child "
        "UNION ALL SELECT q.vid, 1, m.parent, s.id FROM first_child q JOIN p m ON m.id = q.vid "
        "JOIN p s ON s.parent = m.parent AND s.path = m.path AND s.id <> q.vid")),
    "nested_doc": _geo(_doc_rows(
        "SELECT id AS vid, 0 AS level, CAST(NULL AS BIGINT) AS parent, id FROM v "
        "UNION ALL SELECT v.id, 1, v.id, c.id FROM v JOIN p c ON c.parent = v.id "
        "UNION ALL SELECT v.id, 2, c.id, g.id FROM v JOIN p c ON c.parent = v.id JOIN p g ON g.parent = c.id")),
    "edges_text": _geo("SELECT src, dst, relationship FROM e"),
    "vertices_text": _geo("SELECT id, name, names FROM v"),
    "edges_snapshot": _geo("SELECT src, dst, relationship FROM e"),
    "index_minimal": _geo("SELECT id, path, depth, parent, ancestors FROM p"),
    "name_rows": _geo("SELECT DISTINCT q.vid, CAST(nm.ord AS INTEGER) AS ord, nm.name FROM nodes q JOIN nm ON nm.id = q.vid"),
    "subtree_members_interval": _geo("SELECT DISTINCT v.id AS vid, x.member FROM v JOIN "
                                     "(SELECT p.id AS member, unnest(list_append(p.ancestors, p.id)) AS above FROM p) x ON x.above = v.id"),
    "subtree_members_dag": _geo("SELECT DISTINCT v.id AS vid, x.member FROM v JOIN "
                                "(SELECT p.id AS member, unnest(list_append(p.ancestors, p.id)) AS above FROM p) x ON x.above = v.id", "", DAG_EDGES),
    "is_subtree_interval": _geo("SELECT q.target, q.source, (q.target = q.source OR "
                                "coalesce(list_contains(p.ancestors, q.source), false)) AS is_subtree "
                                "FROM pairs q LEFT JOIN p ON p.id = q.target"),
    # siblings are visited by id: a node's number is the count of nodes before it in the order of the ids on its path
    "interval_labels": _geo("SELECT a.id, path, depth, parent, first, first + z.size - 1 AS last FROM "
                            "(SELECT *, row_number() OVER (ORDER BY list_append(ancestors, id)) AS first FROM p) a JOIN "
                            "(SELECT above AS id, count(*) AS size FROM (SELECT unnest(list_append(ancestors, id)) AS above FROM p) "
                            "GROUP BY above) z ON z.id = a.id"),
    "path_to_root_jump": _geo(f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                              "LEFT JOIN p ON p.id = q.vid"),
    "path_to_root_jump_heap": HEAP + f"SELECT q.vid, {_path_expr()} AS path FROM (SELECT DISTINCT vid FROM nodes) q "
                                     "LEFT JOIN p ON p.id = q.vid",
    "is_subtree_near": _geo("SELECT q.target, q.source, (q.target = q.source OR "
                            "coalesce(list_contains(p.ancestors, q.source), false)) AS is_subtree "
                            "FROM pairs q LEFT JOIN p ON p.id = q.target"),
    "sibling_classes": _geo("SELECT parent, path, id AS member, count(*) OVER (PARTITION BY parent, path) AS class_size "
                            "FROM p WHERE parent IS NOT NULL"),
    "find_ids_like": _geo("SELECT q.name, coalesce(min(v.id), CAST(-1 AS BIGINT)) AS vid FROM "
                          "(SELECT c_mktsegment AS name FROM customer UNION SELECT substring(n_name, 1, 4) || '%' FROM nation "
                          "UNION SELECT '%' || right(n_name, 3) FROM nation) q "
                          "LEFT JOIN v ON v.name LIKE '%,' || q.name || ',%' GROUP BY q.name"),
    "index_rejects": _geo(
        ", ids AS (SELECT src AS id FROM e UNION SELECT dst FROM e), orphan(id) AS ("
        "SELECT id FROM ids WHERE id <> 1 AND id NOT IN (SELECT src FROM e WHERE src <> 1) UNION SELECT e.src FROM orphan o JOIN e ON e.dst = o.id) "
        "SELECT i.id, CASE WHEN m.depth > 3 THEN 'past level' WHEN i.id IN (SELECT id FROM orphan) THEN 'orphan' ELSE 'cycle' END AS reason "
        "FROM ids i LEFT JOIN (SELECT id, min(depth) AS depth FROM p GROUP BY id) m ON m.id = i.id WHERE m.depth IS NULL OR m.depth > 3",
        "", BROKEN_EDGES),
    "index_updated": _moved(_geo("SELECT id, path, depth, parent, ancestors FROM p")),
    "edges_text_permissive": _geo("SELECT src, dst, relationship FROM e"),
}
