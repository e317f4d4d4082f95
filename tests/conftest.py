from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arbor.plans.session import local_session  # noqa: E402

TAB_SEP = "\t|\t"

# Mini dump (see FIXTURES.md): child -> parent, in file order.
CHILDREN_OF_1 = [10239, 12884, 12908, 28384, 131567]
CHILDREN_OF_10239 = [35325, 439488, 552364, 39759, 451344, 12333, 1425366, 12429, 35268, 12877, 35237,
                     186616, 29258, 1714266, 686617]
MINI_EDGES = (
    [(1, 1)]
    + [(c, 1) for c in CHILDREN_OF_1]
    + [(c, 10239) for c in CHILDREN_OF_10239]
    + [(185751, 12884), (185752, 12884), (265963, 12884)]
    + [(9606, 131567), (63221, 9606)]
)
MINI_NAMES = [
    (1, "all"), (1, "root"),
    (9606, "Homo sapiens"), (9606, "Homo sapiens Linnaeus, 1758"), (9606, "human"), (9606, "humans"), (9606, "man"),
    (12884, "Viroid"), (12884, "Viroids"), (12884, "viroids"),
    (12908, "unclassified"), (12908, "unclassified"), (12908, "unclassified sequences"), (12908, "unclassified."),
]


def node_line(child: int, parent: int) -> str:
    return f"{child}{TAB_SEP}{parent}{TAB_SEP}no rank\t|"


def name_line(i: int, name: str) -> str:
    return f"{i}{TAB_SEP}{name}{TAB_SEP}{TAB_SEP}scientific name\t|"


def write_lines(path: str, lines: list[str]) -> str:
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.fixture(scope="session")
def spark():
    s = local_session(app="arbor-tests", cpus=4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def workdir():
    return tempfile.mkdtemp(prefix="arbor-tests-")


@pytest.fixture(scope="session")
def mini_paths(workdir):
    nodes = write_lines(os.path.join(workdir, "nodes.dmp"), [node_line(c, p) for c, p in MINI_EDGES])
    names = write_lines(os.path.join(workdir, "names.dmp"), [name_line(i, n) for i, n in MINI_NAMES])
    return nodes, names


@pytest.fixture(scope="session")
def mini(spark, mini_paths):
    from arbor import Hierarchy, build_vertices, read_edges, read_names

    nodes, names = mini_paths
    edges = read_edges(spark, nodes).cache()
    vertices = build_vertices(read_names(spark, names)).cache()
    return Hierarchy(edges, vertices, root=1)


@pytest.fixture(scope="session")
def mini_all_named(spark, mini):
    """Same tree, every node named (so motif searches see every edge)."""
    from pyspark.sql import functions as F

    from arbor import Hierarchy

    ids = mini.edges.select(F.col("src").alias("id")).union(spark.range(1).select(F.lit(1).cast("bigint").alias("id")))
    extra = ids.join(mini.vertices.select("id"), "id", "left_anti").select(
        "id", F.concat(F.lit(",n"), F.col("id").cast("string"), F.lit(",")).alias("name"),
        F.array(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("names"))
    return Hierarchy(mini.edges, mini.vertices.unionByName(extra).cache(), root=1)


def ids_df(spark, ids, col="vid"):
    from pyspark.sql.types import LongType, StructField, StructType

    return spark.createDataFrame([(int(i),) for i in ids], StructType([StructField(col, LongType())]))


def pairs_df(spark, pairs):
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("target", LongType()), StructField("source", LongType())])
    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], schema)
