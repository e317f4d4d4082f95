"""Golden facts of the reference's test suite, on the hand-written mini dump.

Each search is checked in all three variants (edges, index, motif) where the
reference has one.
"""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from arbor import build_index, find_id_like, find_ids, names_of
from arbor.operators import direct, documents, indexed, motif

from .conftest import CHILDREN_OF_1, CHILDREN_OF_10239, ids_df, pairs_df


def one(df, key, value, col):
    rows = df.where(F.col(key) == value).collect()
    assert len(rows) == 1, rows
    return rows[0][col]


def many(df, key, value, col):
    return sorted(r[col] for r in df.where(F.col(key) == value).collect())


@pytest.fixture(scope="module")
def index_full(mini):
    return build_index(mini, -1).cache()


@pytest.fixture(scope="module")
def index_l3(mini):
    return build_index(mini, 3).cache()


def test_edge_and_vertex_schema(mini):
    es = mini.edges.schema
    assert [(f.name, f.dataType.simpleString()) for f in es] == [
        ("src", "bigint"), ("dst", "bigint"), ("relationship", "string")]
    assert mini.edges.where("src = dst").count() == 0
    assert mini.edges.count() == 25
    assert {r.relationship for r in mini.edges.collect()} == {"parent"}
    vs = mini.vertices.schema
    assert [f.name for f in vs] == ["id", "name", "names"]
    assert vs["id"].dataType.simpleString() == "bigint"


def test_index_root_path(index_l3, index_full):
    assert one(index_l3, "id", 1, "path") == "/"
    assert one(index_full, "id", 12429, "path") == "/1/10239/"
    assert one(index_full, "id", 63221, "path") == "/1/131567/9606/"
    assert index_full.count() == 26
    # depth 3 keeps root and depths 1..3: everything here (63221 is at depth 3)
    assert index_l3.count() == 26


def test_index_depth_limit_is_honoured(mini):
    assert build_index(mini, 0).count() == 1
    assert build_index(mini, 1).count() == 6
    assert sorted(r.depth for r in build_index(mini, 2).collect()).count(2) == 19


@pytest.mark.parametrize("variant", ["direct", "index", "motif"])
def test_path_to_root(spark, mini_all_named, index_full, variant):
    ids = ids_df(spark, [12429, -1, 1])
    if variant == "direct":
        out = direct.path_to_root(mini_all_named, ids)
    elif variant == "index":
        out = indexed.path_to_root(index_full, ids)
    else:
        out = motif.path_to_root(mini_all_named, ids)
    assert one(out, "vid", 12429, "path") == [1, 10239, 12429]
    assert one(out, "vid", -1, "path") == []
    assert one(out, "vid", 1, "path") == []


@pytest.mark.parametrize("variant", ["direct", "index", "motif"])
def test_is_subtree(spark, mini_all_named, index_full, variant):
    pairs = pairs_df(spark, [(1, 12429), (12429, 1), (63221, 131567), (63221, 12884), (-5, -5)])
    fn = {"direct": lambda p: direct.is_subtree(mini_all_named, p),
          "index": lambda p: indexed.is_subtree(index_full, p),
          "motif": lambda p: motif.is_subtree(mini_all_named, p)}[variant]
    got = {(r.target, r.source): r.is_subtree for r in fn(pairs).collect()}
    assert got == {(1, 12429): False, (12429, 1): True, (63221, 131567): True, (63221, 12884): False,
                   (-5, -5): True}


@pytest.mark.parametrize("variant", ["direct", "index", "motif"])
def test_siblings(spark, mini_all_named, index_full, variant):
    ids = ids_df(spark, [1, 10239, -1])
    fn = {"direct": lambda q: direct.siblings(mini_all_named, q),
          "index": lambda q: indexed.siblings(index_full, q),
          "motif": lambda q: motif.siblings(mini_all_named, q)}[variant]
    out = fn(ids)
    assert many(out, "vid", 10239, "sibling") == [12884, 12908, 28384, 131567]
    assert many(out, "vid", 1, "sibling") == []
    assert many(out, "vid", -1, "sibling") == []


@pytest.mark.parametrize("variant", ["direct", "index", "motif"])
def test_children(spark, mini_all_named, index_full, variant):
    ids = ids_df(spark, [1, 10239, 63221, -1])
    fn = {"direct": lambda q: direct.children(mini_all_named, q),
          "index": lambda q: indexed.children(index_full, q),
          "motif": lambda q: motif.children(mini_all_named, q)}[variant]
    out = fn(ids)
    assert many(out, "vid", 1, "child") == sorted(CHILDREN_OF_1)
    kids = many(out, "vid", 10239, "child")
    assert kids == sorted(CHILDREN_OF_10239) and 12429 in kids
    assert many(out, "vid", 63221, "child") == []
    assert many(out, "vid", -1, "child") == []


def test_find_ids(spark, mini):
    q = spark.createDataFrame([("root",), ("Homo sapiens",), ("...",), ("",), (" 1758",)], "name string")
    got = {r.name: r.vid for r in find_ids(mini.vertices, q).collect()}
    assert got == {"root": 1, "Homo sapiens": 9606, "...": -1, "": -1, " 1758": -1}


def test_find_id_like_parity(mini):
    assert find_id_like(mini.vertices, "root").collect()[0].vid == 1
    assert find_id_like(mini.vertices, "Homo sapiens").collect()[0].vid == 9606
    assert find_id_like(mini.vertices, "...").collect()[0].vid == -1
    assert find_id_like(mini.vertices, "").collect()[0].vid == -1
    # the packed string lets a name with a comma match its second half, as the reference does
    assert find_id_like(mini.vertices, " 1758").collect()[0].vid == 9606
    # wildcards are live in parity mode
    assert find_id_like(mini.vertices, "Vir_id").collect()[0].vid == 12884


def test_names_of(spark, mini):
    out = names_of(mini.vertices, ids_df(spark, [1, 9606, -1, 10239]))
    got = {r.vid: r.name for r in out.collect()}
    assert got[1] == ",all,root,"
    assert got[9606] == ",Homo sapiens,Homo sapiens Linnaeus, 1758,human,humans,man,"
    assert got[-1] == ""
    assert got[10239] == ""


def test_names_keep_duplicates_and_file_order(mini):
    row = mini.vertices.where("id = 12908").collect()[0]
    assert row.names == ["unclassified", "unclassified", "unclassified sequences", "unclassified."]
    assert row.name == ",unclassified,unclassified,unclassified sequences,unclassified.,"


def doc_rows(df):
    """``{vid: (head node, [(level, parent, node), ...] by level and id)}``."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.vid, r.level, r.id)):
        node = json.loads(r.json)
        assert node["ID"] == r.id
        if r.level == 0:
            assert r.vid not in out and r.parent is None and r.id == r.vid
            out[r.vid] = (node, [])
        else:
            out[r.vid][1].append((r.level, r.parent, node))
    return out


def test_children_document(spark, mini, index_l3):
    docs = doc_rows(documents.children_doc(index_l3, mini.vertices, ids_df(spark, [1, 12884, 424242])))
    head, entries = docs[1]
    assert head == {"ID": 1, "Name": " all root "}
    assert [n["ID"] for _, _, n in entries] == sorted(CHILDREN_OF_1)
    assert all(level == 1 and parent == 1 for level, parent, _ in entries)
    assert [n["Name"] for _, _, n in entries if n["ID"] == 12884] == [" Viroid Viroids viroids "]
    assert [n["ID"] for _, _, n in docs[12884][1]] == [185751, 185752, 265963]
    assert docs[424242] == ({"ID": 424242, "Name": ""}, [])


def test_path_and_sibling_documents(spark, mini, index_l3):
    p = {r.vid: json.loads(r.json) for r in documents.path_doc(index_l3, mini.vertices,
                                                                ids_df(spark, [63221, 1, -1])).collect()}
    assert [n["ID"] for n in p[63221]] == [1, 131567, 9606, 63221]
    assert p[63221][0]["Name"] == " all root " and p[63221][1]["Name"] == ""
    assert p[1] == [] and p[-1] == []
    s = doc_rows(documents.sibling_doc(index_l3, mini.vertices, ids_df(spark, [12884, 1])))
    assert [(parent, n["ID"]) for _, parent, n in s[12884][1]] == [(1, 10239), (1, 12908), (1, 28384), (1, 131567)]
    assert s[1][1] == []


def test_nested_document(spark, mini, index_full):
    head, entries = doc_rows(documents.nested_doc(index_full, mini.vertices, ids_df(spark, [1]), depth=2))[1]
    assert head["Name"] == " all root "
    assert [n["ID"] for level, _, n in entries if level == 1] == sorted(CHILDREN_OF_1)
    assert [n["ID"] for level, parent, n in entries if parent == 12884] == [185751, 185752, 265963]
    assert not [n for level, parent, n in entries if parent == 28384]


def test_subtree_members(spark, index_full):
    out = indexed.subtree_members(index_full, ids_df(spark, [131567, 63221, -1]))
    assert many(out, "vid", 131567, "member") == [9606, 63221, 131567]
    assert many(out, "vid", 63221, "member") == [63221]
    assert many(out, "vid", -1, "member") == []
