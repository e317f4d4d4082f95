"""Column expressions shared by the operators. All are built-in JVM functions
(whole-stage codegen friendly); nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on:
#   field separator of the dump files: "|"
#   characters stripped around a field: tab and space (Scala's String.trim also removes tabs)
#   separator inside a stored path: "/"; the root's path is "/"
#   separator of the packed name string: ","; display names replace "," by " "
FIELD_SEPARATOR_REGEX = "[|]"
PAD_CHARS = "\t "
PATH_SEP = "/"
NAME_SEP = ","


def strip_pad(c: Column) -> Column:
    """Trim tabs and spaces on both ends (``trim()`` alone leaves tabs)."""
    return F.btrim(c, F.lit(PAD_CHARS))


def to_id(c: Column, strict: bool = True) -> Column:
    """Text to bigint: failing on bad text in strict mode (ANSI cast), NULL in permissive mode."""
    return c.cast("bigint") if strict else c.try_cast("bigint")


def child_path(path: Column, node_id: Column) -> Column:
    """Path stored for a child of ``node_id``: the parent's path, then the parent, then ``/``."""
    return F.concat(path, node_id.cast("string"), F.lit(PATH_SEP))


def ancestors_of(path: Column) -> Column:
    """Root-first ancestor ids parsed from a stored path (``"/"`` and ``""`` give an empty array)."""
    parts = F.filter(F.split(path, PATH_SEP), lambda x: x != F.lit(""))
    inner = F.btrim(path, F.lit(PATH_SEP))
    ids = F.when(inner == F.lit(""), empty_ids()).otherwise(F.split(inner, PATH_SEP).cast("array<bigint>"))
    # empty parts are only looked for where there are some
    return F.when(F.contains(path, F.lit(2 * PATH_SEP)), F.transform(parts, lambda x: x.cast("bigint"))).otherwise(ids)


def _well_formed(path: Column) -> Column:
    return path.startswith(PATH_SEP) & path.endswith(PATH_SEP) & ~F.contains(path, F.lit(2 * PATH_SEP))


def depth_of(path: Column) -> Column:
    """How many ancestors a stored path lists; one written as :func:`child_path` does is not taken apart for that."""
    bars = F.length(path) - F.length(F.replace(path, F.lit(PATH_SEP), F.lit("")))
    return F.when(_well_formed(path), bars - 1).otherwise(F.size(ancestors_of(path))).cast("int")


def parent_of(path: Column) -> Column:
    """The last ancestor that a stored path lists, null if it lists none."""
    last = F.substring_index(F.substring_index(path, PATH_SEP, -2), PATH_SEP, 1)
    last = F.when(path != F.lit(PATH_SEP), last.cast("bigint"))
    return F.when(_well_formed(path), last).otherwise(F.try_element_at(ancestors_of(path), F.lit(-1)))


def display_name(name: Column) -> Column:
    """Name as shown in documents: the packed ``,a,b,`` string with commas as spaces, ``""`` if missing."""
    return F.replace(F.coalesce(name, F.lit("")), F.lit(NAME_SEP), F.lit(" "))


def packed_names(names: Column) -> Column:
    """Array of names to the packed ``,n1,n2,`` string kept for parity."""
    return F.concat(F.lit(NAME_SEP), F.array_join(names, NAME_SEP), F.lit(NAME_SEP))


def node(id_col: Column, name_col: Column) -> Column:
    """Document node ``{ID, Name}``."""
    return F.struct(id_col.cast("bigint").alias("ID"), display_name(name_col).alias("Name"))


def empty_ids() -> Column:
    return F.array().cast("array<bigint>")
