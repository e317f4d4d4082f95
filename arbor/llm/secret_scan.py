"""Secret scans of whole documents (operator 6), with DataFrame functions only.

Three fixed patterns give the base spans (``assign``, ``access``, ``hex``). The
method adds ``entropy`` spans: candidate strings (runs of base64 / URL-safe
characters) are read through a window of ``WINDOW`` characters; the window's
character counts and the sum of ``c * log2(c)`` are updated for the one character
that enters and the one that leaves, so each step gives the Shannon entropy
without counting again. Windows at or above their character class's threshold
are joined into spans. An allow-list suppresses candidates that are ordinary:
letters only, digits only, UUIDs, paths and dashed or dotted word lists, sample
keys, and spans that a base span already covers in part.

Each pattern is run only on texts that a plain substring test or a wider
pattern lets through. Positions are code points, ends exclusive.

Defined cases: null or empty text has no spans; repeated rows give repeated
results; very long texts are read whole; an empty table gives no rows; other columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

# The base patterns, and the least length of group 2 (assign) or of the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

#: Entropy method: window length, and least bits per character in a window, by character class: hexadecimal digits, letters of
#: one case with digits (base32 is such), all others. Each is what 96 of 100 random strings of 24 characters of that class pass.
WINDOW = 20
THRESHOLD = {"hex": 3.0, "one_case": 3.55, "base64": 3.8}
CLASSES = {"hex": "^[0-9a-fA-F]+$", "one_case": "^([a-z0-9]+|[A-Z0-9]+)=*$"}
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
# Candidates that are no secrets. Letters only, digits only, UUIDs, sample keys.
ALLOWED = (
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|placeholder|xxxx|0123456789",
)
# So are words and short numbers joined by - _ / (each part is tested by itself, so that no pattern recurses).
JOINTS, PART = r"[-_/=]+", r"^([A-Z]?[a-z]*|[A-Z]+|[0-9]{1,4})$"


def _quoted(s: str) -> str:
    return "r'" + s + "'" if "'" not in s else 'r"' + s + '"' if '"' not in s else "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: str, pattern: str, keep: str = "true", group: int = 0) -> str:
    """SQL: spans ``struct<start, ord, stop, word>`` of a pattern's matches in ``text`` that satisfy ``keep`` (of ``g``, a group).

    The pieces between matches and the matches themselves, in order, give the
    positions as running sums of their lengths.
    """
    q = _quoted(pattern)
    return f"""
        aggregate(
            zip_with(
                zip_with(regexp_extract_all(text, {q}, 0), regexp_extract_all(text, {q}, {group}), (m, g) -> struct(m, g)),
                transform(split(text, {q}, -1), p -> length(p)),
                (mg, gap) -> struct(mg.m AS m, mg.g AS g, gap AS gap)),
            struct(0L AS at, CAST(array() AS array<struct<start: bigint, ord: int, stop: bigint, word: string>>) AS found),
            (acc, x) -> if(x.m IS NULL, acc, struct(
                acc.at + x.gap + length(x.m) AS at,
                if({keep.replace('g.', 'x.g')}, concat(acc.found, array(struct(
                    acc.at + x.gap AS start, {KINDS.index(kind)} AS ord, acc.at + x.gap + length(x.m) AS stop, x.m AS word))),
                    acc.found) AS found)),
            acc -> acc.found)"""


def _windows() -> str:
    """SQL: the entropy spans within one candidate ``c`` (``struct<start, ord, stop, word>``), as offsets in the text."""
    gain = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(WINDOW + 1)) + ")"
    total, alphabet = math.log2(WINDOW), len(ALPHABET)
    least = " ".join(f"WHEN c.word RLIKE '{pattern}' THEN {THRESHOLD[k]}D" for k, pattern in CLASSES.items())
    # x: 0-based position; ``codes`` 1-based places in the alphabet; counts[code - 1] holds a character's count.
    return f"""
        transform(array(struct(
            c.start AS start,
            transform(filter(split(c.word, ''), s -> s <> ''), s -> instr('{ALPHABET}', s)) AS codes,
            CASE {least} ELSE {THRESHOLD['base64']}D END AS least,
            {gain} AS f)),
          b -> aggregate(
            sequence(0, size(b.codes) - 1),
            struct(array_repeat(0, {alphabet}) AS n, 0.0D AS sum, -1L AS lo, -1L AS hi,
                   CAST(array() AS array<struct<start: bigint, ord: int, stop: bigint, word: string>>) AS done),
            (w, x) -> transform(array(struct(
                    b.codes[x] AS put, if(x >= {WINDOW}, b.codes[x - {WINDOW}], 0) AS cut)),
                io -> transform(array(struct(
                        if(io.put = io.cut, w.n, transform(w.n, (v, i) -> v + if(i + 1 = io.put, 1, 0) - if(i + 1 = io.cut, 1, 0))) AS n,
                        if(io.put = io.cut, w.sum,
                            w.sum + b.f[w.n[io.put - 1] + 1] - b.f[w.n[io.put - 1]]
                            + if(io.cut = 0, 0.0D, b.f[w.n[io.cut - 1] - 1] - b.f[w.n[io.cut - 1]])) AS sum)),
                    s -> if(x >= {WINDOW - 1} AND {total!r}D - s.sum / {WINDOW} >= b.least - 1e-9D,
                        if(w.hi >= x - {WINDOW - 1},
                            struct(s.n AS n, s.sum AS sum, w.lo AS lo, CAST(x + 1 AS bigint) AS hi, w.done AS done),
                            struct(s.n AS n, s.sum AS sum, CAST(x - {WINDOW - 1} AS bigint) AS lo, CAST(x + 1 AS bigint) AS hi,
                                if(w.hi < 0, w.done, concat(w.done, array(struct(
                                    b.start + w.lo AS start, 3 AS ord, b.start + w.hi AS stop, CAST(NULL AS string) AS word)))) AS done)),
                        struct(s.n AS n, s.sum AS sum, w.lo AS lo, w.hi AS hi, w.done AS done)))[0])[0],
            w -> if(w.hi < 0, w.done, concat(w.done, array(struct(
                b.start + w.lo AS start, 3 AS ord, b.start + w.hi AS stop, CAST(NULL AS string) AS word))))))[0]"""


NONE = "CAST(array() AS array<struct<start: bigint, ord: int, stop: bigint, word: string>>)"


def with_spans(docs: DataFrame, text: Column, name: str = "_secrets") -> DataFrame:
    """``docs`` with a column ``name``: ``struct<text, base, added>``, spans by start then kind."""
    low = F.lower("text")
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("apikey") | low.contains("api_key")
    allowed = " OR ".join([*(f"c.word RLIKE {_quoted(p)}" for p in ALLOWED),
                           f"forall(split(c.word, {_quoted(JOINTS)}), p -> p RLIKE {_quoted(PART)})"])
    found = (
        docs.withColumn("text", F.coalesce(text, F.lit("")))
        # a run of 24 hex digits or an access key is a candidate run too, so this one pass guards three patterns
        .withColumn("_runs", F.expr(f"text RLIKE {_quoted(CANDIDATE)}"))
        .withColumn("_named", named)
        .withColumn("_assign", F.expr(f"if(_named, {_found('assign', ASSIGN, f'length(g.) >= {ASSIGN_LEAST}', 2)}, {NONE})"))
        .withColumn("_access", F.expr(f"if(_runs AND contains(text, 'AKIA'), {_found('access', ACCESS)}, {NONE})"))
        .withColumn("_hex", F.expr(f"if(_runs AND text RLIKE {_quoted(HEX)}, {_found('hex', HEX)}, {NONE})"))
        .withColumn("_cand", F.expr(f"if(_runs, filter({_found('entropy', CANDIDATE)}, c -> NOT ({allowed})), {NONE})"))
        .withColumn("_base", F.expr("sort_array(concat(_assign, _access, _hex))"))
        .withColumn("_added", F.expr(f"""
            if(size(_cand) = 0, {NONE},
               filter(flatten(transform(_cand, c -> {_windows()})),
                      a -> NOT exists(_base, b -> a.start < b.stop AND b.start < a.stop)))"""))
    )
    return found.withColumn(name, F.struct("_base", "_added")).drop(
        "_runs", "_named", "_assign", "_access", "_hex", "_cand", "_base", "_added")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added``: every document's base spans and added spans, ``array<struct<start, ord, stop>>`` each.

    ``ord`` is the kind's place in ``KINDS``.
    """
    bare = "transform({}, s -> struct(s.start AS start, s.ord AS ord, s.stop AS stop))"
    return with_spans(id_text(docs), F.col("text")).select(
        "doc_id", F.expr(bare.format("_secrets._base")).alias("base"), F.expr(bare.format("_secrets._added")).alias("added"))


def digests(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans`` of :func:`scan`'s rows."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined = f"array_join(transform({{}}, s -> concat({names}[s.ord], ':', s.start, ':', s.stop)), ',')"
    count = "CAST(size(filter({}, s -> s.ord = {})) AS bigint)"
    return scanned.select(
        "doc_id",
        *[F.expr(count.format("base", i)).alias(f"n_{KINDS[i]}") for i in range(3)],
        F.size("added").cast("long").alias("n_entropy"),
        F.sha2(F.expr(joined.format("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined.format("sort_array(concat(base, added))")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All columns of ``docs``; every span of a secret in ``text`` (overlapping ones as one) becomes ``mask``."""
    cols = docs.columns
    kept = [F.col(c).alias(f"_in_{i}") for i, c in enumerate(cols)]
    found = with_spans(docs.select(*kept, F.col("text").cast("string").alias("text")), F.col("text"))
    merged = """
        aggregate(sort_array(concat(_secrets._base, _secrets._added)),
            struct(0L AS at, CAST(array() AS array<string>) AS out),
            (acc, s) -> if(s.stop <= acc.at, acc, struct(
                s.stop AS at,
                if(s.start < acc.at, acc.out,
                   concat(acc.out, array(substring(text, CAST(acc.at + 1 AS int), CAST(s.start - acc.at AS int)), '{mask}'))) AS out)),
            acc -> concat(array_join(acc.out, ''), substring(text, CAST(acc.at + 1 AS int))))""".replace("{mask}", mask.replace("\\", "\\\\").replace("'", "\\'"))
    at = cols.index("text")
    none = F.expr("size(_secrets._base) + size(_secrets._added) = 0")
    clean = F.when(none, F.col(f"_in_{at}")).otherwise(F.expr(merged))
    return found.select(*[clean.alias(c) if i == at else F.col(f"_in_{i}").alias(c) for i, c in enumerate(cols)])
