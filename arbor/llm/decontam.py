"""Benchmark decontamination by spaced seeds (operator 5).

Texts become terms (case and punctuation don't count). A mask is a fixed pattern
of positions that count and positions that don't; the terms at its counting
positions are hashed, so a substitution at another position does not hide the
passage. Every place of every benchmark item and of every document is hashed
under every mask; test and training hashes are joined, and around each hit the
item is laid along the document: the best stretch (a match counts 1, a
substitution costs 2) is an overlap if it holds enough matching terms.

Documents send only hashes that a fixed-size bit table of the test hashes lets
through; what it lets through by chance falls out in the join. Documents with
hits are read a second time to verify, so no text is shuffled for the rest.

Items under ``SHORT_ITEM`` terms have masks of four counting positions, which
any single substitution that :func:`enough` accepts leaves a hit. An item under
``LEAST_ITEM`` terms says too little inside a text: it overlaps the documents
that consist of it.

Defined cases: null or empty texts have no terms and no overlap; very long texts
are read whole; repeated documents and items each get their rows; ids that are
null take no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, by_ids, map_text, ship
from .hashing import U, _step, mix, words

#: The masks: 1 counts, 0 does not.
MASKS = ("111010011", "110101011", "1011001101", "1100110010011")
#: Matching terms of an overlap (of a shorter item: this share of its terms), and the least share that must match.
LEAST_TERMS, LEAST_SHARE, MATCH_RATE = 12, 0.8, 0.7
LEAST_ITEM = 5
#: Items under so many terms, and their masks.
SHORT_ITEM, SHORT_MASKS = 13, ("1111", "11011")
#: Before a mask: it is the whole text.
WHOLE = "="
#: log2 of the bits of the table of test hashes (a fixed 4 MB).
TABLE_BITS = 25


def seeds(value: np.ndarray, mask: str) -> np.ndarray:
    """Hash at every place of a term array under a mask."""
    places = mask.lstrip(WHOLE)
    n = max(len(value) - len(places) + 1, 0)
    out = np.zeros(n, np.uint64)
    for i, c in enumerate(places):
        if c == "1":
            out += value[i:i + n] * _step(i)
    return mix(out + U(int(places, 2) + (mask[0] == WHOLE) * 2**32))


def masks_for(n: int) -> tuple[str, ...]:
    """The masks of an item of ``n`` terms."""
    if n < LEAST_ITEM:
        return (WHOLE + "1" * n,) if n else ()
    return SHORT_MASKS if n < SHORT_ITEM else MASKS


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, terms, shorts``: an item's term hashes, packed; repeated rows once."""
    def run(batch: pa.RecordBatch) -> dict:
        value, ends, _, _ = words(batch.column("text"), terms=True)
        return {"item_id": batch.column("item_id"),
                "terms": [value[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]}

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_text(rows.where("item_id IS NOT NULL"), "text", run, "item_id long, terms binary").distinct()


def _test_seeds(items: DataFrame) -> DataFrame:
    """``hash, item_id, place, mask`` of every place of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for item, terms in zip(batch.column("item_id").to_pylist(), batch.column("terms").to_pylist()):
                value = np.frombuffer(terms, np.uint64)
                for mask in masks_for(len(value)):
                    h = seeds(value, mask).astype(np.int64)
                    out.append((h, np.full(len(h), item, np.int64), np.arange(len(h), dtype=np.int32), np.array([mask] * len(h), object)))
            if out:
                h, item, place, mask = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(item, pa.int64()), pa.array(place, pa.int32()), pa.array(mask, pa.string())],
                    names=["hash", "item_id", "place", "mask"])

    return items.mapInArrow(run, "hash long, item_id long, place int, mask string")


def _hit_table(tests: DataFrame) -> tuple[np.ndarray, list[str]]:
    """A bit for every test hash (2**TABLE_BITS bits at any input size), and the masks in use."""
    cell = f"pmod(hash, {1 << TABLE_BITS})"
    rows = tests.groupBy(F.expr(f"bitmap_bucket_number({cell} + 1)").alias("at")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({cell} + 1))").alias("bits")).collect()
    table = np.zeros(1 << TABLE_BITS >> 3, np.uint8)
    for r in rows:
        own = np.frombuffer(r["bits"], np.uint8)
        table[(r["at"] - 1) * 4096:(r["at"] - 1) * 4096 + len(own)] = own
    return table, sorted(r["mask"] for r in tests.select("mask").distinct().collect())


def _training_seeds(docs: DataFrame, table: np.ndarray, masks: list[str]) -> DataFrame:
    """``hash, doc_id, at``: places of documents whose hash may be a test hash."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    low = U((1 << TABLE_BITS) - 1)

    def run(batch: pa.RecordBatch) -> dict | None:
        table = shared.value
        value, ends, _, _ = words(batch.column("text"), terms=True)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        found: list[tuple[np.ndarray, ...]] = []
        for mask in masks:
            h = seeds(value, mask)
            cell = h & low
            at = np.flatnonzero(table[cell >> U(3)] >> (cell & U(7)).astype(np.uint8) & np.uint8(1))
            if len(at):
                row = np.searchsorted(ends, at, side="right") - 1
                stop = at + len(mask.lstrip(WHOLE))
                inside = stop <= ends[row + 1]  # a seed does not run into the next document
                if mask[0] == WHOLE:
                    inside = (at == ends[row]) & (stop == ends[row + 1])
                at, row = at[inside], row[inside]
                found.append((h[at].astype(np.int64), ids[row], (at - ends[row]).astype(np.int32)))
        if not found:
            return None
        h, doc, at = map(np.concatenate, zip(*found))
        return {"hash": h, "doc_id": doc, "at": at}

    return map_text(docs, "text", run, "hash long, doc_id long, at int")


def best_stretch(match: np.ndarray) -> tuple[int, int, int]:
    """Start, stop and matches of the stretch with the highest sum (match 1, substitution -2); the first among equals."""
    run = np.concatenate([[0], np.cumsum(np.where(match, 1, -2))])
    low = np.minimum.accumulate(run)
    stop = int((run - low).argmax())
    start = int(np.flatnonzero(run[:stop + 1] == low[stop])[-1])
    return start, stop, int(match[start:stop].sum())


def enough(matches: int, length: int, item: int) -> bool:
    return matches >= min(LEAST_TERMS, int(np.ceil(LEAST_SHARE * item))) and matches >= MATCH_RATE * length


def _verify(joined: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_term, n_terms, n_matched`` of the overlaps along the hits' diagonals."""
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_term", pa.int64()),
                     ("n_terms", pa.int64()), ("n_matched", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, shift, text, terms in zip(*(batch.column(c) for c in ("doc_id", "item_id", "shift", "text_terms", "terms"))):
                text, terms = np.frombuffer(text.as_buffer(), np.uint64), np.frombuffer(terms.as_buffer(), np.uint64)
                shift = shift.as_py()
                a, b = max(0, -shift), min(len(terms), len(text) - shift)
                if a >= b:
                    continue
                start, stop, matches = best_stretch(text[a + shift:b + shift] == terms[a:b])
                if enough(matches, stop - start, len(terms)):
                    rows.append((doc.as_py(), item.as_py(), a + start + shift, stop - start, matches))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=out)

    return joined.select("doc_id", "item_id", "shift", "text_terms", "terms").mapInArrow(
        run, "doc_id long, item_id long, first_term long, n_terms long, n_matched long")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per overlap of a document with a benchmark item: ``doc_id, item_id, first_term, n_terms, n_matched``."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "decontam")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id IS NOT NULL")
    items = scratch.write(_items(benchmark), "items")
    tests = scratch.write(_test_seeds(items), "tests")
    table, masks = _hit_table(tests)
    training = _training_seeds(texts, table, masks)
    hits = scratch.write(
        training.join(tests.select("hash", "item_id", "place"), "hash")
        .select("doc_id", "item_id", (F.col("at") - F.col("place")).alias("shift")).distinct(), "hits")
    ids = scratch.write(hits.select("doc_id").distinct(), "ids")

    def run(batch: pa.RecordBatch) -> dict:
        value, ends, _, _ = words(batch.column("text"), terms=True)
        return {"doc_id": batch.column("doc_id"),
                "text_terms": [value[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]}

    # the ids are a written table, so Spark knows its size and broadcasts it only where it is small
    again = map_text(texts.join(ids, "doc_id", "left_semi"), "text", run, "doc_id long, text_terms binary")
    return _verify(hits.join(items, "item_id").join(again, "doc_id")).distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the documents without overlap (and of those without an id)."""
    found = Scratch(docs.sparkSession, "decontam").write(overlaps(docs, benchmark).select("doc_id").distinct(), "overlapping")
    return by_ids(docs, found, "left_anti")
