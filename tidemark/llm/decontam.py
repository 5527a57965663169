"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny share of the document's
shingles, so signatures of whole documents can't find it.  Items are therefore
partitioned by size (shingles, doubling classes), and for each class a document
is read in windows twice as wide as the class's largest item, one item's width
apart: an item lies whole in some window, and makes up enough of it for MinHash
bands tuned to the class.  Candidates (equal band, same class) are verified by
exact containment of the item's shingles in the document.

Two prunings lose nothing: a band can only match where the window's least
shingle is one of some item's, so only windows with such shingles are signed and
only such bands leave a task.  Which shingles those are is told to the tasks by
a bitmap of fixed size, whatever the number of items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, map_rows, slices, table, texts
from tidemark.llm.license import _FOLD
from tidemark.llm.shingles import gram_lists, mix

SEEDS = np.uint64(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Settings:
    words: int = 5
    #: Share of an item's shingles that a document must hold.
    containment: float = 0.8
    #: Bands of one MinHash each: windows are at most twice the class's largest item and four times its smallest, so an item
    #: with the share above has a Jaccard similarity of 0.19 or more with its window, and goes unseen with a probability below 2e-6.
    bands: int = 64
    smallest_class: int = 1
    bitmap_bits: int = 24
    #: Item bands (documents) up to which they are sent to every task instead of being joined by a shuffle.
    small_items: int = 1_000_000
    small_docs: int = 1_000_000


def _words(texts_: list[bytes]) -> list[list[bytes]]:
    """Words of letters and digits, A-Z in lower case: punctuation and case can't hide an item."""
    return [t.translate(_FOLD).split() for t in texts_]


def _bands(g: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The least hash and the shingle that has it, for each of ``n`` hash functions."""
    with np.errstate(over="ignore"):
        seeds = SEEDS * np.arange(1, n + 1, dtype=np.uint64)
    values = mix(g[:, None] ^ seeds[None, :])
    least = values.argmin(axis=0)
    return values[least, np.arange(n)].view(np.int64), g[least]


def _class_of(n: int, smallest: int) -> int:
    return max(smallest, 1 << (n - 1).bit_length())


def items_of(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """``item_id, n, size_class, shingles, bands``; items of fewer words than a shingle have none and take no part."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, g in zip(b["doc_id"].to_pylist(), gram_lists(_words(b["text"].cast(pa.binary()).to_pylist()), settings.words), strict=True):
            if len(g):
                g = np.unique(g)
                rows.append((i, len(g), _class_of(len(g), settings.smallest_class), g.view(np.int64), _bands(g, settings.bands)[0]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["item_id", "n", "size_class", "shingles", "bands"])

    return map_rows(texts(benchmark, "item_id").withColumn("doc_id", F.col("doc_id").cast("long")), run,
                    "item_id long, n long, size_class long, shingles array<long>, bands array<long>")


def marked_documents(docs: DataFrame, items: DataFrame, settings: Settings) -> DataFrame:
    """Documents with any item's shingle: ``doc_id, hits`` (those shingles) and ``bands`` (class, number, value)."""
    size = 1 << settings.bitmap_bits
    bits = np.zeros(size, bool)  # at most this many distinct numbers come back, however many items there are
    bits[items.select(F.explode("shingles").alias("s")).select(F.col("s").bitwiseAND(size - 1).alias("b")).distinct().toArrow()["b"].to_numpy()] = True
    classes = sorted(items.select("size_class").distinct().toArrow()["size_class"].to_pylist())  # doubling: a few dozen
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        known = np.unpackbits(sent.value).view(bool)
        kind = pa.list_(pa.struct([("size_class", pa.int64()), ("band", pa.int32()), ("value", pa.int64())]))
        for b in slices(batches):
            rows = []
            for i, g in zip(b["doc_id"].to_pylist(), gram_lists(_words(b["text"].cast(pa.binary()).to_pylist()), settings.words), strict=True):
                at = np.flatnonzero(known[g & np.uint64(size - 1)])
                if len(at) == 0:
                    continue
                bands = set()
                for u in classes:
                    windows = np.unique(np.r_[at // u, at // u - 1])
                    for k in windows[windows >= 0] if len(g) > u else [0]:
                        value, least = _bands(g[k * u : (k + 2) * u], settings.bands)
                        for band in np.flatnonzero(known[least & np.uint64(size - 1)]):
                            bands.add((u, int(band), int(value[band])))
                rows.append((i, np.unique(g[at]).view(np.int64), [dict(zip(("size_class", "band", "value"), x, strict=True)) for x in sorted(bands)]))
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.list_(pa.int64()), kind), strict=True)],
                                             ["doc_id", "hits", "bands"])

    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, hits array<long>, bands array<struct<size_class: long, band: int, value: long>>")


def _if_few(rows: DataFrame, most: int) -> DataFrame:
    """Sent to every task if counted to be few, else left to a shuffle join; the same rows either way."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pairs of document and item it holds: ``doc_id, item_id, n_shingles, n_shared, containment``.

    Null texts count as empty and hold nothing; items with fewer words than a
    shingle are left out; rows that share an id count as one document (any of
    its rows may hold the item; the best counts); empty tables give no pairs;
    texts of any length are read whole; other columns are ignored.
    """
    items = keep(items_of(benchmark, settings))
    marked = keep(marked_documents(docs, items, settings))
    bands = items.select("item_id", "size_class", F.posexplode("bands").alias("band", "value"))
    found = (
        marked.select("doc_id", F.explode("bands").alias("b")).select("doc_id", "b.*")
        .join(_if_few(bands, settings.small_items), ["size_class", "band", "value"])
        .select("doc_id", "item_id").distinct()
    )
    sets = items.select("item_id", F.col("n").alias("n_shingles"), "shingles")
    return (
        found.join(marked.select("doc_id", "hits"), "doc_id").join(_if_few(sets, settings.small_items // settings.bands), "item_id")
        .withColumn("n_shared", F.size(F.array_intersect("hits", "shingles")).cast("long"))
        .groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .filter(F.col("containment") >= settings.containment)
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no item, with the columns they came with (rows without an id stay)."""
    gone = keep(contaminated(docs, benchmark, settings).select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(_if_few(gone, settings.small_docs), docs["doc_id"] == gone["__gone"], "left_anti")


def op4_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Words are folded as above; an item's distinct 5-word shingles are looked up in each document's.
ORACLE = """
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), grams AS (
  SELECT DISTINCT side, id, array_to_string(w[k:k+4], ' ') AS g
  FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS k FROM words WHERE len(w) >= 5)
), sizes AS (SELECT id, count(*) AS n FROM grams WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(s.n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(s.n) AS containment
FROM grams d JOIN grams i ON d.g = i.g AND d.side = 'd' AND i.side = 'i' JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(s.n)
"""
