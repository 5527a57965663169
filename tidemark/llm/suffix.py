"""Exact removal of repeated strings by merging Burrows-Wheeler transforms.

Every string of ``length`` bytes holds an anchor: its leftmost 64-byte gram with
the smallest hash.  Equal strings hold equal anchors at the same place, so all
that decides whether a string is repeated is the text around its anchor.  Texts
are therefore cut into segments (the strings that share an anchor's place), and
a transform is built of the suffixes that begin at anchors -- a sparse
Burrows-Wheeler transform, whose last column is the text before the anchor, read
backwards.  Strings whose anchors all occur once are left out beforehand.

*Shards and merge.*  The segments of an anchor's bucket are dealt into shards;
each shard sorts its own suffixes.  Shards are merged by iterative refinement of
their interleave: at first all rows are one block; in each round the next letter
(eight bytes) splits every block, and because a shard's rows are sorted, a round
only merges runs of letters -- no suffix is sorted again.  The round in which two
neighbours part gives their common prefix.  The text before the anchors is
merged the same way.

*Repeated intervals.*  The string that starts d bytes before an anchor is
repeated if another row agrees with it in ``length - d`` bytes from the anchor on
and in d bytes before it; both are blocks of rows cut from the common prefixes.

Segments with equal bytes are one row with a count, added up by each task before
they are sent.  Copies of whole texts are found first by their hash: all of each
copy is repeated, and one of them stands for all against other texts.  An anchor
that occurs ``heavy`` times or more is not merged in one bucket: its segments are
dealt out by their bytes, and its strings added up by the string.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, keep, map_rows, slices, small_batches, table
from tidemark.llm.owners import Ranges, frequent
from tidemark.llm.shingles import _powers, mix


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 64
    ranges: Ranges = Ranges()
    #: Bytes worked on at once in a task (a longer text is worked on in overlapping parts).
    block: int = 1_000_000
    #: Rows of a shard, buckets for each partition of the input, occurrences of an anchor from which it has no bucket of its own.
    shard: int = 4096
    buckets: int = 16
    heavy: int = 32_768
    #: Segments a task adds up before it sends them.
    held: int = 100_000
    #: Documents (ids) up to which a list of them is sent to every task instead of being joined by a shuffle.
    small: int = 500_000


# -- anchors -------------------------------------------------------------------
def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m, s = x, 1
    while 2 * s <= width:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    rest = width - s
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(data: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: all string starts, each one's anchor, and the grams' hashes."""
    k, n = settings.gram, len(data)
    if n < settings.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _powers(1 << max(20, n.bit_length()))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        grams = mix((total[k:] - total[:-k]) * down[: n - k + 1])
    place = np.uint64((1 << 24) - 1)  # a block is shorter than 2**24 bytes
    least = _sliding_min((grams & ~place) | np.arange(len(grams), dtype=np.uint64), settings.length - k + 1)
    begins = np.r_[0, ends[:-1]]
    edge = np.zeros(n + 1, np.int64)
    long = ends - begins >= settings.length
    np.add.at(edge, begins[long], 1)
    np.add.at(edge, ends[long] - settings.length + 1, -1)
    starts = np.flatnonzero(np.cumsum(edge)[: len(least)] > 0)
    return starts, (least[starts] & place).astype(np.int64), grams


def blocks(docs: list[tuple[int, int, bytes]], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """Texts laid end to end in bounded blocks: bytes, ends, and (id, hash, offset) of each; long texts in overlapping parts."""
    held, names, size = [], [], 0
    for i, h, t in docs:
        step = settings.block - settings.length + 1
        for at in range(0, max(1, len(t) - settings.length + 1), step):
            part = t[at : at + settings.block]
            if size + len(part) > settings.block and held:
                yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), names
                held, names, size = [], [], 0
            held.append(part)
            names.append((i, h, at))
            size += len(part)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), names


def _runs(starts: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of neighbouring starts with one anchor."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(anchor) != 0))
    return np.r_[0, cut + 1], np.r_[cut, len(starts) - 1]


def _anchor_hashes(batches, settings: Settings) -> Iterator[np.ndarray]:
    for b in slices(batches, SLICE_ROWS):
        docs = zip(b["doc_id"].to_pylist(), b["h"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), strict=True)
        for data, ends, _ in blocks(list(docs), settings):
            starts, anchor, grams = anchors(data, ends, settings)
            first, _ = _runs(starts, anchor)
            yield grams[anchor[first]]


def _segments(batches, filters: list[np.ndarray], settings: Settings) -> Iterator[tuple]:
    """Segments whose strings may be repeated: document, start in it, anchor, its offset, whether it is heavy, bytes."""
    for b in slices(batches, SLICE_ROWS):
        docs = zip(b["doc_id"].to_pylist(), b["h"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), strict=True)
        for data, ends, names in blocks(list(docs), settings):
            starts, anchor, grams = anchors(data, ends, settings)
            first, last = _runs(starts, anchor)
            often = settings.ranges.often(filters[0], grams[anchor[first]])
            first, last = first[often], last[often]
            gram = grams[anchor[first]]
            heavy = settings.ranges.often(filters[1], gram).tolist()
            owner = np.searchsorted(ends, starts[first], side="right").tolist()
            begin = np.r_[0, ends[:-1]].tolist()
            whole = data.tobytes()
            for a, s, e, p, o, hot in zip(gram.view(np.int64).tolist(), starts[first].tolist(), starts[last].tolist(), anchor[first].tolist(), owner, heavy, strict=True):
                i, h, at = names[o]
                yield i, h, s - begin[o] + at, a, p - s, hot, whole[s : e + settings.length]


def _name(raw: bytes, off: int) -> int:
    return xxhash.xxh3_64_intdigest(raw, off) - (1 << 63)


KINDS = "bucket long, anchor long, seg long, off int, heavy boolean, n long, bytes binary"
PLACES = "anchor long, seg long, doc_id long, h long, start long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def _kinds(batches, filters: list[np.ndarray], buckets: int, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Different segments and how often a task has seen each; heavy anchors' are dealt out by their bytes."""
    seen: dict[tuple[int, int], list] = {}

    def rows():
        return _batch([((k[1] if v[1] else k[0]) % buckets, *k, *v) for k, v in seen.items()], KINDS)

    for _, _, _, a, off, hot, raw in _segments(batches, filters, settings):
        known = seen.setdefault((a, _name(raw, off)), [off, hot, 0, raw])
        known[2] += 1
        if len(seen) >= settings.held:
            yield rows()
            seen.clear()
    if seen:
        yield rows()


def _places(batches, filters: list[np.ndarray], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Where every segment stands."""
    rows = []
    for i, h, start, a, off, _, raw in _segments(batches, filters, settings):
        rows.append((a, _name(raw, off), i, h, start))
        if len(rows) >= 20_000:
            yield _batch(rows, PLACES)
            rows = []
    if rows:
        yield _batch(rows, PLACES)


# -- transforms and their merge -------------------------------------------------
@dataclass
class Transform:
    """Rows in suffix order: who they are, their letters, and the common prefix (bytes) with the row before."""

    rows: np.ndarray
    letters: np.ndarray
    common: np.ndarray


def _same_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading bytes that big-endian letters have in common."""
    d = x ^ y
    out = np.zeros(len(d), np.int64)
    for k in range(8):
        out += (d >> np.uint64(8 * (7 - k))) == 0
    return out


def build(rows: np.ndarray, letters: np.ndarray) -> Transform:
    """A shard's own transform: its suffixes sorted, with common prefixes of neighbours."""
    order = np.lexsort(letters.T[::-1])
    rows, letters = rows[order], letters[order]
    common, same = np.zeros(len(rows), np.int64), np.ones(max(len(rows) - 1, 0), bool)
    for h in range(letters.shape[1]):
        got = _same_bytes(letters[:-1, h], letters[1:, h])
        common[1:] += np.where(same, got, 0)
        same &= got == 8
    return Transform(rows, letters, common)


def merge(x: Transform, y: Transform) -> Transform:
    """Two transforms merged by refining their interleave round by round.

    ``bx`` and ``by`` hold the block of every row in the merged order so far.  A
    round ranks (block, next letter); both sides are sorted runs, so ranks come
    from merging the runs' distinct keys.  Rows alone in their block are settled.
    """
    nx, ny = len(x.rows), len(y.rows)
    bx, by = np.zeros(nx, np.int64), np.zeros(ny, np.int64)
    for h in range(x.letters.shape[1]):
        shared = np.intersect1d(bx, by)
        if not len(shared):
            break  # every block belongs to one side, whose own order holds
        lx, ly = x.letters[:, h], y.letters[:, h]
        letter = np.unique(np.concatenate([lx[_steps(bx, lx)], ly[_steps(by, ly)]]))
        kx, ky = bx * len(letter) + np.searchsorted(letter, lx), by * len(letter) + np.searchsorted(letter, ly)
        ux, uy = kx[_steps(kx)], ky[_steps(ky)]
        key = np.concatenate([ux, uy[~np.isin(uy, ux, assume_unique=True)]])
        key.sort(kind="stable")
        bx, by = np.searchsorted(key, kx), np.searchsorted(key, ky)
    at_x = np.arange(nx) + np.searchsorted(by, bx, side="left")
    at_y = np.arange(ny) + np.searchsorted(bx, by, side="right")
    rows = np.empty(nx + ny, np.int64)
    letters = np.empty((nx + ny, x.letters.shape[1]), np.uint64)
    rows[at_x], rows[at_y] = x.rows, y.rows
    letters[at_x], letters[at_y] = x.letters, y.letters
    # Neighbours from one side keep their common prefix or get it from between; where sides meet it is read off the letters.
    common = np.zeros(nx + ny, np.int64)
    common[at_x], common[at_y] = x.common, y.common
    side = np.zeros(nx + ny, bool)
    side[at_y] = True
    meet = np.flatnonzero(side[1:] != side[:-1]) + 1
    got, same = np.zeros(len(meet), np.int64), np.ones(len(meet), bool)
    for h in range(letters.shape[1]):
        if not same.any():
            break
        n = _same_bytes(letters[meet - 1, h], letters[meet, h])
        got += np.where(same, n, 0)
        same &= n == 8
    common[meet] = got
    return Transform(rows, letters, common)


def _steps(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def merge_all(letters: np.ndarray, shard: int) -> Transform:
    """Transforms of shards of the rows, merged in pairs."""
    level = [build(np.arange(i, min(i + shard, len(letters))), letters[i : i + shard]) for i in range(0, len(letters), shard)]
    while len(level) > 1:
        level = [merge(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _letters(parts: list[bytes], width: int) -> np.ndarray:
    """Eight bytes a letter, padded with zeros."""
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), ">u8").astype(np.uint64).reshape(len(parts), -1)


def repeated_strings(anchor: list[int], raw: list[bytes], off: list[int], settings: Settings) -> list[np.ndarray]:
    """Of different segments: which of their strings another segment has too."""
    n, length = len(raw), settings.length
    off_ = np.array(off)
    low = off_ - np.array([len(r) - length for r in raw])  # least d: the last string's distance to the anchor
    group = np.array(anchor, np.int64).view(np.uint64)[:, None]
    right = merge_all(np.hstack([group, _letters([r[o : o + length] for r, o in zip(raw, off, strict=True)], length)]), settings.shard)
    most = length - settings.gram
    left = merge_all(np.hstack([group, _letters([r[:o][::-1] for r, o in zip(raw, off, strict=True)], max(most, 1))]), settings.shard)
    out = [np.zeros(len(r) - length + 1, bool) for r in raw]
    for d in range(int(low.min(initial=0)), int(off_.max(initial=-1)) + 1):
        able = (low <= d) & (d <= off_)
        if able.sum() < 2:
            continue
        block = np.empty((2, n), np.int64)
        # Letters begin with the anchor's hash, hence the 8.
        block[0, right.rows] = np.cumsum(right.common < 8 + length - d)
        block[1, left.rows] = np.cumsum(left.common < 8 + d)
        who = np.flatnonzero(able)
        _, which, count = np.unique(block[0, who] * (n + 2) + block[1, who], return_inverse=True, return_counts=True)
        for i in who[count[which] > 1]:
            out[i][off[i] - d] = True
    return out


def _covers(mask: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Bytes that the marked strings cover, as ranges from the segment's start."""
    return _ranges(np.flatnonzero(mask), length)


def _ranges(at: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Bytes that strings of ``length`` beginning at the sorted places cover."""
    if not len(at):
        return [], []
    cut = np.flatnonzero(np.diff(at) > length)
    return at[np.r_[0, cut + 1]].tolist(), (at[np.r_[cut, len(at) - 1]] + length).tolist()


# -- the job ---------------------------------------------------------------------
FOUND = "anchor long, seg long, lo array<long>, hi array<long>, bytes binary"


def _merged(kinds: DataFrame, settings: Settings) -> DataFrame:
    """Repeated parts of segments, bucket by bucket; heavy anchors' segments come back with their bytes."""
    length = settings.length

    def run(t: pa.Table) -> pa.Table:
        kinds: dict[tuple[int, int], list] = {}
        for a, seg, off, heavy, n, raw in zip(*(t[c].to_pylist() for c in ("anchor", "seg", "off", "heavy", "n", "bytes")), strict=True):
            kinds.setdefault((a, seg), [off, heavy, raw, 0])[3] += n
        several: dict[int, int] = {}
        for (a, _), (_, heavy, _, _) in kinds.items():
            if not heavy:
                several[a] = several.get(a, 0) + 1
        some = [(k, v) for k, v in kinds.items() if several.get(k[0], 0) > 1]
        masks = {}
        if some:
            found = repeated_strings([k[0] for k, _ in some], [v[2] for _, v in some], [v[0] for _, v in some], settings)
            masks = {k: m for (k, _), m in zip(some, found, strict=True)}
        out = []
        for k, (_, heavy, raw, n) in kinds.items():
            if n > 1:
                out.append((*k, [0], [len(raw)], raw if heavy else None))
            elif heavy:
                out.append((*k, None, None, raw))
            elif k in masks and masks[k].any():
                out.append((*k, *_covers(masks[k], length), None))
        many = pa.list_(pa.int64())
        fields = (("anchor", pa.int64()), ("seg", pa.int64()), ("lo", many), ("hi", many), ("bytes", pa.binary()))
        return pa.table({f: pa.array([r[i] for r in out], k) for i, (f, k) in enumerate(fields)})

    return kinds.groupBy("bucket").applyInArrow(run, FOUND)


def _split(heavy: DataFrame, settings: Settings) -> DataFrame:
    """Heavy anchors' segments string by string: equal strings are added up by their 128-bit hash."""

    def run(batches):
        for b in slices(batches, 2048):
            rows = [(a, s, at, xxhash.xxh3_128_digest(r[at : at + settings.length]))
                    for a, s, r in zip(b["anchor"].to_pylist(), b["seg"].to_pylist(), b["bytes"].to_pylist(), strict=True) for at in range(len(r) - settings.length + 1)]
            if rows:
                yield _batch(rows, STRINGS)

    strings = heavy.select("anchor", "seg", "bytes").mapInArrow(run, STRINGS)
    often = strings.groupBy("string").count().filter("count > 1").select("string")
    each = strings.join(often, "string").groupBy("anchor", "seg").agg(F.collect_list("at").alias("at"))  # one segment's strings

    def cover(b: pa.RecordBatch) -> pa.RecordBatch:
        # Ranges, not strings: a segment's places each get one row for every range.
        many, ranges = pa.list_(pa.int64()), [_ranges(np.sort(np.array(x, np.int64)), settings.length) for x in b["at"].to_pylist()]
        return pa.RecordBatch.from_arrays([b["anchor"], b["seg"], *(pa.array([r[k] for r in ranges], many) for k in (0, 1))], ["anchor", "seg", "lo", "hi"])

    return map_rows(each, cover, "anchor long, seg long, lo array<long>, hi array<long>")


STRINGS = "anchor long, seg long, at long, string binary"


def _if_few(rows: DataFrame, most: int) -> DataFrame:
    """Sent to every task if counted to be few, else left to a shuffle join; the same rows either way."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def repeated_ranges(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, h, lo, hi``: repeated bytes of documents that have any, as sorted ranges apart from each other (``h`` is the text's hash)."""
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    names = rows.select("doc_id", "h", F.hash("text").alias("h2"), F.octet_length("text").cast("long").alias("n")).filter(F.col("n") >= settings.length)
    same = names.groupBy("h", "h2", "n").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first")).filter("copies > 1")
    copies = keep(names.join(same, ["h", "h2", "n"]).select("doc_id", "h", "n", "first").distinct())
    others = copies.filter(~F.col("doc_id").eqNullSafe(F.col("first"))).select(F.struct(F.coalesce("doc_id", F.lit(-1).cast("long")).alias("d"), "h").alias("__skip"))
    once = rows.filter(F.octet_length("text") >= settings.length)
    once = once.withColumn("__key", F.struct(F.coalesce("doc_id", F.lit(-1).cast("long")).alias("d"), "h"))
    others = keep(others)
    once = once.join(_if_few(others, settings.small), F.col("__key") == F.col("__skip"), "left_anti").select("doc_id", "h", "text")
    filters = frequent(once, lambda batches: _anchor_hashes(batches, settings), (2, settings.heavy), settings.ranges)
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # of fixed size
    buckets = max(64, settings.buckets * docs.select("text").rdd.getNumPartitions())
    # Segments are cut twice, for their bytes and for their places: cheaper than to keep the bytes of all places.
    kinds = once.mapInArrow(lambda batches: _kinds(batches, sent.value, buckets, settings), KINDS)
    found = keep(_merged(kinds, settings))
    heavy = found.filter("bytes is not null")
    ranges = found.filter("lo is not null").select("anchor", "seg", "lo", "hi").unionByName(_split(heavy, settings))
    places = once.mapInArrow(lambda batches: _places(batches, sent.value, settings), PLACES)
    spans = places.join(ranges, ["anchor", "seg"]).select("doc_id", "h", F.explode(F.arrays_zip("lo", "hi")).alias("r"), "start")
    spans = spans.select("doc_id", "h", (F.col("start") + F.col("r.lo")).alias("lo"), (F.col("start") + F.col("r.hi")).alias("hi"))
    copied = copies.select("doc_id", "h", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"))
    spans = spans.unionByName(copied).groupBy("doc_id", "h").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # one document's

    def join(b: pa.RecordBatch) -> pa.RecordBatch:
        many, joined = pa.list_(pa.int64()), [_joined(zip(*x, strict=True)) for x in zip(b["lo"].to_pylist(), b["hi"].to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([b["doc_id"], b["h"], *(pa.array([r[k] for r in joined], many) for k in (0, 1))], ["doc_id", "h", "lo", "hi"])

    return map_rows(spans.select("doc_id", "h", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi")), join, "doc_id long, h long, lo array<long>, hi array<long>")


def _joined(ranges) -> tuple[list[int], list[int]]:
    """Ranges that touch or overlap made one."""
    lo, hi = [], []
    for x, y in sorted(ranges):
        if hi and x <= hi[-1]:
            hi[-1] = max(hi[-1], y)
        else:
            lo.append(x)
            hi.append(y)
    return lo, hi


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), with_bytes: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the bytes, if asked).

    Texts are judged as UTF-8 bytes, as they came.  A null text is empty; texts
    shorter than ``length`` have nothing to remove; rows that repeat a text --
    with whatever ids -- are copies of each other, of which none stays; an empty
    table gives no rows; long texts are read whole; other columns are ignored.
    """
    gone = keep(repeated_ranges(docs, settings))
    few = gone.limit(settings.small + 1).count() <= settings.small
    gone = gone.select(F.struct(F.coalesce("doc_id", F.lit(-1).cast("long")).alias("d"), "h").alias("__at"), "lo", "hi")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("__key", F.struct(F.coalesce("doc_id", F.lit(-1).cast("long")).alias("d"), F.xxhash64("text").alias("h")))
    rows = rows.join(F.broadcast(gone) if few else gone, F.col("__key") == F.col("__at"), "left")
    rows = rows.select("doc_id", "text", "lo", "hi")

    def run(batches):
        for b in slices(batches, SLICE_ROWS):
            out = []
            for i, raw, lo, hi in zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), b["lo"].to_pylist(), b["hi"].to_pylist(), strict=True):
                left = b"".join(raw[x:y] for x, y in zip([0, *(hi or ())], [*(lo or ()), len(raw)], strict=True))
                out.append((i, len(raw), len(raw) - len(left), len(lo or ()), sha256(left).hexdigest(), left if with_bytes else None))
            cols = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_bytes else out.drop("kept")


def op10_suffix_dedup(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
