"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups its links form.

Two documents link when their sets of word shingles overlap by the threshold.

*Order.* Every task hashes its shingles and sends them, packed, to the owner of
their hash range; owners count documents per shingle exactly and answer with
tables of fixed size: a blocked Bloom filter of the shingles that more than one
document has, and a sketch of how many have them.  Shingles are ordered: first
those no other document has, then by estimated frequency, then by hash.

*Prefixes.* With threshold t a set of n shingles and any partner share at least
ceil(t n); so in the first n - ceil(t n) + l shingles of both, l must be shared.
Each document lengthens its prefix (l = 1, 2, ...) to the least estimated cost:
postings read plus candidates verified, of which a longer prefix leaves fewer.
A pair is verified when it shares as many prefix shingles as the shorter-prefixed
of both asks for.  Shingles without a partner stand in the prefix but have no
postings; a document with fewer than ceil(t n) shared shingles has no link.

*Groups.* Documents with equal sets are one class from the start.  Large groups
of similar classes are contracted before pairs are made: each class is verified
against the leader it shares most prefix shingles with (leaders are the members
with the fewest unshared shingles), some rounds with changing leaders; then only
pairs of different groups are generated, filtered and verified, so that no link
between groups is lost and no group is paired out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep, slices, table, texts
from tidemark.llm.graph import components
from tidemark.llm.shingles import gram_lists, hash_ranges, mix


@dataclass(frozen=True)
class Settings:
    words: int = 4
    #: Threshold in percent: 100 * intersection >= percent * union.
    percent: int = 85
    #: Longest extension of a prefix, and the cost of verifying a candidate in postings read.
    most_matches: int = 8
    verify_cost: float = 16.0
    #: Owners of hash ranges (a power of two) and the sizes of their tables: shared shingles (bits) and frequencies (cells).
    owner_bits: int = 8
    filter_bits: int = 27
    sketch_bits: int = 20
    #: Rounds of comparing classes with leaders before pairs are made.
    rounds: int = 2
    #: Shingles a task holds before it sends them.
    held: int = 1_000_000


def shingle_sets(raw: list[bytes], n: int) -> list[np.ndarray]:
    """Hashed distinct shingles of each text; one for all its words where they are fewer than ``n``."""
    words = [t.lower().split() for t in raw]
    out = []
    for w, g in zip(words, gram_lists(words, n), strict=True):
        if 0 < len(w) < n:
            data = np.frombuffer(b" ".join(w), np.uint8)
            g = hash_ranges(data, np.array([0]), np.array([len(data)]))
        out.append(np.unique(g))
    return out


class Shared:
    """The owners' answers: which shingles are shared, and a rough binary logarithm of by how many."""

    def __init__(self, bits: np.ndarray, levels: np.ndarray, settings: Settings):
        self.bits, self.levels, self.settings = bits, levels, settings

    @staticmethod
    def address(g: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Owner and 32-bit value within the owner's range."""
        owner = g >> np.uint64(64 - settings.owner_bits)
        return owner.astype(np.int64), ((g >> np.uint64(32 - settings.owner_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    @staticmethod
    def cells(value: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m = mix(value.astype(np.uint64))
        width = np.uint64(settings.filter_bits - settings.owner_bits)
        one = np.uint64(1)
        first, second = m & ((one << width) - one), (m >> np.uint64(32)) & ((one << width) - one)
        cell = (m >> np.uint64(20)) & ((one << np.uint64(settings.sketch_bits - settings.owner_bits)) - one)
        return first.astype(np.int64), second.astype(np.int64), cell.astype(np.int64)

    def look(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each shingle is shared, and its level."""
        owner, value = self.address(g, self.settings)
        first, second, cell = self.cells(value, self.settings)
        test = lambda at: (self.bits[owner, at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (test(first) & test(second)).astype(bool), self.levels[owner, cell]


def shared_shingles(docs: DataFrame, settings: Settings) -> Shared:
    """Counts every shingle's documents at its owner; collects tables of fixed size."""

    def send(batches):
        held, size = [], 0
        for b in slices(batches):
            sets = shingle_sets(b["text"].cast(pa.binary()).to_pylist(), settings.words)
            held += sets
            size += sum(map(len, sets))
            if size >= settings.held:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        g, n = np.unique(np.concatenate(held), return_counts=True)
        owner, value = Shared.address(g, settings)
        rows = []
        for k in np.unique(owner):
            at = slice(*np.searchsorted(owner, [k, k + 1]))
            v, c = value[at], n[at]
            rows.append((int(k), v[c == 1].tobytes(), v[c > 1].tobytes(), c[c > 1].astype(np.uint32).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                          ["owner", "once", "more", "times"])

    def answer(t: pa.Table) -> pa.Table:
        read = lambda c: np.frombuffer(b"".join(t[c].to_pylist()), np.uint32)
        once, more, times = read("once"), read("more"), read("times")
        value, which = np.unique(np.concatenate([once, more]), return_inverse=True)
        n = np.bincount(which, np.concatenate([np.ones(len(once)), times]))
        value, n = value[n > 1], n[n > 1]
        first, second, cell = Shared.cells(value, settings)
        bits = np.zeros(1 << (settings.filter_bits - settings.owner_bits), bool)
        bits[first] = bits[second] = True
        levels = np.zeros(1 << (settings.sketch_bits - settings.owner_bits), np.uint8)
        heavy = n >= 8
        np.maximum.at(levels, cell[heavy], np.log2(n[heavy]).astype(np.uint8))
        return pa.table({"owner": pa.array([t["owner"][0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                         "levels": pa.array([levels.tobytes()], pa.binary())})

    sent = texts(docs).select("text").mapInArrow(send, "owner int, once binary, more binary, times binary")
    got = sent.groupBy("owner").applyInArrow(answer, "owner int, bits binary, levels binary").collect()  # one row of fixed size per owner
    owners = 1 << settings.owner_bits
    bits = np.zeros((owners, 1 << (settings.filter_bits - settings.owner_bits - 3)), np.uint8)
    levels = np.zeros((owners, 1 << (settings.sketch_bits - settings.owner_bits)), np.uint8)
    for r in got:
        bits[r["owner"]], levels[r["owner"]] = np.frombuffer(r["bits"], np.uint8), np.frombuffer(r["levels"], np.uint8)
    return Shared(bits, levels, settings)


def prefix(level: np.ndarray, n: int, settings: Settings) -> tuple[int, int]:
    """Matches to ask for and postings to make; ``level`` of the shared shingles in order, ``n`` of all."""
    least = (settings.percent * n + 99) // 100
    short = n - least - (n - len(level))  # shared shingles in a prefix of 0 matches
    read = np.cumsum(np.exp2(np.maximum(level, 1).astype(float)))
    best = None
    for k in range(1, min(settings.most_matches, least) + 1):
        size = min(len(level), short + k)
        cost = read[size - 1] * (1 + settings.verify_cost / k)
        if best is None or cost < best[0]:
            best = (cost, k, size)
    return best[1], best[2]


SCHEMA = "doc_id long, n long, sig long, spare long, matches int, prefix array<long>, shingles array<long>"


def sketched(docs: DataFrame, shared: Shared, settings: Settings) -> DataFrame:
    """Every document: size and identity of its set; of those that may link also what they need for it."""
    sent = docs.sparkSession.sparkContext.broadcast((shared.bits, shared.levels))

    def run(batches):
        look = Shared(*sent.value, settings).look
        for b in slices(batches):
            rows = []
            sets = shingle_sets(b["text"].cast(pa.binary()).to_pylist(), settings.words)
            known, level = look(np.concatenate(sets))
            at = 0
            for doc, g in zip(b["doc_id"].to_pylist(), sets, strict=True):
                n, here = len(g), known[at : at + len(g)]
                sig = int(np.uint64(xxhash.xxh3_64_intdigest(g.tobytes())).view(np.int64))
                if n == 0 or int(here.sum()) * 100 < settings.percent * n:
                    rows.append((doc, n, sig, None, None, None, None))
                else:
                    own, lev = g[here], level[at : at + n][here]
                    order = np.lexsort((mix(own), lev))
                    matches, size = prefix(lev[order], n, settings)
                    rows.append((doc, n, sig, n - len(own), matches, own[order[:size]].view(np.int64), g.view(np.int64)))
                at += n
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             [f.split()[0] for f in SCHEMA.split(", ")])

    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def _overlap_for(x: str, y: str, settings: Settings) -> Column:
    """The least intersection that links sets of these sizes."""
    p = settings.percent
    return F.ceil((F.col(x) + F.col(y)) * F.lit(p) / F.lit(100 + p))


def _verified(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a, b`` of classes whose sets overlap enough."""
    sets = classes.select("sig", "n", "shingles")
    both = (pairs.join(sets.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("y")), "b"))
    same = F.size(F.array_intersect("x", "y"))
    return both.filter(same * (100 + settings.percent) >= (F.col("na") + F.col("nb")) * settings.percent).select("a", "b")


def links(classes: DataFrame, settings: Settings) -> DataFrame:
    """``id, root``: groups of linked classes (``sig, n, spare, matches, prefix, shingles``)."""
    postings = classes.select("sig", "n", "spare", "matches", F.explode("prefix").alias("token"))
    token = Window.partitionBy("token")
    # A class can link with sets up to a size that its shared shingles allow; postings without such a one go.
    largest = F.floor((F.col("n") - F.col("spare")) * F.lit(100 + settings.percent) / F.lit(settings.percent)) - F.col("n")
    postings = keep(postings.withColumn("largest", largest).withColumn("size", F.count("*").over(token)).withColumn("least", F.min("n").over(token))
                    .filter("size > 1 and largest >= least").drop("size", "least"))
    found = classes.sparkSession.createDataFrame([], "a long, b long")
    roots = classes.sparkSession.createDataFrame([], "id long, root long")
    for k in range(settings.rounds):
        here = postings.join(roots, F.col("sig") == F.col("id"), "left").withColumn("root", F.coalesce("root", "sig")).drop("id")
        lead = F.min(F.struct("spare", F.xxhash64("sig", F.lit(k)).alias("turn"), "sig", "root", "n")).over(token)
        led = here.withColumn("lead", lead).filter("root != lead.root")
        led = led.filter((F.col("lead.n") <= F.col("largest")) & (F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * settings.percent))
        votes = led.groupBy("sig", F.col("lead.sig").alias("lead")).count()
        best = votes.groupBy("sig").agg(F.max(F.struct("count", "lead")).alias("m"))
        new = _verified(best.select(F.col("m.lead").alias("a"), F.col("sig").alias("b")), classes, settings)
        new = keep(new)
        if k and not new.take(1):
            break
        found = keep(found.union(new))
        roots = keep(components(found))
    here = postings.join(roots, F.col("sig") == F.col("id"), "left").withColumn("root", F.coalesce("root", "sig")).drop("id")
    mixed = here.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("token")
    here = here.join(mixed, "token").join(classes.select("sig", "prefix"), "sig")
    side = lambda s: here.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("sig", "n", "spare", "matches", "root", "prefix")])
    enough = _overlap_for("x_n", "y_n", settings)
    same = F.array_intersect("x_prefix", "y_prefix")
    # Shared shingles that are in neither prefix: all of one side's that follow its prefix, at most.
    rest = F.greatest(*[F.col(f"{s}_n") - F.col(f"{s}_spare") - F.size(f"{s}_prefix") for s in "xy"])
    pairs = side("x").join(side("y"), "token").filter(
        (F.col("x_sig") < F.col("y_sig")) & (F.col("x_root") != F.col("y_root"))
        & (F.col("x_n") - F.col("x_spare") >= enough) & (F.col("y_n") - F.col("y_spare") >= enough) & (F.least("x_n", "y_n") >= enough)
        & (F.size(same) >= F.least("x_matches", "y_matches")) & (F.size(same) + rest >= enough)
        & (F.array_min(same) == F.col("token")))  # a pair comes from one of its tokens only
    pairs = pairs.select(F.col("x_sig").alias("a"), F.col("y_sig").alias("b"))
    return components(found.union(_verified(pairs, classes, settings)))


def jaccard_groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (smallest id reachable by links).

    A null text counts as empty; a text without words has an empty set, links
    with nothing and is a group of its own; fewer words than a shingle make one
    shingle; rows that repeat an id keep a row each and link by their sets; an
    empty table gives no rows; texts are read whole; other columns are ignored.
    """
    shared = shared_shingles(docs, settings)
    every = sketched(docs, shared, settings)
    del shared  # the tasks have it
    every = keep(every)
    some = every.filter("prefix is not null")
    classes = keep(some.groupBy("sig", "n").agg(*[F.first(c).alias(c) for c in ("spare", "matches", "prefix", "shingles")]))
    roots = keep(links(classes, settings))
    placed = every.select("doc_id", "n", "sig").join(roots, F.col("sig") == F.col("id"), "left")
    # Sets without words share an identity but no link.
    placed = placed.select("doc_id", "n", F.coalesce("root", F.when(F.col("n") > 0, F.col("sig"))).alias("root"))
    least = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("members"))
    out = placed.join(least, "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, settings: Settings = Settings(), small: int = 1_000_000) -> DataFrame:
    """The documents with their columns, one of each group: the one with the smallest id.

    Rows without an id stay; of rows that repeat an id and a text one stays.
    """
    groups = keep(jaccard_groups(docs, settings))
    gone = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    few = lambda x: F.broadcast(x) if x.limit(small + 1).count() <= small else x
    left = docs.join(few(gone), docs["doc_id"] == F.col("__gone"), "left_anti")
    again = groups.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select(F.col("doc_id").alias("__again"))
    if not again.take(1):
        return left
    twice = left.join(few(again), left["doc_id"] == F.col("__again"), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(few(again), left["doc_id"] == F.col("__again"), "left_anti").unionByName(twice)


def op8_ngram_jaccard(spark, sf_dir) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))
