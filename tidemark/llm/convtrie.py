"""Conversation prefix trie by fixed-length block hashing.

A node of the trie is a distinct sequence of first turns.  Conversations are not
walked turn by turn from the root:

1. *Blocks.*  Each conversation is cut into blocks of ``block`` turns.  A turn's
   digest holds its place, so a block's digest is the exclusive or of its turns'
   and the digest of everything before it the exclusive or of the blocks before
   (a prefix scan, so one very long conversation is many tasks).
2. *Groups.*  Conversations are grouped by (digest before, digest of the block):
   one row for each distinct block in its place, whoever has it.
3. *Refinement.*  Only where siblings diverge, that is, where several distinct
   blocks follow the same beginning, are turn boundaries looked at: those blocks'
   turns are grouped by their running digests.  A block without siblings has the
   same members at each of its turns and is unrolled without any grouping.
4. *Subtrees.*  A node of one conversation has one leaf below and saves nothing.
   Sums over subtrees are needed for shared nodes only; they double the distance
   they look down with each round, so a shared beginning of d turns takes log2(d).

Texts stay where they are: turns are shuffled as two 64-bit hashes and a length,
and two digests of 64 bits each tell sequences apart.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, table
from tidemark.operators.prefix import running


@dataclass(frozen=True)
class Settings:
    #: Turns of a block.
    block: int = 8
    #: Ways in which rows of one key are dealt out where they meet that key's one row.
    salts: int = 32
    #: Turns of one conversation that meet its row of rebuilding numbers in one task.
    stretch: int = 1 << 16


def _hash(salt: int, *cols) -> Column:
    return F.xxhash64(F.lit(salt), *cols)


def _salted(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, salts: int, how: str) -> DataFrame:
    """Join with ``right`` (one row a key), the many rows of one key in ``left`` dealt to ``salts`` tasks."""
    few = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int")).join(few, [*keys, "__salt"], how).drop("__salt")


def ordered_turns(df: DataFrame) -> DataFrame:
    """``conv_id, place, d1, d2, chars``: every turn with its place in its conversation (from 0) and two hashes of role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("at"), F.col("turn").isNotNull().alias("numbered"),
        role.alias("role"), _hash(1, role, text).alias("d1"), _hash(2, role, text).alias("d2"), F.length(text).cast("long").alias("chars"))
    ranked = running(turns, "at", {"n": ("sum", F.lit(1).cast("long"))}, ["conv_id"], ties=["numbered", "role", "d1", "d2"])
    return ranked.select("conv_id", (F.col("n") - 1).alias("place"), "d1", "d2", "chars")


def rebuilt(turns: DataFrame, settings: Settings) -> DataFrame:
    """The first h turns of conversation c - c % 100, then c's own turns after its first h; h = crc32(c) % 6."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    sizes = convs.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    # A conversation's own turns, a stretch of them to each copy of its row.
    copies = convs.select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / settings.stretch))).alias("stretch"))
    own = turns.withColumn("stretch", F.floor(F.col("place") / settings.stretch)).join(copies, ["conv_id", "stretch"]).filter("place >= h") \
        .select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("place"), "d1", "d2", "chars")
    # No more than 200 conversations share a base, and no more than 5 of its turns.
    first = turns.filter("place < 5 AND conv_id % 100 = 0").withColumnRenamed("conv_id", "base")
    shared = convs.filter("taken > 0").select("conv_id", "base", "h").join(first, "base").filter("place < h").select("conv_id", "place", "d1", "d2", "chars")
    return own.unionByName(shared)


def blocks_of(turns: DataFrame, settings: Settings) -> DataFrame:
    """``conv_id, blk, b1, b2, turns``: every block's digest and its turns (place, digests, length) in order."""
    x = turns.select("conv_id", F.floor(F.col("place") / settings.block).alias("blk"),
                     F.struct("place", _hash(11, "place", "d1", "d2").alias("x1"), _hash(12, "place", "d1", "d2").alias("x2"), "chars").alias("t"))
    return x.groupBy("conv_id", "blk").agg(F.bit_xor("t.x1").alias("b1"), F.bit_xor("t.x2").alias("b2"), F.sort_array(F.collect_list("t")).alias("turns"))


def grouped(blocks: DataFrame) -> DataFrame:
    """One row for each distinct block after a distinct beginning (digest ``p1, p2``): its members' number and least id."""
    # Exclusive or with nothing is nothing: the first block of each conversation starts from (0, 0).
    x = running(blocks, "blk", {"p1": ("xor", F.col("b1")), "p2": ("xor", F.col("b2"))}, ["conv_id"], exclusive=True)
    return x.groupBy("blk", F.coalesce("p1", F.lit(0).cast("long")).alias("p1"), F.coalesce("p2", F.lit(0).cast("long")).alias("p2"), "b1", "b2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("least"), F.first("turns").alias("turns"))


def _unrolled(groups: DataFrame) -> DataFrame:
    """A row for each turn of each block: its own digest, its parent's, and the block's members."""
    upto = lambda k: F.aggregate(
        F.slice("turns", F.lit(1), k), F.struct(F.col("p1").alias("c1"), F.col("p2").alias("c2")),
        lambda a, t: F.struct(a["c1"].bitwiseXOR(t["x1"]).alias("c1"), a["c2"].bitwiseXOR(t["x2"]).alias("c2")))
    rows = F.transform("turns", lambda t, i: F.struct((t["place"] + 1).alias("depth"), upto(i + 1).alias("c"), upto(i).alias("p"), t["chars"].alias("chars")))
    return groups.select("n_convs", "least", F.explode(rows).alias("r")).select(
        "r.depth", "r.c.c1", "r.c.c2", F.col("r.p.c1").alias("u1"), F.col("r.p.c2").alias("u2"), "r.chars", "n_convs", "least")


def trie_nodes(groups: DataFrame, settings: Settings) -> DataFrame:
    """``depth, c1, c2, u1, u2, chars, n_convs, least``: every node but the root, with its parent's digest ``u1, u2``."""
    later = groups.filter("blk > 0")
    siblings = later.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("p1", "p2", F.lit(True).alias("diverge"))
    later = _salted(later, siblings, ["p1", "p2"], F.col("b1"), settings.salts, "left")
    apart = groups.filter("blk = 0").unionByName(later.filter("diverge").select(*groups.columns))
    refined = _unrolled(apart).groupBy("depth", "c1", "c2").agg(
        F.min("u1").alias("u1"), F.min("u2").alias("u2"), F.min("chars").alias("chars"), F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"))
    return refined.unionByName(_unrolled(later.filter("diverge IS NULL").select(*groups.columns)))


def _subtrees(nodes: DataFrame, settings: Settings) -> DataFrame:
    """``c1, c2, n_leaves, saved`` of every node of two conversations and more, summed over its subtree."""
    s = keep(nodes.filter("n_convs > 1").select(
        "c1", "c2", "depth", F.col("u1").alias("a1"), F.col("u2").alias("a2"),
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("singles")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    deepest = s.agg(F.max("depth")).first()[0] or 0
    step = 1  # a1, a2 is the ancestor so many turns up; sums reach all that is less than so many turns down
    while step <= deepest:
        up = s.filter(F.col("depth") >= step).groupBy(F.col("a1").alias("c1"), F.col("a2").alias("c2")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("v"))
        wider = s.join(up, ["c1", "c2"], "left").select(
            "c1", "c2", "depth", "a1", "a2", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("v", F.lit(0))).alias("saved"))
        ended = wider.filter(F.col("depth") < 2 * step)
        higher = s.select(F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("a1").alias("h1"), F.col("a2").alias("h2"))
        jumped = _salted(wider.filter(F.col("depth") >= 2 * step), higher, ["a1", "a2"], F.col("c1"), settings.salts, "inner") \
            .select("c1", "c2", "depth", F.col("h1").alias("a1"), F.col("h2").alias("a2"), "n_leaves", "saved")
        s, step = keep(ended.unionByName(jumped)), 2 * step
    return s.select("c1", "c2", "n_leaves", F.col("saved").alias("saved_tokens"))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``c1, c2, ends_sha256``: the hash of the ids that end at a node, fed to it one batch after the other."""

    def run(batches):
        key, digest, out = None, None, []

        def batch():
            cols = list(zip(*out)) if out else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["c1", "c2", "ends_sha256"])

        for b in batches:
            for c1, c2, i in zip(b["c1"].to_pylist(), b["c2"].to_pylist(), b["conv_id"].to_pylist()):
                if (c1, c2) == key:
                    digest.update(b",%d" % i)
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (c1, c2), hashlib.sha256(b"%d" % i)
            if len(out) >= 1024:
                yield batch()
                out = []
        if key is not None:
            out.append((*key, digest.hexdigest()))
        yield batch()

    return ends.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "conv_id").mapInArrow(run, "c1 long, c2 long, ends_sha256 string")


def prefix_trie(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every node of the trie of rebuilt conversations, from the textless root.

    ``df`` has ``conv_id, turn, role, text``.  Turns stand in order of ``turn``,
    null first; turns of equal numbers in order of role, then of a hash of their
    text.  Null roles and texts are empty; rows without a conversation's id take
    no part.  Repeated rows are turns like others.  Rebuilt conversations may be
    turnless: they are members of the root and end there.  An empty table has no
    conversations, hence no root and no rows.  For negative ids ``%`` keeps the
    sign, as in SQL.  Conversations of any length are read whole, other columns
    ignored.

    The hash of one node's ends is one sequential hash, so the ids that end at
    one node are sorted and fed to it by one task, never held.
    """
    turns = keep(ordered_turns(df))
    blocks = keep(blocks_of(rebuilt(turns, settings), settings))
    convs = turns.select("conv_id").distinct()
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("least")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("c1"), zero.alias("c2"), F.lit(None).cast("long").alias("u1"), F.lit(None).cast("long").alias("u2"),
                       zero.alias("chars"), "n_convs", "least")
    nodes = keep(trie_nodes(keep(grouped(blocks)), settings).unionByName(root))
    children = nodes.filter("depth > 0").groupBy(F.col("u1").alias("c1"), F.col("u2").alias("c2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("singles"))
    nodes = keep(nodes.join(children, ["c1", "c2"], "left").fillna(0, ["n_children", "singles"]))
    # A parent of one conversation has its child's least id; only shared parents are looked up, the root needs no look.
    parents = nodes.filter("n_convs > 1 AND depth > 0").select(F.col("c1").alias("u1"), F.col("c2").alias("u2"), F.col("least").alias("up"))
    top = nodes.filter("depth = 0").select(F.col("least").alias("top")).scalar()
    deep = _salted(nodes.filter("depth > 1"), parents, ["u1", "u2"], F.col("c1"), settings.salts, "left").withColumn("parent_conv_id", F.coalesce("up", "least")).drop("up")
    flat = nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    ends = convs.select("conv_id", zero.alias("b1"), zero.alias("b2")).unionByName(blocks.select("conv_id", "b1", "b2")) \
        .groupBy("conv_id").agg(F.bit_xor("b1").alias("c1"), F.bit_xor("b2").alias("c2"))
    out = flat.unionByName(deep.select(*flat.columns)).join(_subtrees(nodes, settings), ["c1", "c2"], "left").join(_end_hashes(ends), ["c1", "c2"], "left")
    return out.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_conversation_trie(spark, sf_dir) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
