"""Toxicity by class-conditional Kneser-Ney models.

Two models, toxic and ordinary, are learnt from labelled documents.  An
expression (a word) is predicted down a chain: the word itself, its stem (the
first letters), then what all documents share.  Counts are Kneser-Ney
continuation counts -- the number of different documents an expression stands
in, so that copies and repetition inside a document don't count -- with absolute
discounting that grows with the count (one document alone proves nothing and is
discounted whole); what the discounts take is dealt out by the next level:

    P_c(w) = max(n_c(w) - D(n_c(w)), 0) / N_c  +  l_c * P_c(stem of w) * share(w | stem)
    P_c(s) = max(m_c(s) - D(m_c(s)), 0) / M_c  +  k_c * pooled(s)

``share`` and ``pooled`` are the backoff counts of both classes together, so an
expression too rare to be counted in one class leans on them.

A document's evidence is the difference of the toxic and ordinary
log-likelihoods, normalised by length: over its whole text, and over its most
toxic passage (``passage`` words), for which the logarithm of the text's length
says how many passages there were to choose from.  A logistic curve fitted on
labelled documents -- each scored without its own counts -- turns them into a
score.

All labelled documents feed the counts, exactly, in a table that grows with their
vocabulary.  While it is counted to be small it is sent to every task; beyond
that the texts' different words are joined with it, with the same scores.  Only
the curve's weights come from a bounded sample (``fit_rows`` documents).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, slices, table, texts

WORD = re.compile(r"[^\W_]+")
#: Expressions a worker keeps the evidence of; beyond it the table starts anew.
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class Settings:
    #: Owners of hash ranges, as a power of two.
    owner_bits: int = 6
    #: Expressions up to which the counts are sent to every task (16 bytes each), and ways in which one word's documents are dealt out beyond.
    small_counts: int = 8_000_000
    salts: int = 32
    stem: int = 4
    #: Discounts of counts of 1, 2, and 3 or more.
    discounts: tuple[float, float, float] = (1.0, 1.6, 2.0)
    passage: int = 1
    fit_rows: int = 20_000
    #: Labelled rows up to which labels are sent to every task instead of being joined by a shuffle.
    small_labels: int = 2_000_000
    threshold: float = 0.3


def keys_of(word: str, stem: int) -> tuple[int, int]:
    """64-bit keys of a word and its stem (apart from each other by their seeds)."""
    return xxhash.xxh3_64_intdigest(word, 1), xxhash.xxh3_64_intdigest(word[:stem], 2)


def held_out(doc_id=None):
    """Rows kept out of learning: crc32 of the id as text leaves remainder 2."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string")) % 4 == 2


# -- learning -----------------------------------------------------------------
def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Labelled, not held-out documents, one of each group of equal texts and labels: ``doc_id, text, toxic``."""
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = _maybe_small(marked, settings)
    same = texts(docs).join(marked, "doc_id").groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("doc_id").alias("doc_id"))
    return texts(docs).join(_maybe_small(same.select("doc_id", "toxic"), settings), "doc_id")


def _maybe_small(rows: DataFrame, settings: Settings) -> DataFrame:
    """Sent to every task if counted to be small, else left to a shuffle join; the same rows either way."""
    return F.broadcast(rows) if rows.limit(settings.small_labels + 1).count() <= settings.small_labels else rows


COUNTED = "owner int, level int, keys binary, n binary, total array<long>, kinds array<long>, size long"


def gather(rows: DataFrame, settings: Settings) -> DataFrame:
    """In how many ordinary and toxic documents each word (level 0) and stem (level 1) stands, a packed row per owner and level.

    Tasks count their expressions and send them, packed, to the owner of their
    hash range; owners add up each expression's documents exactly.
    """
    stem, shift = settings.stem, np.uint64(64 - settings.owner_bits)

    def send(batches):
        found: dict[str, list[int]] = {}
        for b in slices(batches):
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                for w in set(WORD.findall(text.lower())):
                    found.setdefault(w, [0, 0])[toxic] += 1
            if len(found) > 400_000:
                yield packed(found)
                found = {}
        if found:
            yield packed(found)

    def packed(found: dict[str, list[int]]) -> pa.RecordBatch:
        """A word's documents, and for its stem the word's documents too (each word is one continuation)."""
        keys = np.array([keys_of(w, stem) for w in found], np.uint64)
        n = np.array(list(found.values()), np.uint32)
        stems, which = np.unique(keys[:, 1], return_inverse=True)
        m = np.stack([np.bincount(which, n[:, c]) for c in (0, 1)], axis=1).astype(np.uint32)
        out = []
        for level, k, x in ((0, keys[:, 0], n), (1, stems, m)):
            order = np.argsort(k)
            k, x = k[order], x[order]
            owner = (k >> shift).astype(np.int64)
            for o in np.unique(owner):
                at = slice(*np.searchsorted(owner, [o, o + 1]))
                out.append((int(o), level, k[at].tobytes(), x[at].tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["owner", "level", "keys", "n"])

    def answer(t: pa.Table) -> pa.Table:
        key = np.frombuffer(b"".join(t["keys"].to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(t["n"].to_pylist()), np.uint32).reshape(-1, 2)
        key, which = np.unique(key, return_inverse=True)
        n = np.stack([np.bincount(which, n[:, c], len(key)) for c in (0, 1)], axis=1).astype(np.uint32)
        row = (t["owner"][0].as_py(), t["level"][0].as_py(), key.tobytes(), n.tobytes(), n.sum(axis=0, dtype=np.int64).tolist(), (n > 0).sum(axis=0).tolist(), len(key))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
        return pa.table({f: pa.array([v], k) for f, v, k in zip(("owner", "level", "keys", "n", "total", "kinds", "size"), row, kinds, strict=True)})

    sent = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(send, "owner int, level int, keys binary, n binary")
    return sent.groupBy("owner", "level").applyInArrow(answer, COUNTED)


@dataclass(frozen=True)
class Sums:
    """By level and class: sums of counts, numbers of expressions."""

    totals: np.ndarray
    kinds: np.ndarray

    @staticmethod
    def of(counted: DataFrame) -> tuple[Sums, int]:
        """The sums, and how many expressions are counted in all."""
        totals, kinds, size = np.zeros((2, 2)), np.zeros((2, 2)), 0
        for r in counted.select("level", "total", "kinds", "size").collect():  # one row of numbers per owner and level
            totals[r["level"]] += r["total"]
            kinds[r["level"]] += r["kinds"]
            size += r["size"]
        return Sums(totals, kinds), size


def log_ratio(n: np.ndarray, m: np.ndarray, sums: Sums, settings: Settings, own: np.ndarray | None = None) -> np.ndarray:
    """log P_toxic(w) - log P_ordinary(w) of words with counts ``n`` and stems' counts ``m`` ([class, word]).

    ``own`` takes one document of that class (-1: none) out of the counts first.
    """
    cut = np.array([0.0, *settings.discounts])
    taken = lambda x: cut[np.minimum(x, 3).astype(int)]
    d = cut[1]
    n, m = n.astype(float), m.astype(float)
    if own is not None:
        for c in (0, 1):
            n[c], m[c] = np.maximum(n[c] - (own == c), 0), np.maximum(m[c] - (own == c), 0)
    kinds, totals = sums.kinds, np.maximum(sums.totals, 1.0)
    pooled = (m.sum(0) + 1) / (totals[1].sum() + sums.kinds[1].sum() + 1)
    share = (n.sum(0) + 1) / (m.sum(0) + 2)
    p = []
    for c in (0, 1):
        stem = np.maximum(m[c] - taken(m[c]), 0) / totals[1, c] + (d * kinds[1, c] + 1) / (totals[1, c] + 1) * pooled
        p.append(np.maximum(n[c] - taken(n[c]), 0) / totals[0, c] + (d * kinds[0, c] + 1) / (totals[0, c] + 1) * stem * share)
    return np.log(p[1]) - np.log(p[0])


class Models:
    """Both classes' counts as sorted arrays, and what texts make of them."""

    def __init__(self, counted: DataFrame, sums: Sums, settings: Settings):
        self.sums, self.settings = sums, settings
        self.tables = []
        rows = counted.select("level", "keys", "n").toArrow().to_pylist()  # counted before to be few
        for level in (0, 1):
            part = [r for r in rows if r["level"] == level]
            key = np.frombuffer(b"".join(r["keys"] for r in part), np.uint64)
            n = np.frombuffer(b"".join(r["n"] for r in part), np.uint32).reshape(-1, 2)
            order = np.argsort(key)
            self.tables.append((key[order], np.ascontiguousarray(n[order].T)))
        self.evidence: dict[str, float] = {}

    def counts(self, keys: np.ndarray, level: int) -> np.ndarray:
        """[class, key]: how many documents."""
        known, n = self.tables[level]
        if not len(known):
            return np.zeros((2, len(keys)))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, n[:, at], 0).astype(float)

    def log_ratio(self, words: list[str], own: int | None = None) -> np.ndarray:
        if not words:
            return np.zeros(0)
        keys = np.array([keys_of(w, self.settings.stem) for w in words], np.uint64)
        return log_ratio(self.counts(keys[:, 0], 0), self.counts(keys[:, 1], 1), self.sums, self.settings, None if own is None else np.full(len(words), own))

    def features(self, text: str, own: int | None = None) -> tuple[float, float, float]:
        """Length-normalised log-likelihood differences of the whole text and of its most toxic passage; log length."""
        words = WORD.findall(text.lower())
        if not words:
            return 0.0, 0.0, 0.0
        if own is None:
            known = self.evidence
            if len(known) > CACHE_WORDS:
                known.clear()
            try:
                x = list(map(known.__getitem__, words))
            except KeyError:
                new = [w for w in dict.fromkeys(words) if w not in known]
                known.update(zip(new, self.log_ratio(new).tolist(), strict=True))
                x = list(map(known.__getitem__, words))
        else:
            kinds = list(dict.fromkeys(words))
            found = dict(zip(kinds, self.log_ratio(kinds, own).tolist(), strict=True))
            x = [found[w] for w in words]
        span = min(self.settings.passage, len(x))
        if span == 1:
            return sum(x) / len(x), max(x), math.log(len(x))
        run = np.cumsum([0.0, *x])
        return sum(x) / len(x), float((run[span:] - run[:-span]).max() / span), math.log(len(x))


def features_by_join(rows: DataFrame, counted: DataFrame, sums: Sums, settings: Settings) -> DataFrame:
    """``row, whole, passage, length`` of ``row, text, own``: a text's different words meet the counts in joins.

    For vocabularies too large to send to every task.  A row without words has
    none in the result.  Words' evidence is worked out once per different word;
    the way back to the texts is salted, since the commonest words stand in all.
    """
    if settings.passage != 1:
        raise ValueError("passages of several words need counts that are few enough to be sent to every task")
    stem = settings.stem

    def terms(batches):
        for b in slices(batches):
            out = []
            for r, t, own in zip(b["row"].to_pylist(), b["text"].to_pylist(), b["own"].to_pylist(), strict=True):
                kinds: dict[str, int] = {}
                for w in WORD.findall(t.lower()):
                    kinds[w] = kinds.get(w, 0) + 1
                out += [(r, own, *keys_of(w, stem), k) for w, k in kinds.items()]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), signed(cols[2]), signed(cols[3]), pa.array(cols[4], pa.int64())],
                                             ["row", "own", "word", "stem", "times"])

    def unpacked(batches):
        for b in batches:
            for r in b.to_pylist():
                n = np.frombuffer(r["n"], np.uint32).reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["keys"], np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["key", "n0", "n1"])

    def weighed(batches):
        for b in batches:
            x = {c: np.asarray(b[c].fill_null(0)) for c in ("n0", "n1", "m0", "m1", "own")}
            ev = log_ratio(np.stack([x["n0"], x["n1"]]), np.stack([x["m0"], x["m1"]]), sums, settings, x["own"]) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b["word"], b["own"], pa.array(ev)], ["word", "own", "evidence"])

    each = rows.select("row", "text", F.col("own").cast("int").alias("own")).mapInArrow(terms, "row long, own int, word long, stem long, times long")
    level = lambda k, a, b: counted.filter(F.col("level") == k).select("keys", "n").mapInArrow(unpacked, "key long, n0 long, n1 long").toDF("key", a, b)
    words = each.select("word", "stem", "own").distinct()
    words = words.join(level(0, "n0", "n1").withColumnRenamed("key", "word"), "word", "left").join(level(1, "m0", "m1").withColumnRenamed("key", "stem"), "stem", "left")
    known = words.mapInArrow(weighed, "word long, own int, evidence double").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))))
    met = each.withColumn("salt", F.pmod("row", F.lit(settings.salts)).cast("int")).join(known, ["word", "own", "salt"])
    n = F.sum("times")
    return met.groupBy("row").agg((F.sum(F.col("evidence") * F.col("times")) / n).alias("whole"), F.max("evidence").alias("passage"), F.log(n.cast("double")).alias("length"))


@dataclass(frozen=True)
class Learnt:
    """Both models and the curve's weights (bias, whole text, passage, length)."""

    counted: DataFrame
    sums: Sums
    #: The models, sent to the tasks once; None where the counts are too many and texts are joined with them.
    sent: Broadcast | None
    weights: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Learnt:
    rows = training_rows(docs, labels, settings)
    counted = keep(gather(rows, settings))
    sums, size = Sums.of(counted)
    sent = docs.sparkSession.sparkContext.broadcast(Models(counted, sums, settings)) if size <= settings.small_counts else None
    found = Learnt(counted, sums, sent, np.zeros(4))
    return Learnt(counted, sums, sent, fit(rows, found, settings))


def fit(rows: DataFrame, learnt: Learnt, settings: Settings) -> np.ndarray:
    """Logistic weights from a bounded sample (the smallest hashes of ids), each text scored without its own counts."""
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(settings.fit_rows)
    sample = rows.join(F.broadcast(ids), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    if learnt.sent is None:
        sample = keep(sample.withColumn("row", F.monotonically_increasing_id()))
        found = features_by_join(sample.select("row", "text", F.col("toxic").alias("own")), learnt.counted, learnt.sums, settings)
        got = sample.select("row", "toxic").join(found, "row", "left").fillna(0.0).toArrow()
    else:
        sent = learnt.sent

        def run(batches):
            for b in slices(batches):
                y = b["toxic"].to_pylist()
                x = [sent.value.features(t, k) for t, k in zip(b["text"].to_pylist(), y, strict=True)]
                cols = list(zip(*x, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in cols), pa.array(y, pa.int32())], ["whole", "passage", "length", "toxic"])

        got = sample.mapInArrow(run, "whole double, passage double, length double, toxic int").toArrow()
    x = np.stack([np.ones(got.num_rows), *(got[c].to_numpy() for c in ("whole", "passage", "length"))], axis=1)
    return logistic(x, got["toxic"].to_numpy().astype(float))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton's method; the prior alone where there is one class or none."""
    w = np.zeros(x.shape[1])
    if len(y) == 0:
        return w
    if y.min() == y.max():
        w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return w
    penalty = ridge * len(y) * np.r_[0.0, np.ones(x.shape[1] - 1)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w = w - move
        if np.abs(move).max() < 1e-9:
            break
    return w


# -- scoring ------------------------------------------------------------------
def score(docs: DataFrame, learnt: Learnt, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, whole, passage``.

    A null or empty text has no evidence and gets the curve's value at none.
    Repeated rows and ids give a row each; an empty table gives none; texts are
    scored whole, whatever their length; other columns are ignored.
    """
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    sent, w = learnt.sent, learnt.weights

    def run(batches):
        m = sent.value
        for b in slices(batches):
            x = np.array([m.features(t) for t in b["text"].to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], *(pa.array(x[:, k]) for k in range(3))], ["doc_id", "held_out", "whole", "passage", "length"])

    if sent is None:
        # Rows are numbered in a written copy, so a text that is read again keeps its number.
        rows = keep(rows.withColumn("row", F.monotonically_increasing_id()))
        found = features_by_join(rows.select("row", "text", F.lit(-1).alias("own")), learnt.counted, learnt.sums, settings)
        scored = rows.drop("text").join(found, "row", "left").fillna(0.0, ["whole", "passage", "length"])
    else:
        scored = rows.mapInArrow(run, "doc_id long, held_out boolean, whole double, passage double, length double")
    line = F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("whole") + F.lit(float(w[2])) * F.col("passage") + F.lit(float(w[3])) * F.col("length")
    line = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), line))
    scored = scored.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-line)))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"), "whole", "passage")


def op1_toxicity(spark, sf_dir) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents"), Settings()
    return score(docs, learn(docs, table(spark, sf_dir, "labels"), settings), settings)
