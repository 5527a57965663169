"""Quality by hierarchical empirical Bayes.

A document's own evidence is a naive-Bayes log-odds over binned measures of its
text (shares of byte kinds, repetition, length), tempered by a logistic curve so
that correlated measures aren't counted twice.  Where it was published adds a
prior: the share of good documents at its path, shrunk towards its host's, which
is shrunk towards the whole corpus's:

    host  = (good_h + a * corpus) / (n_h + a)
    path  = (good_p + b * host)   / (n_p + b)
    logit p(good) = curve(evidence) + logit(path) - logit(corpus)

``a`` and ``b`` are estimated from how much hosts (paths of a host) differ beyond
what chance explains, so sparse sites lean on what is above them.  All counts
are grouped aggregates over every labelled document that isn't held out; hot
hosts are pre-aggregated by each task.  What is sent to tasks: the table of
measures x bins (fixed size), and the sites' posteriors only while they are
counted to be few (joined by a shuffle beyond that).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import keep, slices, small_batches, table
from tidemark.llm.toxicity import held_out, logistic

BINS = 24
#: Byte kinds whose shares are measured.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n\r",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "bar": b"|",
    "sign": b"#$%&*+/<=>@[\\]^_`{}~",
    "control": bytes(range(9)) + bytes(range(14, 32)) + b"\x7f",
    "high": bytes(range(128, 256)),
}
MEASURES = [*KINDS, "lines_again", "words_again", "word_twice", "word_length", "length"]


@dataclass(frozen=True)
class Settings:
    #: Documents whose probability of being good is below this are rejected; low, so that only documents with clear evidence go.
    threshold: float = 0.2
    #: Sites up to which their posteriors are sent to every task instead of being joined by a shuffle.
    small_sites: int = 200_000


def _kind_matrix() -> np.ndarray:
    m = np.zeros((256, len(KINDS)))
    for k, members in enumerate(KINDS.values()):
        m[list(members), k] = 1
    return m


_MATRIX = _kind_matrix()


def _log_bin(share: float) -> int:
    """Bins that double: shares from 2**-12 up, finer near nothing than near all."""
    return min(BINS - 1, int(2 * math.log2(1 + 4096 * share)))


def measure(text: bytes) -> list[int]:
    """Binned measures of one text; those of an empty text are all 0."""
    if not text:
        return [0] * len(MEASURES)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MATRIX / len(text)
    lines, words = [x for x in text.split(b"\n") if x], text.split()
    out = [_log_bin(x) for x in shares]
    out.append(_log_bin(1 - len(set(lines)) / len(lines)) if lines else 0)
    # Growth of the vocabulary against the text (Heaps): repetition whatever the length.
    out.append(min(BINS - 1, int(BINS * (1 - math.log(len(set(words))) / math.log(len(words)))) * 2) if len(words) > 1 else 0)
    out.append(_log_bin(sum(map(eq, words, words[1:])) / len(words)) if words else 0)
    out.append(min(BINS - 1, int(len(text) / (len(words) + 1))))
    out.append(min(BINS - 1, int(math.log2(1 + len(text)))))
    return out


def measured(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """``row`` (the document as it came), ``doc_id``, ``host``, ``path``, ``bins``."""
    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                      F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    schema = T.StructType([*rows.schema.fields, T.StructField("bins", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b in slices(batches):
            bins = [measure(x or b"") for x in b["row"].field("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b[f] for f in ("row", "doc_id", "host", "path")), pa.array(bins, pa.list_(pa.int32()))],
                                             ["row", "doc_id", "host", "path", "bins"])

    return rows.mapInArrow(run, schema)


@dataclass
class Evidence:
    """Log-odds of every measure's bins, and the curve that tempers their sum."""

    odds: list[list[float]]
    bias: float
    slope: float

    def column(self, bins: Column) -> Column:
        table = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in self.odds])
        total = F.aggregate(F.zip_with(table, bins, lambda row, b: F.element_at(row, b + 1)), F.lit(0.0), lambda a, x: a + x)
        return F.lit(self.bias) + F.lit(self.slope) * total


def labelled(rows: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    marked = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("good"))
    return rows.join(marked, "doc_id")


def learn_evidence(seen: DataFrame) -> Evidence:
    """``seen``: ``bins``, ``good``.  Counts by (measure, bin, class), then the curve from a histogram of the sums."""
    counts = seen.select("good", F.posexplode("bins").alias("m", "b")).groupBy("m", "b", "good").count().toArrow()  # measures x bins x 2 rows
    c = np.zeros((2, len(MEASURES), BINS))
    c[counts["good"].to_numpy(), counts["m"].to_numpy(), counts["b"].to_numpy()] = counts["count"].to_numpy()
    p = (c + 0.5) / (c.sum(axis=2, keepdims=True) + 0.5 * BINS)
    odds = np.log(p[1]) - np.log(p[0])
    raw = Evidence(odds.tolist(), 0.0, 1.0)
    hist = seen.select("good", F.round(raw.column(F.col("bins")) * 2).cast("int").alias("x")).groupBy("good", "x").count().toArrow()
    x, y, n = hist["x"].to_numpy() / 2, hist["good"].to_numpy().astype(float), hist["count"].to_numpy()
    w = weighted_logistic(x, y, n)
    return Evidence(odds.tolist(), float(w[0]), float(w[1]))


def weighted_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bias and slope from a histogram; without both classes, the prior alone."""
    if len(x) == 0 or y.min() == y.max():
        return logistic(np.ones((len(y), 1)), y).tolist() + [0.0] if len(y) else np.zeros(2)
    w, design = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-2])
        w = w - np.clip(np.linalg.solve(hess, design.T @ (n * (p - y)) + [0, 1e-2 * w[1]]), -2, 2)
    return w


def _strength(groups: DataFrame, prior: str) -> float:
    """Prior strength by the moments of a beta-binomial: how alike the groups' shares are around ``prior``."""
    r = groups.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(prior), 2)).alias("s"),
        F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))).alias("v"),
        F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("k")).first()
    if not r["total"] or r["k"] < 2 or not r["v"]:
        return 10.0
    v = r["v"] / r["total"]
    spread = v * (r["total"] - r["squares"] / r["total"] - (r["k"] - 1))
    rho = (r["s"] - v * (r["k"] - 1)) / spread if spread > 0 else 0.0
    return float(min(1e4, max(1.0, (1 - rho) / rho if rho > 0 else 1e4)))


def sites(seen: DataFrame) -> tuple[DataFrame, float]:
    """``host, path, host_good, path_good`` (posterior shares), and the corpus's share."""
    paths = keep(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good")))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    corpus = ((whole["good"] or 0) + 1) / ((whole["n"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("prior", F.lit(corpus))
    a = _strength(hosts, "prior")
    hosts = hosts.select("host", ((F.col("good") + a * corpus) / (F.col("n") + a)).alias("host_good"))
    paths = paths.join(hosts, "host")
    b = _strength(paths, "host_good")
    return paths.select("host", "path", "host_good", ((F.col("good") + b * F.col("host_good")) / (F.col("n") + b)).alias("path_good")), corpus


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``row`` (as it came), ``doc_id, host, path, held_out, evidence, host_good, path_good, p_good, accepted``.

    ``host`` defaults to ``source``, ``path`` to its ``lang`` section.  Null text
    counts as empty, null hosts and paths as one nameless site; sites without
    labels get the posterior of what is above them; without labels at all every
    document is accepted at an even prior.  Repeated rows give a row each, an
    empty table none; texts are measured whole; the document's own columns travel
    inside ``row``, so their names can't clash.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    small = docs.select("doc_id", host.alias("source"), path.alias("lang"), "text")
    seen = keep(labelled(measured(small, F.col("source"), F.col("lang")).drop("row"), labels))
    evidence = learn_evidence(seen)
    posterior, corpus = sites(seen)
    posterior = keep(posterior)
    hosts = posterior.groupBy("host").agg(F.first("host_good").alias("host_alone"))
    few = posterior.limit(settings.small_sites + 1).count() <= settings.small_sites
    near = F.broadcast if few else (lambda x: x)
    scored = (
        measured(docs, host, path)
        .join(near(posterior), ["host", "path"], "left").join(near(hosts), "host", "left")
        .withColumn("host_good", F.coalesce("host_good", "host_alone", F.lit(corpus)))
        .withColumn("path_good", F.coalesce("path_good", "host_good"))
        .withColumn("evidence", evidence.column(F.col("bins")))
        .withColumn("p_good", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_good")) - F.lit(math.log(corpus / (1 - corpus)))))))
    )
    return scored.select("row", "doc_id", "host", "path", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "evidence", "host_good", "path_good",
                         "p_good", (F.col("p_good") >= settings.threshold).alias("accepted"))


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that the classifier keeps, with the columns they came with."""
    return classify(docs, labels, settings=settings).filter("accepted").select("row.*")


def op9_quality_classifier(spark, sf_dir) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("row")
