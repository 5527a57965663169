"""Secret scans with corpus-wide ownership frequency.

Every whole text is read once.  It gives the base spans (fixed patterns) and
candidates: the values of base spans, and long mixed tokens that no base
pattern names.  What a pattern can't tell is whether a value is in use: keys
printed in manuals look exactly like keys that open something.  The corpus can.
Live-looking candidates are hashed and counted by the distinct owners and
repositories that hold them.  A value that many owners hold was copied from an
example; a value of few owners is theirs, and its places become spans of their
own (kind ``live``).

Only hashes are shuffled, one row for each repository that holds a value, so a
value that a third of all documents repeat costs a row a repository; the way
back from values to documents is salted.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, map_rows, small_batches, table

# The base patterns, the least lengths of their values, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # of 16 and more: a shorter run of these letters holds no longer one
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "live")

#: Tokens that no base pattern names: long, and of more than one sort of character (see ``live_looking``).
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Words that stand in values which were never in use.
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[_-]|test[_-]|x{6}|0{8}|12345678|abcdef(?:gh|01)", re.IGNORECASE | re.ASCII)


@dataclass(frozen=True)
class Settings:
    #: A value of more owners or repositories than these was copied widely: an example.
    owners: int = 2
    repositories: int = 4
    #: What looks live: so many characters, so many bits a character, no placeholder words.
    least: int = 16
    most: int = 256
    entropy: float = 3.0
    #: Ways in which one value's places are dealt out when values go back to documents.
    salts: int = 32


def live_looking(value: str, settings: Settings = Settings()) -> bool:
    """Whether a value has the length, the mixture and the disorder of a generated credential."""
    if not settings.least <= len(value) <= settings.most:
        return False
    letters = any(c.isalpha() for c in value)
    if not letters or not any(c.isdigit() for c in value) or PLACEHOLDER.search(value):
        return False
    return entropy(value) >= settings.entropy


def entropy(value: str) -> float:
    """Bits a character, by the value's own frequencies."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def mixed(value: str) -> bool:
    """Small and capital letters and digits: what tells a token from a long word, a path or a number."""
    return any(c.islower() for c in value) and any(c.isupper() for c in value) and any(c.isdigit() for c in value)


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value's start, value's end) of every base span, by start, then kind."""
    out = [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), kind, m.end(), *m.span()) for kind, p in ((1, ACCESS), (2, HEX)) for m in p.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple], settings: Settings) -> list[tuple[int, int, bytes]]:
    """(start, end, hash) of every value that looks live, each place once."""
    places = {(s, e) for *_, s, e in base}
    for m in TOKEN.finditer(text):
        if len(m[0]) <= settings.most and mixed(m[0]):
            # A value that a base span already holds, or a part of one, is no candidate of its own.
            if not any(s <= m.start() and m.end() <= e for *_, s, e in base):
                places.add(m.span())
    return [(s, e, hashlib.blake2b(text[s:e].encode(), digest_size=16).digest()) for s, e in sorted(places) if live_looking(text[s:e], settings)]


SCANNED = ("doc_id long, owner string, repository string, base array<struct<start: long, kind: int, end: long>>, "
           "found array<struct<start: long, end: long, hash: binary>>")


def _scan(docs: DataFrame, owner: str, repository: tuple[str, ...], settings: Settings) -> DataFrame:
    named = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(owner).cast("string").alias("owner"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in repository])).alias("repository"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        base, found = [], []
        for t in b["text"].to_pylist():
            spans = base_spans(t)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e, *_ in spans])
            found.append([{"start": s, "end": e, "hash": h} for s, e, h in candidates(t, spans, settings)])
        return pa.RecordBatch.from_arrays(
            [b["doc_id"], b["owner"], b["repository"],
             pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))),
             pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary())])))],
            ["doc_id", "owner", "repository", "base", "found"])

    return map_rows(named, run, SCANNED)


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: how many distinct owners and repositories hold each value.

    ``found`` has ``hash, owner, repository``.  Duplicates go before the
    shuffles (partial aggregation), so a value's rows number its repositories,
    not its places.  A null owner counts as one owner, so does a null repository.
    """
    held = found.select("hash", "owner", "repository").distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), settings: Settings = Settings()) -> DataFrame:
    """Secrets of every whole text: base spans, and the places of owner-specific live-looking values.

    One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256,
    spans`` and ``n_live`` (places of kind ``live``: live-looking values of few
    owners), ``n_examples`` (places of live-looking values that are copied
    widely).  ``owner`` names the owner's column, ``repository`` the columns that
    tell one owner's repositories apart.

    Null text counts as empty: no spans, the hash of nothing.  Repeated rows
    give a row each and count as one holder; an empty table gives none.  Equal
    places of several kinds stand in the order assign, access, hex, live.  Texts
    of any length are read whole; other columns, whatever their names, are ignored.
    """
    # Written once, at a few numbers a document: counting and marking both read it.
    rows = keep(_scan(docs, owner, repository, settings).withColumn("row", F.monotonically_increasing_id()))
    with_values = F.size("found") > 0
    places = rows.filter(with_values).select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
    specific = ownership(places).filter((F.col("owners") <= settings.owners) & (F.col("repositories") <= settings.repositories))
    salted = specific.select("hash", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))).alias("salt"))
    live = places.withColumn("salt", F.pmod("row", F.lit(settings.salts)).cast("int")).join(salted, ["hash", "salt"]) \
        .groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("live")).alias("kind"), "end")).alias("live"))
    marked = rows.filter(with_values).join(live, "row", "left")
    plain = rows.filter(~with_values)
    none = F.lit([]).cast("array<struct<start: bigint, kind: int, end: bigint>>")
    both = marked.withColumn("live", F.coalesce("live", none)).unionByName(plain.withColumn("live", none))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return both.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "live")).alias("spans"), F.size("live").cast("long").alias("n_live"), (F.size("found") - F.size("live")).cast("long").alias("n_examples"))


def op11_secret_scans(spark, sf_dir) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
