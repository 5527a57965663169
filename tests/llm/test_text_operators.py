"""Operators that read one text at a time: token counts, license scans, packing."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest
from helpers import EDGES, documents

from tidemark.llm import license as licenses
from tidemark.llm import packing, tokencount
from tidemark.llm.common import tokenizer_path
from tidemark.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")

PIECES = [" ", "  ", "\n", "\t", "a", "b", "'s", "'", "!", "\xa0", "\x85", "\x1c", "é", "é", "1", "²", "<|endoftext|>", "日本", "the",
          " ing", "ZZ", "​", "😀", "<|", "\r\n", "٣", "İ", "Σ", "½"]


def mixed(n, seed=1, longest=14):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def test_transducer_counts_like_the_library():
    path = tokenizer_path("byte_bpe_50k.json")
    t, lib = tokencount.transducer(path), tokenizers.Tokenizer.from_file(path)
    rnd = random.Random(2)
    texts = mixed(3000) + ["".join(rnd.choice("aethionsrnxz.!019ABé ") for _ in range(rnd.randint(1, 60))) for _ in range(2000)]
    for x in texts:
        want = len(lib.encode(x, add_special_tokens=False).ids)
        assert [t.count(x), t.count(x, 1), t.count(x, 5)] == [want] * 3, x


def test_chunk_maps_compose_associatively():
    t = tokencount.transducer(tokenizer_path("byte_bpe_50k.json"))
    for x in mixed(300, seed=3, longest=30):
        a, b, c = (t.chunk_map(p) for p in (x[: len(x) // 3], x[len(x) // 3 : len(x) // 2], x[len(x) // 2 :]))
        assert t.finish(t.compose(t.compose(a, b), c)) == t.finish(t.compose(a, t.compose(b, c))) == t.count(x)


def test_transducer_tables_start_anew(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_WORDS", 20)
    monkeypatch.setattr(tokencount, "CACHE_STATES", 20)
    t = tokencount.Transducer(tokenizer_path("byte_bpe_50k.json"))
    whole = tokencount.transducer(tokenizer_path("byte_bpe_50k.json"))
    for x in mixed(300, seed=4):
        assert t.count(x) == whole.count(x)


def test_token_counts_edges(spark):
    got = tokencount.count_tokens(documents(spark, EDGES), tokenizer_path("byte_bpe_50k.json")).collect()
    lib = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    key = lambda r: (str(r[0]), r[1])
    n = lambda t: len(lib.encode(t or "", add_special_tokens=False).ids)
    assert sorted(map(tuple, got), key=key) == sorted(((i, len((t or "").encode()), n(t), n(t) > 512) for i, t in EDGES), key=key)
    assert tokencount.count_tokens(documents(spark, []), tokenizer_path("byte_bpe_50k.json")).count() == 0


def _phrases(text):
    words = licenses.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_phrases_like_brute_force(spark, sf):
    scan = licenses.LicenseScanner(licenses.PHRASES, licenses.TEMPLATES)
    rnd = random.Random(3)
    parts = ["mit", "license", "MIT License", " ", "-", "cc", "by", "gnu general", "public license", "apache", "é", "CC-BY", ".", "\n", "0x", "_"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) for _ in range(12))
        assert scan.scan(t.encode())[:5] == _phrases(t)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_license_scans"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _phrases(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_templates():
    scan = licenses.LicenseScanner(licenses.PHRASES, licenses.TEMPLATES)
    names = lambda t: {x[0] for x in scan.scan(t.encode())[7]}
    assert names("This work is licensed under the GNU General Public License, version 3.") == {"gpl-notice"}
    assert names("Licensed under CC BY-NC 4.0.") == {"cc-notice"}
    assert names("Released under the MIT License.") == {"mit-notice"}
    assert names("Licensed under the Apache License, Version 2.0.") == {"apache-2.0-notice"}
    # Mandatory wording must match exactly.
    assert names("Licensed below the Apache License, Version 2.0.") == set()
    assert names("licensed under the apache license version 1.0") == set()
    assert names("Someone licensed nothing under an MIT-style licence.") == set()


def test_token_automaton_regions():
    a = licenses.TokenAutomaton("start <<optional>>maybe <<optional>>inner<</optional>><</optional>> <<var x 1-2>> <<one of red | dark blue>> end")
    m = lambda t: a.match(t.encode().split(), 0)
    assert m("start foo red end") == 4 and m("start maybe inner foo bar dark blue end") == 8
    assert m("start red end") == 0  # the replaceable region wants a word
    assert m("start a b c red end") == 0 and m("start foo green end") == 0
    with pytest.raises(ValueError):
        licenses.TokenAutomaton("<<optional>>open")
    with pytest.raises(ValueError):
        licenses.TokenAutomaton("<<var x 0-3>> anything")


def test_phrases_that_overlap_themselves_and_long_texts():
    import time

    scan = licenses.LicenseScanner({"a a": "twice"}, licenses.TEMPLATES)
    assert scan.scan(b"a a a  a b a")[:4] == (6, 3, 0, 2)
    began = time.perf_counter()
    long = b"the rule applies under law here now " * 60_000 + b"under the MIT license "  # 2 MB in which templates begin everywhere
    got = licenses.LicenseScanner(licenses.PHRASES, licenses.TEMPLATES).scan(long)
    assert got[:4] == (7 * 60_000 + 4, 1, 7 * 60_000 + 2, 7 * 60_000 + 2) and time.perf_counter() - began < 20


def test_license_edges(spark):
    got = licenses.scan_licenses(documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by = {r.doc_id: r for r in got}
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].base_labels, by[1].labels, by[1].score) == (0, 0, None, "", "", 0.0)
    assert by[6].n_words == 40_000
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def _check_packing(rows, texts, limits):
    """Every id in one piece, sequences gapless and within all limits."""
    lib = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces.pop(i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(s) <= limits.segments and sum(r.loss_tokens for r in s) <= limits.loss
    return sequences


def test_word_tokenizer_like_the_library():
    path = tokenizer_path("word_bpe_49k.json")
    t, lib = packing.word_tokenizer(path), tokenizers.Tokenizer.from_file(path)
    for x in mixed(6000, seed=5):
        assert t.encode(x) == np.array(lib.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x


def test_packing_ids_of_every_near_character_are_the_librarys():
    path = tokenizer_path("word_bpe_49k.json")
    t, lib = packing.WordTokenizer(path, 50, 50), tokenizers.Tokenizer.from_file(path)
    t.library = _NoBatches(t.library)  # a word's ids come without an encoding of it
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b words", f"é{c} {c}{c}'s 12"):
            t.bound()
            assert t.encode(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(ord(c))


class _NoBatches:
    def __init__(self, library):
        self.encode = library.encode


def test_packing_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sequences = _check_packing(QUERIES["op6_packing"](spark, sf).collect(), docs, packing.Limits())
    short = [s for s in sequences.values() if sum(r.length for r in s) < 2000]
    assert len(short) <= spark.read.parquet(f"{sf}/documents.parquet").rdd.getNumPartitions()


def test_packing_limits_and_prompts(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma."]) for _ in range(rnd.choice([0, 1, 5, 40, 300])))) for i in range(300)]
    df = documents(spark, rows).withColumn("prompt", __import__("pyspark").sql.functions.col("doc_id") % 30).coalesce(2)
    limits = packing.Limits(tokens=128, segments=5, loss=90, least_cut=4)
    out = packing.pack_documents(df, tokenizer_path("word_bpe_49k.json"), limits, loss_from="prompt").collect()
    _check_packing(out, dict(rows), limits)


def test_packing_edges(spark):
    rows = [r for r in EDGES if r[0] not in (5, None)]
    path = tokenizer_path("word_bpe_49k.json")
    _check_packing(packing.pack_documents(documents(spark, rows), path).collect(), dict(rows), packing.Limits())
    every = packing.pack_documents(documents(spark, EDGES), path).collect()
    assert sum(r.start == 0 for r in every) == len(EDGES)  # repeated rows are packed one by one
    assert packing.pack_documents(documents(spark, []), path).count() == 0
