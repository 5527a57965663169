"""License scans by template matching.

Templates are license texts and notices with markup:

* ``<<optional>> ... <</optional>>``: wording that may be absent (nests);
* ``<<var name 0-8>>``: replaceable wording of so many words, any words;
* ``<<one of a | b c>>``: alternative wording.

A template is compiled into a token automaton: mandatory words are literal
transitions, optional regions are skips, replaceable regions are bounded loops
over any word.  The automaton is made deterministic as it is used (a state is
the set of places in the template) and runs from every place of a text where
one of its first words stands.  A text is accepted if all mandatory wording
stands in it exactly, in order, with nothing between but what the markup allows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table, texts

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License wording, in template markup.
TEMPLATES = {
    "gpl-notice": """
        <<optional>><<one of this | the>> <<one of work | program | software | library | project>> is<</optional>>
        <<one of licensed | released | distributed | available>> under <<optional>>the terms of<</optional>> <<optional>>the<</optional>>
        gnu <<optional>><<one of lesser | affero | library>><</optional>> general public license
        <<optional>><<one of version | v>> <<one of 1 | 2 | 2 0 | 2 1 | 3 | 3 0>><</optional>>
        <<optional>>or <<optional>>at your option<</optional>> any later version<</optional>>""",
    "gpl-header": """
        this <<one of program | library | file>> is free software you can redistribute it and or modify it under the terms of the gnu
        <<optional>><<one of lesser | affero | library>><</optional>> general public license as published by the free software foundation
        either version <<var version 1-3>> of the license or at your option any later version""",
    "apache-2.0-notice": """
        <<one of licensed | released | distributed>> under <<optional>>the terms of<</optional>> the apache license
        <<optional>><<one of version | v>><</optional>> 2 0""",
    "apache-2.0-header": """
        licensed under the apache license version 2 0 the license you may not use this <<one of file | work>> except in compliance with
        the license you may obtain a copy of the license at <<optional>><<one of http | https>> www apache org licenses license 2 0<</optional>>
        unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
        without warranties or conditions of any kind either express or implied""",
    "cc-notice": """
        <<optional>><<one of this | the>> <<one of work | text | article | page>> is<</optional>>
        <<one of licensed | released | distributed | available>> under <<optional>>a<</optional>> <<optional>>the<</optional>>
        <<one of cc | creative commons>> <<one of by | attribution>>
        <<optional>><<one of nc | noncommercial | non commercial>><</optional>> <<optional>><<one of sa | sharealike | share alike | nd | noderivatives>><</optional>>
        <<optional>><<one of 1 0 | 2 0 | 2 5 | 3 0 | 4 0>><</optional>> <<optional>>international<</optional>> <<optional>>license<</optional>>""",
    "mit-notice": """
        <<optional>><<one of this | the>> <<one of work | software | project>> is<</optional>>
        <<one of licensed | released | distributed | available>> under <<optional>>the terms of<</optional>> the mit license""",
    "mit-text": """
        <<optional>>the mit license <<optional>>mit<</optional>><</optional>> <<optional>>copyright <<var holder 0-16>><</optional>>
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject
        to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<</optional>>
        shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind""",
    "isc-text": """
        <<optional>>copyright <<var holder 0-16>><</optional>>
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
        the above copyright notice and this permission notice appear in all copies""",
    "bsd-text": """
        <<optional>>copyright <<var holder 0-16>><</optional>>
        redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions
        are met <<var mark 0-1>> redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer <<var mark 0-1>> redistributions in binary form must reproduce the above copyright notice this list of
        conditions and the following disclaimer in the documentation and or other materials provided with the distribution""",
}

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Bytes outside words become spaces, A-Z lower case; bytes from 128 up belong to words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MARK = re.compile(r"<<(/?)(optional|one of|var)([^>]*)>>")


class TokenAutomaton:
    """A compiled template: places joined by literal words, any-word steps and free steps."""

    def __init__(self, template: str):
        self.literal: list[list[tuple[bytes, int]]] = [[]]
        self.any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        end, opened, pos = 0, [], 0
        for m in [*_MARK.finditer(template), None]:
            for w in WORD.findall(template[pos : m.start() if m else len(template)].lower()):
                end = self._word(end, w.encode())
            if m is None:
                break
            pos = m.end()
            if m[2] == "optional" and not m[1]:
                opened.append(end)
            elif m[2] == "optional":
                self.free[opened.pop()].append(end := self._join(end))
            elif m[2] == "var":
                least, most = map(int, m[3].split()[-1].split("-"))
                ways = []
                for k in range(most + 1):
                    if k >= least:
                        ways.append(end)
                    if k < most:
                        nxt = self._place()
                        self.any[end].append(nxt)
                        end = nxt
                out = self._place()
                for w in ways:
                    self.free[w].append(out)
                end = out
            else:
                out = self._place()
                for choice in m[3].split("|"):
                    at = end
                    for w in WORD.findall(choice.lower()):
                        at = self._word(at, w.encode())
                    self.free[at].append(out)
                end = out
        if opened:
            raise ValueError("an optional region is not closed")
        self.accept = end
        self.states = {self._close({0}): {}}
        self.start = next(iter(self.states))
        self.first = {w for p in self.start for w, _ in self.literal[p]}
        if not self.first or any(self.any[p] for p in self.start) or self.accept in self.start:
            raise ValueError("a template must begin with wording")

    def _place(self) -> int:
        for x in (self.literal, self.any, self.free):
            x.append([])
        return len(self.literal) - 1

    def _join(self, at: int) -> int:
        out = self._place()
        self.free[at].append(out)
        return out

    def _word(self, at: int, word: bytes) -> int:
        out = self._place()
        self.literal[at].append((word, out))
        return out

    def _close(self, places: set[int]) -> frozenset[int]:
        todo, seen = list(places), set(places)
        while todo:
            for q in self.free[todo.pop()]:
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        return frozenset(seen)

    def step(self, state: frozenset, word: bytes) -> frozenset:
        """Deterministic step; words that no place names share one entry."""
        row = self.states[state]
        if not row:
            row[None] = self._close({q for p in state for q in self.any[p]})
            self.states.setdefault(row[None], {})
            for w in {w for p in state for w, _ in self.literal[p]}:
                nxt = {q for p in state for v, q in self.literal[p] if v == w} | {q for p in state for q in self.any[p]}
                row[w] = self._close(nxt)
                self.states.setdefault(row[w], {})
        return row.get(word, row[None])

    def match(self, words: list[bytes], at: int) -> int:
        """Words accepted from ``at`` on, the longest way; 0 if none."""
        state, best = self.start, 0
        for k in range(at, len(words)):
            state = self.step(state, words[k])
            if not state:
                break
            if self.accept in state:
                best = k + 1 - at
        return best


class LicenseScanner:
    """Phrases and templates over one text at a time."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = {b" ".join(k.encode().split()): v for k, v in phrases.items()}
        self.automata = {k: TokenAutomaton(t) for k, t in templates.items()}
        whole = lambda x: rb"(?<![^ ])(?:" + x + rb")(?![^ ])"
        # Looked at from outside: a phrase may begin inside its own last place.
        self.phrase = {re.compile(rb"(?<![^ ])(?=" + rb" +".join(p.split()) + rb"(?![^ ]))"): v for p, v in self.phrases.items()}
        first = {w for a in self.automata.values() for w in a.first}
        self.first = re.compile(whole(b"|".join(sorted(first))))
        # A template's longest mandatory word: it can't match where that word is missing.
        self.needs = {k: max(sorted(self._mandatory(a)), key=len) for k, a in self.automata.items()}

    @staticmethod
    def _mandatory(a: TokenAutomaton) -> list[bytes]:
        """Words without which the accepting place can't be reached."""
        words = {w for row in a.literal for w, _ in row}
        out = []
        for w in words:
            seen, todo = {0}, [0]
            while todo:
                p = todo.pop()
                for q in [*a.free[p], *a.any[p], *(q for v, q in a.literal[p] if v != w)]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
            if a.accept not in seen:
                out.append(w)
        return out

    def scan(self, raw: bytes) -> tuple:
        folded = raw.translate(_FOLD)
        words = folded.split()
        starts: np.ndarray | None = None

        def word_at(byte: int) -> int:
            """The number of the word that begins there, by one pass over the text for all that are asked."""
            nonlocal starts
            if starts is None:
                letters = np.frombuffer(folded, np.uint8) != 32
                starts = np.flatnonzero(letters & ~np.r_[False, letters[:-1]])
            return int(np.searchsorted(starts, byte))

        places: list[int] = []
        base: set[str] = set()
        for pattern, label in self.phrase.items():
            for m in pattern.finditer(folded):
                places.append(word_at(m.start()))
                base.add(label)
        found: dict[str, tuple[int, int]] = {}
        wanted = [(k, a) for k, a in self.automata.items() if self.needs[k] in folded]
        if wanted:
            for m in self.first.finditer(folded):
                for k, a in wanted:
                    if m[0] in a.first:
                        at = word_at(m.start())
                        n = a.match(words, at)
                        if n > found.get(k, (0, 0))[1]:
                            found[k] = (at, n)
        score = 1.0 if found else 0.5 if base else 0.0
        labels = base | set(found)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, [(k, *v) for k, v in sorted(found.items())])


@lru_cache(maxsize=2)
def _scanner(phrases: tuple, templates: tuple) -> LicenseScanner:
    return LicenseScanner(dict(phrases), dict(templates))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<template: string, word: long, length: long>>")


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """License phrases and accepted templates of every whole text, one row per document.

    ``score`` is 1 where a template is accepted, 0.5 where only a phrase stands,
    else 0; ``spans`` has each accepted template's longest place (first word,
    words; the first one of equals).  Null text counts as empty: no words, empty
    labels, null places.  Repeated rows give a row each, an empty table none;
    texts of any length are read whole; other columns are ignored.
    """
    key = (tuple(phrases.items()), tuple(templates.items()))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = _scanner(*key)
        rows = [s.scan(x) for x in b["text"].cast(pa.binary()).to_pylist()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
        kind = pa.list_(pa.struct([("template", pa.string()), ("word", pa.int64()), ("length", pa.int64())]))
        spans = pa.array([[dict(zip(("template", "word", "length"), x, strict=True)) for x in r] for r in cols[7]], kind)
        return pa.RecordBatch.from_arrays(
            [b["doc_id"], *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:6]), pa.array(cols[6], pa.float64()), spans],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return map_rows(texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")), run, SCHEMA)


def op3_license_scans(spark, sf_dir) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
