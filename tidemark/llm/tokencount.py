"""Token counts by a compiled finite-state tokenizer.

A byte-pair tokenizer is compiled into a deterministic transducer over bytes.
What the rest of a pre-token can still become depends only on

* the vocabulary prefixes that end at the current byte (trie nodes), and
* for each of them the last token before it and the token count there,

so that set is the state.  A transition on a byte is annotated with the number
of tokens it adds to the count of the prefix read so far (it may be negative:
reading one more byte can merge tokens).  States are built when they are first
reached and kept.  That two tokens may stand side by side is asked of the merge
list once per pair.

Texts are read in chunks.  White space after a non-space always ends a
pre-token, whatever came before, so a chunk's state map is: its bytes before
the first such place, the count of all that is complete, its bytes after the
last such place.  These maps compose associatively; a long text's count is the
total of a parallel prefix scan (pairwise, log depth) over its chunk maps.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, texts, tokenizer_path

CHUNK_CHARS = 16_384
#: Counts of words and states of the transducer that a worker keeps; beyond it a table starts anew (counts stay exact).
CACHE_WORDS, CACHE_STATES = 400_000, 150_000

# Unicode white space, and the pre-token pattern of byte-level BPE.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)

_PLAIN = re.compile(r"\s*\S+|\s+")
_ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SAFE_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: visible Latin-1 letters stand for themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def spans(text: str) -> list[str]:
    """Pieces of ``text`` whose borders end a pre-token in any context."""
    return _PLAIN.findall(text) if _ODD.search(text) is None else [x for x in _SAFE_CUT.split(text) if x]


class Transducer:
    """Deterministic byte transducer whose transitions carry emitted-token counts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        known = set(self.specials)
        raw = lambda s: bytes(letters[c] for c in s)
        ids = {raw(w): i for w, i in model["vocab"].items() if w not in known}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for word, i in ids.items():
            self._add(word, i)
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for n, m in enumerate(model["merges"]):
            left, right = (raw(x) for x in (m.split(" ") if isinstance(m, str) else m))
            self.rank[ids[left], ids[right]] = n
            made.setdefault(ids[left + right], (n, ids[left], ids[right]))
        # How a token's outer part grows, merge by merge: its parts from a byte up, and when each is merged on.
        self.growth = [{i: self._grow(i, made, side) for i in ids.values()} for side in (2, 1)]
        self.beside: dict[tuple[int, int], bool] = {}
        self.pretoken = regex.compile(PRETOKEN)
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.words: dict[str, int] = {}
        self.counts: dict[str, int] = {}
        self.forget_states()

    def forget_states(self) -> None:
        """Start the state tables anew: bounds memory, changes no count."""
        start = ((0, -1, 0),)
        self.states: list[tuple] = [start]
        self.number: dict[tuple, int] = {start: 0}
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def bound(self) -> None:
        for kept in (self.words, self.counts):
            if len(kept) > CACHE_WORDS:
                kept.clear()
        if len(self.states) > CACHE_STATES:
            self.forget_states()
        if len(self.beside) > 4 * CACHE_WORDS:
            self.beside.clear()

    @staticmethod
    def _grow(token: int, made: dict, side: int) -> tuple[tuple[int, int], ...]:
        parts, until = [], 1 << 60
        while True:
            parts.append((token, until))
            if token not in made:
                return tuple(reversed(parts))
            until, token = made[token][0], made[token][side]

    def _add(self, word: bytes, number: int) -> None:
        node = 0
        for b in word:
            nxt = self.trie[node].get(b)
            if nxt is None:
                nxt = self.trie[node][b] = len(self.trie)
                self.trie.append({})
                self.token.append(-1)
            node = nxt
        self.token[node] = number

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` apart when they stand side by side.

        Both sides grow by their own merges in rank order; they stay apart if no
        merge over the border comes first (at one rank the leftmost place wins).
        """
        a, b, i, j = self.growth[0][left], self.growth[1][right], 0, 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            over = self.rank.get((x, y))
            if over is not None and over < x_until and over <= y_until:
                return False
            if x_until == y_until == 1 << 60:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and emitted count; built on first use."""
        moved, last, gained = [], -1, 0
        trie, beside = self.trie, self.beside
        for node, before, count in self.states[state]:
            child = trie[node].get(byte)
            if child is None:
                continue
            if last < 0 and (word := self.token[child]) >= 0:
                fits = before < 0 or beside.get((before, word))
                if fits is None:
                    fits = beside[before, word] = self._fits(before, word)
                if fits:
                    last, gained = word, count + 1
            if trie[child]:
                moved.append((child, before, count))
        key = (*((c, before, count - gained) for c, before, count in moved), (0, last, 0))
        nxt = self.number.get(key)
        if nxt is None:
            nxt = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        self.steps[state][byte] = (nxt, gained)
        return nxt, gained

    def count_pretoken(self, data: bytes) -> int:
        state = total = 0
        for b in data:
            known = self.steps[state].get(b)
            state, gained = known if known else self.step(state, b)
            total += gained
        return total

    def count_span(self, span: str) -> int:
        if self.special is not None and (cut := self.special.search(span)):
            parts = self.special.split(span)
            return len(parts) - 1 + sum(self.count_span(p) for p in parts if p)
        total, words = 0, self.words
        for p in self.pretoken.findall(span):
            n = words.get(p)
            if n is None:
                n = self.count_pretoken(p.encode())
                if len(p) < 64:
                    words[p] = n
            total += n
        return total

    def count_spans(self, words: list[str]) -> int:
        self.bound()
        counts = self.counts
        try:
            return sum(map(counts.__getitem__, words))
        except KeyError:
            total = 0
            for w in words:
                n = counts.get(w)
                if n is None:
                    n = self.count_span(w)
                    if len(w) < 64:
                        counts[w] = n
                total += n
            return total

    # -- chunk state maps --------------------------------------------------
    def chunk_map(self, chunk: str) -> tuple:
        """``(head,)`` if nothing inside is certain, else ``(head, count, tail)``."""
        words = spans(chunk)
        if len(words) < 2:
            return ("".join(words),)
        return words[0], self.count_spans(words[1:-1]), words[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """State map of two neighbouring chunks (associative)."""
        if len(a) == 1 and len(b) == 1:
            return self.chunk_map(a[0] + b[0])
        if len(a) == 1:
            m = self.chunk_map(a[0] + b[0])
            return (m[0], b[1], b[2]) if len(m) == 1 else (m[0], m[1] + self.count_spans([m[2]]) + b[1], b[2])
        if len(b) == 1:
            m = self.chunk_map(a[2] + b[0])
            return (a[0], a[1], m[0]) if len(m) == 1 else (a[0], a[1] + self.count_spans([m[0]]) + m[1], m[2])
        return a[0], a[1] + self.count_spans(spans(a[2] + b[0])) + b[1], b[2]

    def finish(self, m: tuple) -> int:
        return self.count_spans(spans(m[0])) if len(m) == 1 else self.count_spans([m[0]]) + m[1] + self.count_spans([m[2]])

    def count(self, text: str, chunk: int = CHUNK_CHARS) -> int:
        if len(text) <= chunk:
            return self.count_spans(spans(text))
        level = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(level) > 1:
            level = [self.compose(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return self.finish(level[0])


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK_CHARS) -> DataFrame:
    """Token count of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    One map over the texts, no shuffle.  Null text counts as empty (0 tokens);
    repeated rows and repeated ids each give their row; an empty table gives no
    rows; texts of any length are read chunk by chunk; other columns are ignored.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        t = transducer(path)
        n = pa.array([t.count(x, chunk) for x in b["text"].to_pylist()], pa.int64())
        size = pc.binary_length(b["text"]).cast(pa.int64())
        return pa.RecordBatch.from_arrays([b["doc_id"], size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_rows(texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")), run,
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir) -> DataFrame:
    from tidemark.llm.common import table

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
