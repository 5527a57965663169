"""Vector bin packing of tokenized examples into training sequences.

Every example demands a vector: tokens, one segment, loss-bearing tokens.  A
sequence offers limits on all three at once.  An open sequence repeatedly takes
the example whose demand has the largest dot product with what is left of the
limits (both scaled by the limits), among those that fit; when none fits and
tokens are left, the example with the largest product is cut to fill the rest.

Each task packs the examples it has tokenized, a bounded buffer at a time, and
carries what is left over into the next buffer, so nothing is shuffled and at
most one sequence a task stays partly empty.  Tasks read disjoint rows, and a
sequence's number starts with its partition's, so numbers are unique and a
repeated task gives the same rows again.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small_batches, table, tokenizer_path

#: Examples a task holds open at once.
BUFFER = 512
#: Distinct words, and items of words and punctuation, that fill a generation of a worker's tables; two are kept.
CACHE_WORDS, CACHE_ITEMS = 250_000, 150_000
END = (1).to_bytes(4, "little")


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    #: A cut leaves no piece shorter than this to fill a sequence.
    least_cut: int = 16


@dataclass
class Piece:
    """Tokens ``start``.. of one example; ``ids`` are little-endian 32-bit; ``loss`` marks loss-bearing tokens."""

    owner: int
    start: int
    ids: bytes
    total: int
    loss: np.ndarray | None = None

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def loss_tokens(self) -> int:
        return self.length if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.owner, self.start, self.ids[: 4 * n], self.total, None if self.loss is None else self.loss[:n])
        tail = Piece(self.owner, self.start + n, self.ids[4 * n :], self.total, None if self.loss is None else self.loss[n:])
        return head, tail


def full_pieces(piece: Piece, limits: Limits) -> tuple[list[Piece], Piece | None]:
    """The parts of a long example that fill a sequence alone, and what remains."""
    whole = []
    while piece.length >= limits.tokens or piece.loss_tokens > limits.loss:
        n = limits.tokens
        if piece.loss is not None:
            n = min(n, int(np.searchsorted(np.cumsum(piece.loss[:n]), limits.loss, side="right")))
        if n >= piece.length:
            return [*whole, piece], None
        head, piece = piece.cut(max(n, 1))
        whole.append(head)
    return whole, (piece if piece.length else None)


def pack_buffer(pieces: list[Piece], limits: Limits, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences made of ``pieces``; without ``last``, pieces that can't fill a sequence any more are handed back."""
    pieces = list(pieces)
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    need = np.array([[p.length, 1, p.loss_tokens] for p in pieces], float).reshape(-1, 3) / cap
    free = np.ones(len(pieces), bool)
    out: list[list[Piece]] = []
    tokens_left = sum(p.length for p in pieces)
    while tokens_left and (last or tokens_left >= 4 * limits.tokens):
        rest, made = np.ones(3), []
        while True:
            product = np.where(free, need @ rest, -1.0)
            fits = product * (need <= rest + 1e-12).all(axis=1)
            best = int(fits.argmax())
            if free[best] and fits[best] > 0:
                made.append(pieces[best])
                free[best] = False
                rest = rest - need[best]
                continue
            room = round(rest[0] * limits.tokens)
            best = int(product.argmax())
            if room < limits.least_cut or rest[1] * limits.segments < 0.5 or product[best] <= 0:
                break
            n = room
            if pieces[best].loss is not None:
                n = min(n, int(np.searchsorted(np.cumsum(pieces[best].loss[:n]), round(rest[2] * limits.loss), side="right")))
            elif room > round(rest[2] * limits.loss):
                n = round(rest[2] * limits.loss)
            if n < limits.least_cut or n >= pieces[best].length:
                break
            head, pieces[best] = pieces[best].cut(n)
            made.append(head)
            need[best] = np.array([pieces[best].length, 1, pieces[best].loss_tokens]) / cap
            break
        tokens_left -= sum(p.length for p in made)
        out.append(made)
    return out, [p for p, f in zip(pieces, free, strict=True) if f]


def pack(examples: Iterable[Piece], limits: Limits, buffer: int = BUFFER) -> Iterator[list[Piece]]:
    """Sequences (lists of pieces) of a stream of whole examples."""
    held: list[Piece] = []
    for example in examples:
        whole, rest = full_pieces(example, limits)
        yield from ([p] for p in whole)
        if rest is not None:
            held.append(rest)
        if len(held) >= buffer:
            made, held = pack_buffer(held, limits, last=False)
            yield from made
    yield from pack_buffer(held, limits, last=True)[0]


# -- tokenizing --------------------------------------------------------------
def _letters(start: str) -> str:
    """Character class body: the characters below U+0250 whose category starts so."""
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c).startswith(start))


class WordTokenizer:
    """Ids by the ``tokenizers`` library, asked once per distinct word.

    Words are what the file's own pre-tokenizer cuts (never across white space),
    so equal words have equal ids.  Texts with letters above U+024F (where
    lower-casing and composition depend on more than a letter), separators that
    count as white space only here, or special-token strings go to the library
    whole.
    """

    def __init__(self, path: str, most_words: int = CACHE_WORDS, most_items: int = CACHE_ITEMS):
        from tokenizers import Tokenizer

        self.most_words, self.most_items = most_words, most_items
        self.library = Tokenizer.from_file(path)
        letter, digit = _letters("L"), _letters("N")
        # Fixed value: the file's word pattern, spelt out for letters below U+0250.
        self.word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^\\s{letter}{digit}]+")
        # Characters whose lower case lies beyond are as far.
        self.far = re.compile("[^\x00-\u024f]|[" + "".join(c for c in map(chr, range(0x250)) if max(c.lower()) > "\u024f") + "]")
        self.odd = ("\x1c", "\x1d", "\x1e", "\x1f", *(t.content for t in self.library.get_added_tokens_decoder().values()))
        self.model, self.cut = self.library.model, self.library.pre_tokenizer.pre_tokenize_str
        self.words, self.ids, self.old_words, self.old_ids = {}, {}, {}, {}

    def plain(self, text: str) -> bool:
        if any(x in text for x in self.odd):
            return False
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            return self.far.search(text) is None

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids, without special tokens."""
        if not self.plain(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        items, ids = text.lower().split(), self.ids
        try:
            return b"".join(map(ids.__getitem__, items))
        except KeyError:
            self._ask([x for x in dict.fromkeys(items) if x not in ids])
            return b"".join(map(ids.__getitem__, items))

    def _ask(self, items: list[str]) -> None:
        """Ids of items that this generation hasn't seen: from the one before, else from their words."""
        ids, words, old_ids, old_words = self.ids, self.words, self.old_ids, self.old_words
        for x in items:
            known = old_ids.get(x)
            if known is None:
                cut = [x] if x.isalpha() else self.word.findall(x)
                for w in cut:
                    if w not in words:
                        words[w] = old_words.get(w) or self._word(w)
                known = words[cut[0]] if len(cut) == 1 else b"".join([words[w] for w in cut])
            ids[x] = known

    def _word(self, word: str) -> bytes:
        """Ids of one lower-cased word, by the library's model: a word needs no spans, which whole encodings hold."""
        # Printable ASCII characters stand for their own bytes; other words take the file's own pre-tokenizer.
        if word.isascii() and word.isprintable():
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", [t.id for part, _ in self.cut(word) for t in self.model.tokenize(part)]).tobytes()

    def forget(self) -> None:
        """Give the tables' memory back: the worker may go on with other work."""
        self.ids, self.old_ids, self.words, self.old_words = {}, {}, {}, {}

    def bound(self) -> None:
        """Called between texts: a full generation becomes the old one, so what is common stays known."""
        if len(self.ids) > self.most_items:
            self.ids, self.old_ids = {}, self.ids
        if len(self.words) > self.most_words:
            self.words, self.old_words = {}, self.words


@lru_cache(maxsize=2)
def word_tokenizer(path: str, most_words: int = CACHE_WORDS, most_items: int = CACHE_ITEMS) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(path, most_words, most_items)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits(), loss_from: str | None = None,
                   tables: tuple[int, int] = (CACHE_WORDS, CACHE_ITEMS), forget: bool = False) -> DataFrame:
    """All documents as pieces of packed sequences, one row per piece.

    ``loss_from`` names a column with the number of leading characters that bear
    no loss (a prompt); without it every token bears loss.  ``tables`` are the
    sizes of a worker's word tables: larger ones take memory and save time; with
    ``forget`` a task leaves none behind in its worker.  A null text is
    empty and packs its end token alone; repeated rows and ids are packed one by
    one; an empty table gives no rows; a text of any length is cut into full
    sequences; other columns, whatever their names, are ignored.
    """
    prompt = F.coalesce(F.col(loss_from).cast("long"), F.lit(0)) if loss_from else F.lit(0).cast("long")
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), prompt.alias("prompt"))

    def examples(batches) -> Iterator[Piece]:
        tok = word_tokenizer(path, *tables)
        for b in slices(batches):
            for doc, text, n in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "prompt")), strict=True):
                tok.bound()
                ids = tok.encode(text) + END
                loss = None
                if loss_from:
                    loss = np.ones(len(ids) // 4, np.int64)
                    loss[: len(tok.encode(text[:n])) // 4] = 0
                yield Piece(doc, 0, ids, len(ids) // 4, loss)

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        for k, made in enumerate(pack(examples(batches), limits)):
            at = 0
            for p in made:
                rows.append((p.owner, p.start, p.length, crc32(p.ids), p.total, first + k, at, p.loss_tokens))
                at += p.length
            if len(rows) > 8192:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)
        if forget:
            word_tokenizer(path, *tables).forget()

    return rows.mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [f.split()[0] for f in PIECES.split(", ")])


def op6_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), tables=(600_000, 600_000))
