"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A word is a string over the tokenizer's base symbols. An Aho-Corasick automaton over the tokens gives, for every
position, the longest token that starts there. The encoder takes it if it can follow the token before, else the
next shorter one, and goes back one token where none fits; a position that was given up is never tried again, so
the work is linear in the word's length. Two tokens can follow one another if no merge across their border would
have come before the merges that made them; that depends on the pair alone and is kept in a table.

The sequence found is the one that merging pairs in rank order would give. Tests hold it against the library.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a worker's table of words seen, and of compatible pairs. Full tables are emptied: no result depends on them.
WORDS_KEPT = 250_000
PAIRS_KEPT = 500_000
#: Longer words are not kept: texts without spaces would fill the table with whole paragraphs.
LONGEST_KEPT = 64

#: Marks the last symbol of a word in vocabularies with word ends.
_END = 0x1000


class Words(dict):
    """A bounded table of results by word, filled on demand. What was used since it last filled up stays.

    Two generations of short words take some 150 MB at most, whatever the texts.
    """

    def __init__(self, make, limit: int = WORDS_KEPT) -> None:
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, word):
        if len(word) > LONGEST_KEPT:
            return self.make(word)
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Tokenizer:
    """Encoder and decoder of a tokenizer file with a BPE model whose ids follow the order of merges."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Library

        whole = Library.from_file(path)
        self.normalize = whole.normalizer.normalize_str if whole.normalizer else str
        self.pieces = whole.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = {self._symbols(t): i for t, i in model["vocab"].items()}
        self.length = {i: len(s) for s, i in vocab.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in model["merges"]:
            pair = model["vocab"][a], model["vocab"][b]
            whole_id = model["vocab"][a.removesuffix(self.suffix) + b if self.suffix else a + b]
            self.split[whole_id] = pair
            self.merged[pair] = whole_id
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for s, i in vocab.items():
            self.automaton.add_word(s[::-1], i)
            self.shorter[i] = next((vocab[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in vocab), None)
        self.automaton.make_automaton()
        self.ids = vocab
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._offsets({**model["vocab"], **self.specials})
        self.byte_level = (spec["decoder"] or {}).get("type") == "ByteLevel"

    def _symbols(self, token: str) -> str:
        """One character per base symbol."""
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            token = token.removesuffix(self.suffix)
            return token[:-1] + chr(ord(token[-1]) + _END)
        return token

    def _offsets(self, vocab: dict[str, int]) -> None:
        """All tokens in one string, in the order of ids, and where each begins."""
        by_id = dict(sorted((i, t) for t, i in vocab.items()))
        size = max(by_id) + 1
        self.table = "".join(by_id.values())
        self.starts = np.cumsum([0, *(len(by_id.get(i, "")) for i in range(size))]).tolist()

    def follows(self, left: int, right: int) -> bool:
        """Would merging in rank order leave these two tokens side by side?

        Undo the merges that made them, latest first, keeping the two parts that touch. If such parts could merge
        with one another before the merge undone last, they would have done so.
        """
        key = left, right
        known = self.pairs.get(key)
        if known is not None:
            return known
        before = float("inf")  # merges from here on come after those not yet undone
        fits = True
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                fits = False
                break
            made = [self.split.get(left), self.split.get(right)]
            if made == [None, None]:
                break
            if made[1] is None or made[0] is not None and left > right:
                before, left = left, made[0][1]
            else:
                # Of equal merges the left one comes first: the same rank across the border wins over the right token.
                before, right = right + 1, made[1][0]
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[key] = fits
        return fits

    def encode_word(self, piece: str) -> list[int]:
        """Ids of one piece of text, given in the tokenizer's base symbols."""
        word = piece[:-1] + chr(ord(piece[-1]) + _END) if self.suffix else piece
        if word in self.ids:
            return [self.ids[word]]
        n = len(word)
        longest = [None] * n
        for end, i in self.automaton.iter(word[::-1]):
            at = n - 1 - end
            if longest[at] is None or self.length[i] > self.length[longest[at]]:
                longest[at] = i
        open_at = bytearray([1]) * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else None
            while token is not None:
                end = at + self.length[token]
                if open_at[end] and (last is None or self.follows(last, token)):
                    break
                token = self.shorter[token]
            if token is None:  # nothing fits here: never come back, and shorten the token before
                open_at[at] = 0
                if last is None:
                    raise ValueError(f"no encoding of {piece!r}")
                out.pop()
                at -= self.length[last]
                token = self.shorter[last]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text without adding special tokens; those in the text are found first."""
        out: list[int] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                out.append(self.specials[part])
            elif part:
                for piece, _ in self.pieces(self.normalize(part)):
                    out += self.encode_word(piece)
        return out

    def tokens(self, ids: list[int]) -> list[str]:
        table, starts = self.table, self.starts
        return [table[starts[i] : starts[i + 1]] for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: tokens from the offset table, joined as the tokenizer file says."""
        if not self.byte_level:
            return " ".join(self.tokens(ids))
        # Special tokens hold characters outside the byte alphabet only if their text does.
        return bytes(_byte_of()[c] for c in "".join(self.tokens(ids))).decode("utf-8", "replace")


@lru_cache
def _byte_of() -> dict[str, int]:
    """The byte alphabet: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


#: Letters up to here have had their classes, cases and compositions for long: every library agrees on them.
_SETTLED = re.compile("[^\x00-\x1b\x20-\u052f]|\u03a3")


class _Digester:
    """Number of ids, digest of the ids and of the text decoded from them."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
        self.cut = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.alphabet = {b: c for c, b in _byte_of().items()}
        self.pieces = Words(self._piece)
        self.chunks = Words(self._chunk)

    def _found(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), self.tokenizer.decode(ids)

    def _piece(self, piece: str) -> tuple[int, str, str]:
        return self._found(self.tokenizer.encode_word("".join(map(self.alphabet.__getitem__, piece.encode()))))

    def _chunk(self, chunk: bytes) -> tuple[int, str, str]:
        return self._found(self.tokenizer.encode(chunk.decode()))

    def __call__(self, text: str) -> tuple[int, str, str]:
        settled = not _SETTLED.search(text) and (text.isascii() or unicodedata.is_normalized("NFC", text))
        if settled and not (self.tokenizer.special and self.tokenizer.special.search(text)):
            found = list(map(self.pieces.__getitem__, self.cut(text.lower())))
        else:  # the tokenizer's own normaliser and cutter, between stretches of plain white space
            found = [f for f in map(self.chunks.__getitem__, text.encode().split()) if f[0]]
        digest = lambda k: hashlib.sha256(" ".join([f[k] for f in found]).encode()).hexdigest()
        return sum([f[0] for f in found]), digest(1), digest(2)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _Digester(path)
        for batch in batches:
            n, ids, decoded = zip(*[digests(text or "") for text in batch.column(1).to_pylist()]) if batch.num_rows else ([], [], [])
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encoded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of every whole text.

    For tokenizers that compose and lower-case text, cut it by a pattern that keeps no white space, and have no
    decoder, so that tokens are joined by spaces. Pieces met before are looked up. Null counts as
    empty: no tokens, digests of the empty text. Rows are taken one by one, whatever their ids; an empty table
    gives no rows. One word is at most as long as the text, and the work on it linear.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_digests(path), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            ids = [tokenizer.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)``: the ids of every whole text, for any BPE tokenizer file; null counts as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(path), "id long, ids array<int>").withColumnRenamed("id", id_col)


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            texts = [None if ids is None else tokenizer.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return run


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text)``: texts of ids; null ids give null."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoded(path), "id long, text string").withColumnRenamed("id", id_col)
