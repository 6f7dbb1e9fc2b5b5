"""Byte-level BPE by a sentencepiece model that is written straight from the vocabulary.

A rank file lists byte strings and their ranks.  Every byte becomes one character (U+0100 + byte), every byte string a
piece of these characters with score -rank, and the model says: BPE, identity normalisation, no dummy prefix, no white-space
escapes.  sentencepiece then merges the neighbours of the highest score, leftmost first: the merges of the rank file.
Texts are cut by the vocabulary's pattern; each distinct pre-token of a worker is encoded once and remembered, up to a bound.  A
pre-token that is in the vocabulary is its own id.  Decoding looks up the bytes of each id.

The pattern's letters and digits are those of the rank file's own library: where the regular-expression engine here
knows other ones (a later Unicode), a stand-in of the right class takes their place while the text is cut.

Edge cases: null text is empty and has no ids; bytes that are not UTF-8 become U+FFFD; very long texts are cut and encoded
in blocks of pre-tokens; rows with equal or null ids are encoded each for itself; further columns are not read; an empty
table gives no rows.  ``decode`` gives null for a null list and for one that holds null or an id outside the vocabulary.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import texts

BLOCK = 1 << 16  # pre-tokens that are encoded together
LONG = 1 << 20  # characters from which a text is cut block by block
HELD = 1 << 20  # ids in one output batch, about
REMEMBERED = 40_000_000  # characters of pre-tokens (and 64 for each) that a worker remembers before it starts afresh


# ---------------------------------------------------------------- the model
def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def characters(piece: bytes) -> str:
    """One character for each byte."""
    return "".join(chr(256 + b) for b in piece)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model, as its protocol buffer; piece number = place in the order of ranks, unknown last.

    Fixed values: the field numbers and codes of sentencepiece's public format."""
    piece = lambda text, score, kind: _bytes(1, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))
    normal, unknown, bpe = 1, 2, 2
    pieces = [piece(characters(p), -float(r), normal) for p, r in sorted(ranks.items(), key=lambda x: x[1])]
    pieces.append(piece("<unk>", 0.0, unknown))
    trainer = _number(3, bpe) + _number(4, len(pieces))
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


def stand_ins() -> dict[int, str]:
    """Characters whose class (letter, number, other) differs between this engine and the rank file's library -> a stand-in."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    theirs, ours = {}, {}
    for pattern, letter in ((r"\p{L}", "a"), (r"\p{N}", "0")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        theirs |= dict.fromkeys(bytes(found).decode(), letter)
        ours |= dict.fromkeys(regex.findall(pattern, every), letter)
    return {ord(c): theirs.get(c, "") for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}


# ---------------------------------------------------------------- coding
class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str, odd: dict[int, str]):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        order = sorted(self.ranks, key=self.ranks.__getitem__)
        self.rank_of = [self.ranks[p] for p in order]
        self.token = {self.ranks[p]: p for p in order}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.pattern, self.odd = regex.compile(pattern), odd
        spans = [f"{chr(a)}-{chr(b)}" for a, b in _runs(sorted(odd))]
        self.has_odd = re.compile(f"[{''.join(spans)}]").search if odd else lambda text: None
        self.known: dict[str, tuple] = {}
        self.held = 0

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, in blocks."""
        odd = not text.isascii() and self.has_odd(text)
        if len(text) < LONG and not odd:
            yield self.pattern.findall(text)
            return
        cut = self.pattern.finditer(text.translate(self.odd) if odd else text)
        while block := [text[slice(*m.span())] for m in islice(cut, BLOCK)]:
            yield block

    def learn(self, new: set[str], needed: list[str]) -> None:
        if self.held > REMEMBERED:
            self.known, self.held, new = {}, 0, set(needed)
        self.held += sum(map(len, new)) + 64 * len(new)
        merged = []
        for p in new:
            rank = self.ranks.get(p.encode())
            if rank is None:
                merged.append(p)
            else:
                self.known[p] = (rank,)
        for p, ids in zip(merged, self.model.encode([characters(p.encode()) for p in merged], out_type=int, num_threads=1) if merged else ()):
            self.known[p] = tuple(map(self.rank_of.__getitem__, ids))

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for block in self.pre_tokens(text):
            if new := {p for p in set(block) if p not in self.known}:
                self.learn(new, block)
            parts.append(np.fromiter(chain.from_iterable(map(self.known.__getitem__, block)), np.int32))
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _runs(codes: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive code points."""
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return [(a, b) for a, b in out]


_OPEN: dict[tuple, Codec] = {}


def codec(path: str, pattern: str, odd: dict[int, str]) -> Codec:
    """The worker's codec of a vocabulary; it outlives a task and remembers the pre-tokens of earlier ones."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = Codec(path, pattern, odd)
    return _OPEN[path, pattern]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids) of every text; with ``decoded`` also the bytes that the ids decode to, from the same pass."""
    d = texts(docs, id_col, text_col)
    kind, odd = d.schema["_id"].dataType.simpleString(), stand_ins()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from eventide.llm.byte_bpe import codec

        coder = codec(path, pattern, odd)
        for b in batches:
            first, parts, total = 0, [], 0
            for k, text in enumerate(b.column(1), 1):
                parts.append(coder.encode(text.as_py().decode("utf-8", "replace")))
                total += len(parts[-1])
                if total > HELD or k == b.num_rows:
                    columns = [b.column(0)[first:k], _lists(parts)]
                    if decoded:
                        columns.append(pa.array([coder.decode(p.tolist()) for p in parts], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][:len(columns)])
                    first, parts, total = k, [], 0

    return d.select("_id", F.col("_text").cast("binary")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the bytes of each list of ids."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from eventide.llm.byte_bpe import codec

        coder = codec(path, pattern, {})
        for b in batches:
            each = [ids.as_py() for ids in b.column(1)]
            out = [coder.decode(ids) if ids is not None and all(i in coder.token for i in ids) else None for ids in each]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")
