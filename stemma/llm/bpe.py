"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

A sequence of tokens is the encoding of its bytes if and only if each two neighbours are the encoding of theirs. So the
last token of the encoding of every prefix follows from the last tokens of shorter prefixes: of the tokens that end
here, the one whose neighbour before it is compatible. Reading on byte by byte, the encodings of the newest prefixes
(as many as the longest token has bytes: the next token can't begin earlier) share their first tokens; those can't
change any more and are emitted. ``sufficient_lookahead`` computes from the merge list how far a later byte can
reach back, which bounds what is held.

Memory is constant in the text: a pretoken in progress holds that window, the memos are cleared at a fixed size, and
ids leave in blocks for the consumer (a digest, a decoder).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern that splits text before the merges, with white space as Unicode defines it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Last code point of the plain pattern; texts beyond it go through ``SPLIT`` itself.
PLAIN_LAST = 0xFFFF
#: Entries at which a memo is cleared.
MEMO = 400_000
#: Characters handed to the splitting pattern at once.
SEGMENT = 1 << 20
#: Lookaheads that make up a window: the bytes of one pretoken read between two emissions.
LOOKAHEADS = 32


def byte_alphabet() -> dict[str, int]:
    """Character to byte, as byte-level vocabularies write them: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def plain_split() -> re.Pattern:
    """``SPLIT`` for texts up to PLAIN_LAST, as a pattern of bit tables, which costs half: classes written out as ranges."""
    every = "".join(chr(c) for c in range(PLAIN_LAST + 1) if not 0xD800 <= c <= 0xDFFF)

    def runs(kind: str) -> str:
        found = (m[0] for m in regex.finditer(kind + "+", every))
        return "".join(rf"\u{ord(run[0]):04x}-\u{ord(run[-1]):04x}" for run in found)

    letter, number, space = map(runs, (r"\p{L}", r"\p{N}", r"\p{White_Space}"))
    # no apostrophe is a letter, number or space, so the order of the first three does not matter; the most frequent comes first
    return re.compile(rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class _Memo(dict):
    """Computes missing values; emptied at MEMO entries."""

    def __init__(self, compute) -> None:  # noqa: ANN001
        super().__init__()
        self.compute = compute

    def __missing__(self, key):  # noqa: ANN001, ANN204
        if len(self) >= MEMO:
            self.clear()
        self[key] = value = self.compute(key)
        return value


class Transducer:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        raw = lambda token: bytes(to_byte[c] for c in token)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ids = {raw(token): i for token, i in model["vocab"].items()}
        self.bytes = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.merges = {(self.ids[raw(a)], self.ids[raw(b)]): (rank, self.ids[raw(a) + raw(b)]) for rank, (a, b) in enumerate(merges)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes += [b""] * (max([len(self.bytes) - 1, *self.added.values()]) + 1 - len(self.bytes))
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        made = {new for _, new in self.merges.values()}
        self.longest = max(len(self.bytes[i]) for i in made)
        self.lookahead = self.sufficient_lookahead()
        self.window = LOOKAHEADS * self.lookahead
        self.packed = [struct.pack("<I", i) for i in range(len(self.bytes))]
        self.trees = self._merge_trees()
        self.ends = self._reversed_tokens(made | {i for token, i in self.ids.items() if len(token) == 1})
        self.compatible = _Memo(self._compatible)
        self.words = _Memo(self._word)
        self.split = regex.compile(SPLIT)
        self.plain = plain_split()
        self.special = regex.compile("|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True))) if self.added else None

    def _reversed_tokens(self, tokens: set[int]) -> dict:
        """Trie of the tokens, last byte first; key -1 holds the token that ends there."""
        top: dict = {}
        for i in tokens:
            node = top
            for b in reversed(self.bytes[i]):
                node = node.setdefault(b, {})
            node[-1] = i
        return top

    def _merged(self, data: bytes) -> list[int]:
        """The merges in order of rank, on a few bytes."""
        parts = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.merges.get(pair, (1 << 30,))[0], i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [self.merges[parts[at], parts[at + 1]][1]]
        return parts

    def _merge_trees(self) -> dict[int, tuple[int, int, int]]:
        """Token: rank and parts of its last merge (-1 and itself for a byte), if its bytes merge along that tree and no other.

        Tokens with several merges, or that other merges take apart, and tokens made of such are left out.
        """
        made: dict[int, int] = {}
        for _, new in self.merges.values():
            made[new] = made.get(new, 0) + 1
        trees = {i: (-1, i, i) for token, i in self.ids.items() if len(token) == 1 and i not in made}
        for (a, b), (rank, new) in sorted(self.merges.items(), key=lambda x: x[1][0]):
            if made[new] == 1 and a in trees and b in trees and self._apart(a, b, rank, trees):
                trees[new] = (rank, a, b)
        return trees

    def _apart(self, a: int, b: int, limit: int, trees: dict[int, tuple[int, int, int]]) -> bool:
        """Whether no merge of a rank below the limit crosses the border of two tokens.

        Merges next to the border are undone, the latest first (of equal ones the right one, since merges go left to right).
        What meets at the border then must not merge before the merge just undone; on its left side also not with it.
        """
        merges = self.merges
        while True:
            if (crossing := merges.get((a, b))) is not None and crossing[0] < limit:
                return False
            rank_a, _, inner_a = trees[a]
            rank_b, inner_b, _ = trees[b]
            if rank_a > rank_b:
                limit, a = min(limit, rank_a), inner_a
            elif rank_b >= 0:
                limit, b = min(limit, rank_b + 1), inner_b
            else:
                return True

    def _compatible(self, pair: tuple[int, int]) -> bool:
        a, b = pair
        if a in self.trees and b in self.trees:
            return self._apart(a, b, len(self.merges), self.trees)
        return self._merged(self.bytes[a] + self.bytes[b]) == [a, b]

    # ---------- lookahead ----------

    def sufficient_lookahead(self) -> int:
        """Bytes after a token's end that can still undo it, at most.

        A merge of a pair is undone if an earlier merge takes the end of its right part first; that one in turn depends on
        what follows it. Walking the right edges of the merge trees in order of rank gives the longest such chain, in bytes.
        """
        parts = {new: pair for pair, (_, new) in self.merges.items()}
        rank_of = {new: rank for rank, new in self.merges.values()}
        follow: dict[int, list[tuple[int, int]]] = {}  # left part: (rank, bytes needed after it), ranks ascending
        reach = 0
        for (a, b), (rank, _) in sorted(self.merges.items(), key=lambda x: x[1][0]):
            need, edge, below = 0, b, rank
            while True:
                need = max([need, *(n for r, n in follow.get(edge, ()) if r < below)])
                if edge not in parts:
                    break
                below, edge = rank_of[edge], parts[edge][1]
            follow.setdefault(a, []).append((rank, len(self.bytes[b]) + need))
            reach = max(reach, len(self.bytes[b]) + need)
        return reach

    # ---------- encoding ----------

    def _grow(self, data: bytes, last: list[int]) -> None:
        """Appends the last tokens of the prefixes of data that are not in the list yet."""
        ends, compatible = self.ends, self.compatible
        for i in range(len(last), len(data) + 1):
            node, j, found = ends, i, -1
            while j > 0 and (node := node.get(data[j - 1])) is not None:
                j -= 1
                token = node.get(-1)
                if token is not None and (last[j] < 0 or compatible[last[j], token]):
                    found = token
                    break
            if found < 0:
                raise ValueError("a prefix without encoding: the vocabulary lacks a byte")
            last.append(found)

    def stream(self, blocks: Iterable[bytes]) -> Iterator[bytes]:
        """Bytes of one pretoken in, ids (little-endian unsigned 32-bit) out as soon as they are stable."""
        data = b""  # what has not been emitted
        last: list[int] = [-1]  # last[i]: the last token of the encoding of the first i bytes of data
        sizes = self.bytes
        for block in blocks:
            for start in range(0, len(block), self.window):
                data += block[start : start + self.window]
                self._grow(data, last)
                # where the encodings of the newest prefixes meet
                heads = set(range(max(0, len(data) + 1 - self.longest), len(data) + 1))
                while len(heads) > 1:
                    far = max(heads)
                    heads.discard(far)
                    heads.add(far - len(sizes[last[far]]))
                if meet := heads.pop():
                    yield self._back(last, meet)
                    kept = last[meet]
                    data, last = data[meet:], [kept, *last[meet + 1 :]]
                assert len(data) <= self.longest + self.lookahead, "a token is undone from beyond the lookahead"
        if data:
            yield self._back(last, len(data))

    def _word(self, word: str) -> bytes:
        """Ids of one pretoken; up to a window nothing need be emitted before its end."""
        data = word.encode()
        if len(data) > self.window:
            return b"".join(self.stream([data]))
        last = [-1]
        self._grow(data, last)
        return self._back(last, len(data))

    def _back(self, last: list[int], end: int) -> bytes:
        out = []
        while end > 0:
            out.append(self.packed[last[end]])
            end -= len(self.bytes[last[end]])
        return b"".join(reversed(out))

    def _pretokens(self, text: str) -> Iterator[list[str]]:
        """Lists of pretokens; long texts go through the pattern a segment at a time."""
        at, size = 0, SEGMENT
        while at < len(text):
            segment = text[at : at + size]
            plain = segment.isascii() or len(segment.encode("utf-16-le")) == 2 * len(segment)
            found = (self.plain if plain else self.split).findall(segment)
            if at + size < len(text):
                if len(found) < 4:  # pretokens about as long as the segment
                    size *= 2
                    continue
                found = found[:-2]  # the last ones may go on in the next segment
            yield found
            at, size = at + sum(map(len, found)), SEGMENT

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids (little-endian unsigned 32-bit)."""
        at = 0
        for m in [*(self.special.finditer(text) if self.special else ()), None]:
            for words in self._pretokens(text[at : m.start()] if m else text[at:]):
                word = self.words.__getitem__
                most = self.window
                if max(map(len, words)) <= most:
                    yield b"".join(map(word, words))
                else:  # a pretoken that no memo should hold
                    for w in words:
                        yield word(w) if len(w) <= most else b"".join(self.stream(w[i : i + most].encode() for i in range(0, len(w), most)))
            if m:
                yield struct.pack("<I", self.added[m[0]])
                at = m.end()

    # ---------- decoding ----------

    def decode(self, blocks: Iterable[bytes]) -> Iterator[str]:
        """Ids in, text out; bytes of a character that isn't whole yet wait for the next block."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        token = self.bytes.__getitem__
        for block in blocks:
            for start in range(0, len(block), 1 << 18):
                yield machine.decode(b"".join(map(token, np.frombuffer(block[start : start + (1 << 18)], "<u4").tolist())))
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each worker process and vocabulary."""
    return Transducer(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(text: str, machine: Transducer) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids, SHA-256 of the text decoded from them."""
    n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()

    def seen() -> Iterator[bytes]:
        nonlocal n
        for block in machine.encode(text):
            n += len(block) // 4
            ids.update(block)
            yield block

    for piece in machine.decode(seen()):
        decoded.update(piece.encode())
    return n, ids.hexdigest(), decoded.hexdigest()


def encode_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ids (array of int). Null texts count as empty and give an empty array."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary or default_vocabulary())
        for b in batches:
            made = [np.frombuffer(b"".join(machine.encode(t or "")), "<u4").astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.int32()))], ["_id", "ids"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(of, f"_id {rows.schema['_id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("_id", id_col)


def decode_documents(encoded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id and text. Null arrays give an empty text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary or default_vocabulary())
        for b in batches:
            made = ["".join(machine.decode([np.asarray(ids or [], "<u4").tobytes()])) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["_id", "text"])

    rows = encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(of, f"_id {rows.schema['_id'].dataType.simpleString()}, text string").withColumnRenamed("_id", id_col)


def round_trip(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode the ids again: one row per input row with n_tokens, ids_sha256, decoded_sha256.

    Null texts count as empty (no tokens). Repeated rows are encoded each; other columns are not read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary or default_vocabulary())
        for b in batches:
            made = [digests(t or "", machine) for t in b.column(1).to_pylist()]
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([m[i] for m in made], k) for i, k in enumerate(kinds))], ["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(of, schema).withColumnRenamed("_id", id_col)
