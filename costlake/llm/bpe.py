"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding. For a vocabulary whose tokens are ranked merges, the encoding of every prefix of a piece is
known from the encodings of shorter prefixes: the last token of prefix ``i`` is the one token ``t`` that
ends at ``i`` and may follow the last token of prefix ``i - len(t)``, where ``t`` may follow ``s`` if the
merges, run on the bytes of ``s + t`` alone, give back exactly ``s, t``. The transducer reads a piece byte
by byte. Its state is the set of prefixes that can still be a token boundary (those from which the bytes
read since then are the start of some token), each with its place in the vocabulary's trie and its last
token; a transition tells the token that ends at the byte. Only prefixes within the longest token's
length are open, so tokens before the last boundary that all open ones go through are certain: a long
piece emits them on the way (bounded lookahead and memory), a short one at its end. States and
transitions are made when first met and kept (``_Transducer.edges``): the lazy subset construction.

Decoding. ``Utf8Machine`` reads token bytes and gives out whole code points as they become complete; a
token of which a code point is cut keeps the cut bytes in the machine's state. Transitions are kept by
(state, token).

Tests hold the ids against the tiktoken library and the text against an exact round trip.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(ranks: dict[bytes, int], piece: bytes) -> list[bytes]:
    """The tokens of a short piece by the merges themselves: always the lowest rank, leftmost first."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class _Transducer:
    """Transitions of the encoder, made on demand. One per vocabulary and Python worker."""

    #: Kept states, pairs and pieces: beyond as many of one kind, that worker forgets and begins again.
    KEPT = 450_000

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.width = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.width.values())
        #: The vocabulary's trie: (node << 8 | byte) -> node; what each node spells; the tokens by node.
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: set[int] = {0}
        for token, rank in ranks.items():
            # A token that its own merges don't reach can only be a whole piece.
            if len(token) > 1 and len(merge(ranks, token)) > 1:
                continue
            node = 0
            for b in token:
                edge = node << 8 | b
                if edge not in self.child:
                    self.inner.add(node)
                    self.child[edge] = len(self.token_at)
                    self.token_at.append(-1)
                node = self.child[edge]
            self.token_at[node] = rank
        self.follows: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        #: A state: (trie node, last token) of each open boundary, the earliest first.
        self.states: list[tuple] = [((0, -1),)]
        self.number = {self.states[0]: 0}
        #: (state << 8 | byte) -> next state, token that ends here (-1: no boundary).
        self.edges: dict[int, tuple[int, int]] = {}

    def may_follow(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        known = self.follows.get((left, right))
        if known is None:
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.follows[left, right] = merge(self.ranks, a + b) == [a, b]
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the token that ends there, kept in ``edges``: the lazy subset construction."""
        moved, ends, token_at, inner = [], -1, self.token_at, self.inner
        for node, last in self.states[state]:
            child = self.child.get(node << 8 | byte)
            if child is None:
                continue
            if child in inner:  # else no longer token starts like this, and the boundary is closed
                moved.append((child, last))
            token = token_at[child]
            if ends < 0 <= token and self.may_follow(last, token):
                ends = token
        if ends >= 0:
            moved.append((0, ends))
        if not moved:
            raise ValueError("the vocabulary does not cover this piece")
        key = tuple(moved)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        self.edges[state << 8 | byte] = (to, ends)
        return to, ends

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ends, out, edges = 0, [], [], self.edges
        far = 4 * self.longest
        for byte in piece:
            found = edges.get(state << 8 | byte)
            state, token = found if found is not None else self.step(state, byte)
            ends.append(token)
            if len(ends) > far:  # a long piece: emit what all open boundaries have in common
                sure = self.certain(state, ends)
                if sure:
                    out += self.walk(ends, sure)
                    del ends[:sure]
        return out + self.walk(ends, len(ends))

    def walk(self, ends: list[int], at: int) -> list[int]:
        """The tokens up to boundary ``at``, from the last tokens of the prefixes."""
        out, width = [], self.width
        while at > 0:
            token = ends[at - 1]
            if token < 0:
                raise ValueError("the vocabulary does not cover this piece")
            out.append(token)
            at -= width[token]
        out.reverse()
        return out

    def certain(self, state: int, ends: list[int]) -> int:
        """The latest boundary that the way to every open boundary passes."""
        depth = {0: 0}
        common: set[int] | None = None
        for node, _ in self.states[state]:
            if node not in depth:
                depth[node] = self.depth_of(node)
            at, way = len(ends) - depth[node], set()
            while at > 0:
                way.add(at)
                at -= self.width[ends[at - 1]]
            common = way if common is None else common & way
        return max(common) if common else 0

    def depth_of(self, node: int) -> int:
        if not hasattr(self, "parent"):
            self.parent = {to: edge >> 8 for edge, to in self.child.items()}
        n = 0
        while node:
            node, n = self.parent[node], n + 1
        return n

    def encode_text(self, pieces: list[str]) -> list[int]:
        """Ids of a text's pieces, one after another; ids of pieces seen before are kept."""
        if len(self.pieces) > self.KEPT:
            self.pieces = {}
        if len(self.follows) > self.KEPT:
            self.follows = {}
        if len(self.edges) > self.KEPT:
            self.forget()
        known, out = self.pieces, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = self.encode(piece.encode())
                if len(piece) <= 32:
                    known[piece] = ids
            out += ids
        return out


class Utf8Machine:
    """Token ids -> text, a token at a time. The state is the bytes of a code point that is not complete."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.bytes_of = bytes_of
        self.kept: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def step(self, state: bytes, token: int) -> tuple[str, bytes]:
        data = state + self.bytes_of[token]
        machine = codecs.getincrementaldecoder("utf-8")(errors="strict")
        text = machine.decode(data)
        rest = machine.getstate()[0]
        self.kept[state][token] = (text, rest)
        self.kept.setdefault(rest, {})
        return text, rest

    def decode(self, ids: list[int]) -> Iterator[str]:
        """The text of ids in parts; raises on bytes that are no UTF-8, also on a cut code point at the end."""
        state, kept = b"", self.kept
        table = kept[state]
        for token in ids:
            found = table.get(token)
            text, rest = found if found is not None else self.step(state, token)
            if rest != state:
                state, table = rest, kept[rest]
            if text:
                yield text
        if state:
            raise UnicodeDecodeError("utf-8", state, 0, len(state), "the ids end inside a code point")


_CODERS: dict[tuple[str, str], tuple[_Transducer, Utf8Machine, regex.Pattern]] = {}


def coder(path: str, pattern: str) -> tuple[_Transducer, Utf8Machine, regex.Pattern]:
    """Encoder, decoder and compiled pattern of a vocabulary; made once in each Python worker."""
    if (path, pattern) not in _CODERS:
        encoder = _Transducer(load_ranks(path))
        _CODERS[path, pattern] = encoder, Utf8Machine(encoder.bytes_of), regex.compile(pattern)
    return _CODERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of each row's whole text.

    ``path``: a rank file, readable on every executor (part of an installed package). Each match of
    ``pattern`` is encoded on its own; strings of special tokens are ordinary text. A null or empty text
    gives no ids; repeated rows give repeated rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _, pieces = coder(path, pattern)
        for batch in batches:
            ids = [encoder.encode_text(pieces.findall(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return arrow_map(rows, run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: ids back to text through the UTF-8 machine. Null or no ids: empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, machine, _ = coder(path, pattern)
        for batch in batches:
            out = ["".join(machine.decode(ids or [])) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return arrow_map(rows, run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass, for checks: ``n_tokens``, the digest of the ids as
    little-endian 32-bit numbers, and the digest of the decoded bytes. Ids stay in the worker."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, machine, pieces = coder(path, pattern)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encoder.encode_text(pieces.findall(text or ""))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256("".join(machine.decode(ids)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = arrow_map(rows, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
