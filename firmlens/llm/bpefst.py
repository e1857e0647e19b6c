"""Byte-level BPE by a transducer that is determinised as texts need it, and streaming decoding.

A row of tokens is what the merges make of its bytes exactly if every two neighbours are what the
merges make of theirs, and every prefix of a piece has one such row. So a nondeterministic transducer
may guess at each byte whether a token ends there: its configurations are the place in the trie of
token bytes and the tokens guessed so far, and a token may only follow one that it stays apart from.
Sets of configurations become the states of a deterministic transducer when a text first reaches
them; what all configurations agree on is emitted, so output lags by a bounded lookahead and a piece
of any length takes time in proportion to its bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Mapping
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import rows
from firmlens.llm.tokens import Memory

#: Transitions that a worker keeps (about 300 bytes each with their states); beyond, it starts anew
#: with the next piece.
TRANSITIONS = 250_000
#: Answers on pairs of neighbours that a worker keeps.
PAIRS = 200_000
#: Bytes of pieces remembered with their ids (twice: kept and recent).
PIECES_BYTES = 32 << 20
#: Bytes of a piece after which tokens that are certain are passed on.
LOOK = 256
IDS_AT_ONCE = 4096
NEVER = 1 << 62


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str | None = None) -> bytes:
    """The file's content (base64 token and rank a line), which is what goes to the executors."""
    with open(path or vocabulary_path(), "rb") as file:
        return file.read()


@functools.lru_cache(maxsize=1)
def read_tokens(content: bytes) -> dict[int, bytes]:
    """The bytes of each rank."""
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {int(rank): base64.b64decode(token) for token, rank in lines}


class Merges:
    """Tokens by rank, the merge that makes each one, and which tokens may stand side by side."""

    def __init__(self, content: bytes):
        self.token = read_tokens(content)
        self.rank = {t: r for r, t in self.token.items()}
        #: The halves of each token, and the token of each two halves. Tokens that no merges lead to
        #: have none; only a whole piece can be one.
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[int, int] = {}
        for token, rank in self.rank.items():
            parts, last = self.merged(token)
            if last and len(parts) == 1:
                left, right = self.rank[last[0]], self.rank[last[1]]
                self.halves[rank] = left, right
                self.joined[left << 32 | right] = rank
        self._apart: dict[int, bool] = {}

    def merged(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """What the merges make of ``data``, lowest rank first and leftmost among equals, and the
        last merge."""
        parts, last = [data[i : i + 1] for i in range(len(data))], None
        while True:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                if (r := self.rank.get(parts[i] + parts[i + 1], NEVER)) < best:
                    best, at = r, i
            if at < 0:
                return parts, last
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` as they are when b follows a."""
        if (found := self._apart.get(a << 32 | b)) is None:
            if len(self._apart) >= PAIRS:
                self._apart.clear()
            found = self._apart[a << 32 | b] = self._stay(a, b)
        return found

    def _stay(self, u: int, v: int) -> bool:
        """Undo the merges on both sides of the boundary, latest first: no two tokens that faced each
        other across it may have a merge that came before the next one of either side. Of equal
        merges the left one comes first."""
        joined, halves = self.joined, self.halves
        u_until = v_until = NEVER
        while True:
            rank = joined.get(u << 32 | v)
            if rank is not None and rank < u_until and rank <= v_until:
                return False
            if u > v and u in halves or v not in halves:
                if u not in halves:
                    return True
                u_until, u = u, halves[u][1]
            else:
                v_until, v = v, halves[v][0]


class Transducer:
    """The lazily determinised transducer over the bytes of a piece.

    A state is the set of its configurations: (trie node, token before). One of them is always at the
    root of the trie, since every prefix has its row of tokens; a transition gives that row's last
    token. Which of these tokens are in the piece's row is certain as soon as all configurations hang
    from them.
    """

    def __init__(self, merges: Merges, transitions: int = TRANSITIONS):
        self.merges, self.limit = merges, transitions
        self.child: dict[int, int] = {}
        self.ends = [-1]
        self.inner = [True]
        self.depth = [0]
        for token, rank in merges.rank.items():
            if len(token) > 1 and rank not in merges.halves:
                continue
            node = 0
            for byte in token:
                key = node << 8 | byte
                if (below := self.child.get(key)) is None:
                    below = self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(False)
                    self.depth.append(self.depth[node] + 1)
                    self.inner[node] = True
                node = below
            self.ends[node] = rank
        self.size = {r: len(t) for t, r in merges.rank.items()}
        self._clear()

    def _clear(self) -> None:
        start = ((0, -1),)
        self.number, self.states = {start: 0}, [start]
        #: State and byte to last token and next state, both in one number.
        self.moves: dict[int, int] = {}

    def _move(self, at: int, byte: int) -> int:
        found, last = [], -1
        for node, before in self.states[at]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            token = self.ends[below]
            if last < 0 and token >= 0 and (before < 0 or self.merges.apart(before, token)):
                last = token
            if self.inner[below]:
                found.append((below, before))
        if last < 0:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        found.append((0, last))
        state = tuple(found)
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
        move = self.moves[at << 8 | byte] = last << 32 | to
        return move

    def _back(self, last: list[int], end: int, begin: int) -> list[int]:
        """The row of tokens from ``begin`` to ``end``, both ends of tokens."""
        out = []
        while end > begin:
            token = last[end - 1]
            out.append(token)
            end -= self.size[token]
        out.reverse()
        return out

    def row(self, piece: bytes) -> list[int]:
        """The tokens of a short piece: one walk ahead, one back from its end."""
        if len(self.moves) >= self.limit:
            self._clear()
        at, get, last = 0, self.moves.get, []
        for byte in piece:
            move = get(at << 8 | byte)
            if move is None:
                move = self._move(at, byte)
            last.append(move >> 32)
            at = move & 0xFFFFFFFF
        out, end, size = [], len(last), self.size
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size[token]
        out.reverse()
        return out

    def tokens(self, piece: Iterable[int]) -> Iterator[int]:
        """The tokens of a piece as they become certain. Every ``LOOK`` bytes those are passed on that all configurations
        hang from, so a piece of any length is held in a bounded part only."""
        if len(self.moves) >= self.limit:
            self._clear()
        at, get, last, source = 0, self.moves.get, [], iter(piece)
        while some := bytes(islice(source, LOOK)):
            if len(last) >= LOOK and (sure := self._sure(at, last)):
                yield from self._back(last, sure, 0)
                del last[:sure]
            for byte in some:
                move = get(at << 8 | byte)
                if move is None:
                    move = self._move(at, byte)
                last.append(move >> 32)
                at = move & 0xFFFFFFFF
        yield from self._back(last, len(last), 0)

    def _sure(self, at: int, last: list[int]) -> int:
        """The furthest end of a token that all configurations hang from."""
        begins = {len(last) - self.depth[node] for node, _ in self.states[at]}
        while len(begins) > 1:
            far = max(begins)
            begins.remove(far)
            begins.add(far - self.size[last[far - 1]] if far > 0 else 0)
        return max(0, begins.pop())


class Encoder:
    """Ids of whole texts: each match of the pattern by itself, through a bounded memory of pieces."""

    def __init__(self, content: bytes, pattern: str, pieces_bytes: int = PIECES_BYTES, transitions: int = TRANSITIONS):
        self.merges = Merges(content)
        self.transducer = Transducer(self.merges, transitions)
        self.pattern = regex.compile(pattern)
        self.known = Memory(pieces_bytes)

    def piece(self, text: str) -> bytes:
        """Ids (little-endian unsigned 32-bit); a piece that is a token is that token."""
        data = text.encode()
        whole = self.merges.rank.get(data)
        if whole is not None:
            return array("I", (whole,)).tobytes()
        return array("I", self.transducer.row(data) if len(data) <= LOOK else list(self.transducer.tokens(data))).tobytes()

    def ids(self, text: str | None) -> bytes:
        pieces = self.pattern.findall(text or "")
        kept = self.known.kept
        missing = {p for p in pieces if p not in kept}
        if not missing:
            return b"".join(map(kept.__getitem__, pieces))
        found = self.known.take(missing)
        new = {p: self.piece(p) for p in missing - found.keys()}
        self.known.add(new)
        found |= new
        return b"".join([found[p] if (k := kept.get(p)) is None else k for p in pieces])


class Utf8Machine:
    """Text out of bytes that come in any cuts. A state says which bytes may follow; bytes of a
    character that is not finished are held back, and each broken part becomes U+FFFD."""

    @staticmethod
    def _table() -> list[list[int]]:
        """States: 0 between characters; 1 to 3 that many continuation bytes are due; 4 to 7 after a
        first byte whose next one is restricted."""
        table = [[-1] * 256 for _ in range(8)]

        def allow(state: int, low: int, high: int, to: int) -> None:
            table[state][low : high + 1] = [to] * (high - low + 1)

        allow(0, 0x00, 0x7F, 0)
        allow(0, 0xC2, 0xDF, 1)
        allow(0, 0xE0, 0xEF, 2)
        allow(0, 0xF0, 0xF4, 3)
        for first, state in ((0xE0, 4), (0xED, 5), (0xF0, 6), (0xF4, 7)):
            allow(0, first, first, state)
        for due in (1, 2, 3):
            allow(due, 0x80, 0xBF, due - 1)
        allow(4, 0xA0, 0xBF, 1)
        allow(5, 0x80, 0x9F, 1)
        allow(6, 0x90, 0xBF, 2)
        allow(7, 0x80, 0x8F, 2)
        return table

    TABLE = _table()
    BEYOND_ASCII = re.compile(rb"[\x80-\xff]+")

    def __init__(self):
        self.state, self.held = 0, b""

    def feed(self, data: bytes) -> str:
        """The characters that are finished with ``data``."""
        if not self.held and data.isascii():
            return data.decode("ascii")
        table, state, out = self.TABLE, self.state, []
        start, skip = 0, len(self.held)
        data = self.held + data
        at = skip
        while at < len(data):
            if state == 0 and (run := self.BEYOND_ASCII.search(data, at)) is None:
                break
            if state == 0:
                at = run.start()
            first = at
            to = table[state][data[at]]
            if to < 0:
                # The broken part ends before a byte that cannot follow; a byte that cannot begin is one itself.
                begin = first if state == 0 else self._begin(data, first)
                out.append(data[start:begin].decode())
                out.append("�")
                at = first + 1 if state == 0 else first
                start, state = at, 0
                continue
            state, at = to, at + 1
        end = len(data) if state == 0 else self._begin(data, len(data))
        out.append(data[start:end].decode())
        self.state, self.held = state, data[end:]
        return "".join(out)

    @staticmethod
    def _begin(data: bytes, end: int) -> int:
        """Where the character begins that is unfinished at ``end``."""
        at = end - 1
        while 0x80 <= data[at] <= 0xBF:
            at -= 1
        return at

    def end(self) -> str:
        """What is left when no more bytes come."""
        left, self.state, self.held = self.held, 0, b""
        return "�" if left else ""


def decode(token: Mapping[int, bytes], ids: Iterable[int]) -> Iterator[str]:
    """The text of a row of ids, as far as it is certain after each few thousand of them."""
    ids, machine = iter(ids), Utf8Machine()
    while some := list(islice(ids, IDS_AT_ONCE)):
        yield machine.feed(b"".join([token[i] for i in some]))
    yield machine.end()


_workers: dict[bytes, Encoder] = {}


def _encoder(content: bytes, pattern: str) -> Encoder:
    """One encoder for each worker process, kept between tasks."""
    key = hashlib.sha256(content + pattern.encode()).digest()
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(content, pattern)
    return _workers[key]


def encode(docs: DataFrame, content: bytes, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row of ``docs``: texts are not cut, null
    and empty ones have no ids, repeated rows stay, an empty table gives no rows and other columns are
    not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content, pattern)
        for batch in rows(batches):
            ids = [encoder.ids(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def decoded(content: bytes, ids: Column) -> Column:
    """The text of ids; null stays null. Bytes that are no UTF-8 become U+FFFD, unknown ids are an
    error."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        token = read_tokens(content)
        return pd.Series([None if r is None else "".join(decode(token, np.frombuffer(r, "<u4").tolist())) for r in column], dtype=object)

    return run(ids)
