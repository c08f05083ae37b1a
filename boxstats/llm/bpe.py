"""Byte-level BPE encoding by a lazily determinised finite-state transducer, and decoding.

A sequence of tokens is what the merges make of its bytes exactly if each token is made of its
own bytes and each two neighbours stay apart when merged as a pair. So the encodings of all
prefixes of a byte string form a tree: the encoding of a prefix is that of a shorter prefix
and one token. The transducer reads bytes from the left; its state holds the prefixes at which
a longer token may still begin, with the token before each. A token is emitted once the ways to
all of them go through it, so the lookahead is bounded by the longest token. States are made
when they are first reached, and transitions kept; the table is emptied when it is full.

Decoding looks up the tokens' bytes block by block and runs them through an incremental UTF-8
state machine, so that a character cut by a block's end is carried over.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.llm import tokens


class Merges:
    """What the ranks say of short byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, ...] | None] = {}
        self.own = {x for x in ranks if self.merge(x) == [x]}  # made of its own bytes
        self.longest = max(map(len, ranks))
        self.beginnings = {x[:i] for x in self.own for i in range(1, len(x))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, text: bytes) -> list[bytes]:
        """The merges one by one, the lowest rank first, then the leftmost."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while (fewer := self._merged(parts)) is not parts:
            parts = fewer
        return parts

    def _merged(self, parts: list[bytes]) -> list[bytes]:
        """The parts after one more merge; the same list if there is none."""
        none = len(self.ranks)
        rank, at = min(((self.ranks.get(a + b, none), i) for i, (a, b) in enumerate(pairwise(parts))), default=(none, 0))
        return parts if rank == none else [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none of a byte."""
        if token not in self.halves:
            text = self.tokens[token]
            parts = [text[i : i + 1] for i in range(len(text))]
            while len(parts) > 2:
                parts = self._merged(parts)
            self.halves[token] = tuple(self.ranks[x] for x in parts) if len(parts) == 2 else None
        return self.halves[token]

    def apart(self, a: bytes, b: bytes) -> bool:
        """Whether the merges leave a and b as they are, one after the other.

        The merges inside a and b are undone from the last one back. At each stage two tokens
        stand on either side of the border; if they have a merge that comes before the one
        undone last (which was made of the left one's or the right one's halves, and of equal
        ranks the leftmost goes first), it would have joined a and b.
        """
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b)
        return known

    def _apart(self, a: bytes, b: bytes) -> bool:
        left, right, before = self.ranks[a], self.ranks[b], len(self.ranks)
        while True:
            joined = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joined is not None and joined < before:
                return False
            of_left, of_right = self._halves(left), self._halves(right)
            if of_left and (not of_right or left > right):
                before, left = left, of_left[1]
            elif of_right:
                before, right = right + 1, of_right[0]  # the border is to the left of this merge
            else:
                return True


class Transducer:
    """Bytes to ids. A state is the set of prefixes at which a longer token may still begin, each
    as (the last token of its encoding, the bytes behind it), the whole prefix last. A step gives
    the next state and the last token of the new prefix's encoding; a token is emitted once all
    prefixes of the state go back through it, at the latest when the input ends."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 300_000):
        self.merges, self.limit = Merges(ranks), limit
        self.lookahead = 4 * self.merges.longest
        self.clear()

    def clear(self) -> None:
        start = ((b"", b""),)
        self.number = {start: 0}
        self.states: list[tuple] = [start]
        self.steps: list[dict[int, tuple[int, int, int]]] = [{}]

    def _step(self, at: int, byte: int) -> tuple[int, int, int]:
        """The next state's number, and the last token's rank and length."""
        m, new = self.merges, bytes((byte,))
        alive, whole = [], None
        for last, rest in self.states[at]:
            rest += new
            if whole is None and rest in m.own and (not last or m.apart(last, rest)):
                whole = rest  # the one prefix from which a token leads here
            if rest in m.beginnings:
                alive.append((last, rest))
        if whole is None:
            raise ValueError(f"byte {byte} is no token")
        alive.append((whole, b""))
        state = tuple(alive)
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        step = self.steps[at][byte] = (to, m.ranks[whole], len(whole))
        return step

    def _settled(self, at: int, path: list[tuple[int, int, int]]) -> int:
        """How far from the start all prefixes of the state go back through the same places."""
        ways = []
        for _, rest in self.states[at]:
            i, way = len(path) - len(rest), set()
            while i > 0:
                way.add(i)
                i -= path[i - 1][2]
            ways.append(way)
        return max(set.intersection(*ways), default=0)

    @staticmethod
    def _emit(path: list[tuple[int, int, int]], end: int) -> list[int]:
        out = []
        while end > 0:
            _, token, length = path[end - 1]
            out.append(token)
            end -= length
        out.reverse()
        return out

    def encode(self, text: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.merges.ranks.get(text)) is not None:
            return [whole]
        if len(self.states) > self.limit:
            self.clear()
        at, steps, out, lookahead = 0, self.steps, [], self.lookahead
        path: list[tuple[int, int, int]] = []
        for byte in text:
            step = steps[at].get(byte)
            if step is None:
                step = self._step(at, byte)
            path.append(step)
            at = step[0]
            if len(path) > lookahead and (done := self._settled(at, path)):
                out += self._emit(path, done)
                del path[:done]
        out += self._emit(path, len(path))
        return out


class Utf8Machine:
    """UTF-8 read in arbitrary blocks. The state is the bytes of a character begun: a block's
    end is looked at byte by byte, the whole characters before it are decoded at once. Bytes
    that are not UTF-8 become U+FFFD, as many as the standard asks for."""

    def __init__(self) -> None:
        self.begun = b""

    @staticmethod
    def _cut(block: bytes) -> int:
        """Where a character begins that the block doesn't end."""
        for back in range(1, min(3, len(block)) + 1):
            byte = block[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 1
                return len(block) - back if need > back else len(block)
            if byte < 0x80:
                break
        return len(block)

    def feed(self, block: bytes) -> str:
        block = self.begun + block
        cut = self._cut(block)
        self.begun = block[cut:]
        return block[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        left, self.begun = self.begun, b""
        return left.decode("utf-8", "replace")


class Decoder:
    """Ids to bytes and text, by blocks of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.names = list(map(str, range(len(table))))
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.length = np.fromiter(map(len, table), np.int64, len(table))
        self.start = np.cumsum(self.length) - self.length

    def bytes(self, ids: np.ndarray) -> bytes:
        each = self.length[ids]
        ends = np.cumsum(each)
        return self.flat[np.repeat(self.start[ids] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)].tobytes()

    def decimal(self, ids: np.ndarray) -> str:
        """The ids in decimal, joined by one space."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    def stream(self, ids: np.ndarray, block: int = 1 << 16) -> Iterator[str]:
        machine = Utf8Machine()
        for at in range(0, len(ids), block):
            yield machine.feed(self.bytes(ids[at : at + block]))
        yield machine.close()


_CODERS: dict[tuple[str, str], tuple[tokens.PieceEncoder, Decoder]] = {}


def coder(path: str, pattern: str) -> tuple[tokens.PieceEncoder, Decoder]:
    """An encoder and decoder by a file of ranks, one for each worker process."""
    if (key := (path, pattern)) not in _CODERS:
        import regex

        ranks = tokens.read_ranks(path)
        transducer, matches = Transducer(ranks), regex.compile(pattern).findall

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, counts = array("I"), array("q")
            for piece in pieces:
                before = len(ids)
                for match in [piece] if piece.removeprefix(" ").isalpha() else matches(piece):
                    ids.extend(transducer.encode(match.encode()))
                counts.append(len(ids) - before)
            return np.frombuffer(ids, np.uint32) if ids else np.empty(0, np.uint32), np.frombuffer(counts, np.int64)

        _CODERS[key] = tokens.PieceEncoder(True, encode), Decoder(ranks)
    return _CODERS[key]


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = coder(path, pattern)
        for block in tokens.blocks(batches, "text"):
            ids, at = encoder(block.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), lists], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids of every whole text: each match of ``pattern`` is merged by the ranks in
    the file at ``path``, without special tokens.

    One pass, no shuffle. Defined cases: a null or empty text has no ids; null and repeated
    document ids are rows like any other; an empty table gives none; other columns are not
    looked at.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path, pattern), f"doc_id {rows.schema[0].dataType.simpleString()}, ids array<int>")


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = coder(path, pattern)
        for batch in batches:
            lists = batch.column("ids")
            at, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            texts = ["".join(decoder.stream(ids[a:b])) for a, b in pairwise(at.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of what :func:`encode` returned. Null ids are an empty text."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decode(path, pattern), f"doc_id {rows.schema[0].dataType.simpleString()}, text string")


def _digest(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path, pattern)
        for block in tokens.blocks(batches, "text"):
            ids, at = encoder(block.column("text"))
            n, told, back = np.diff(at), [], []
            for a, b in pairwise(at.tolist()):
                told.append(hashlib.sha256(decoder.decimal(ids[a:b]).encode()).hexdigest())
                text = hashlib.sha256()
                for part in decoder.stream(ids[a:b]):
                    text.update(part.encode())
                back.append(text.hexdigest())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n), pa.array(told), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by spaces) and decoded_sha256
    (of the decoded text's bytes): encoding, decoding and digests in one pass, so that the ids
    never leave the worker. Cases as for :func:`encode`."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_digest(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
