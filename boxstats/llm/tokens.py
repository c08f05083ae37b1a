"""Whole-text tokenization through a memo of pieces that are tokenized alone.

Both vocabularies split a text by a pattern before any merge is looked at, and no match of the
pattern spans a change from non-blank to blank characters other than one leading space. So a
text is cut into such pieces, each distinct piece is encoded once by the library, and a text's
ids are the pieces' ids in a row. Pieces recur so often that this is several times as fast as
encoding whole texts, with the same ids.
"""

from __future__ import annotations

import base64
import ctypes
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White_Space of Unicode, which the libraries' ``\s`` stands for (Python's has four more).
BLANK = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
#: A word with its leading space, the part of a blank run before the last blank, or one blank.
_SPACED = re.compile(rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]").findall
_WORDS = re.compile(rf"[^{BLANK}]+").findall
#: Texts that cutting at single spaces and line ends would cut wrongly (in RE2).
_ODD = r"^[ \n]|[ \n]$|[ \n][ \n]|[\x00\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MARKS = frozenset(".,;:!?")
BLOCK_BYTES = 4 << 20
#: Words merged at once, and characters of the longest of them.
AT_ONCE = 20_000


def blocks(batches: Iterable[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of about ``most`` bytes of text, so that memory doesn't follow the
    number of rows that Spark puts into a batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
        del batch
    _give_back()


def _give_back() -> None:
    """Free memory goes back to the system: worker processes live on for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class _Store:
    """Pieces by name and their ids in one array: memo[piece] is begin << 24 | number of ids."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids, self.size = np.empty(1 << 12, np.uint32), 0

    def add(self, ids: np.ndarray) -> int:
        """Appends ids; where they begin."""
        begin, self.size = self.size, self.size + len(ids)
        if self.size > len(self.ids):
            grown = np.empty(max(self.size, 2 * len(self.ids)), np.uint32)
            grown[:begin] = self.ids[:begin]
            self.ids = grown
        self.ids[begin : self.size] = ids
        return begin

    def name(self, pieces: list[str], begin: int, lengths: np.ndarray) -> np.ndarray:
        """Names successive runs of ids, and gives their codes."""
        codes = (begin + np.cumsum(lengths, dtype=np.int64) - lengths) << 24 | lengths
        self.memo.update(zip(pieces, codes.tolist(), strict=True))
        return codes


def runs(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... of ``length[i]`` places, for all i in a row."""
    ends = np.cumsum(length, dtype=np.int64)
    return np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


class PieceEncoder:
    """Encodes texts to unsigned 32-bit ids.

    leading_space: a piece is a word with the space before it, or blanks (byte-level
    vocabularies); otherwise words alone (blanks give no ids). encode gives all ids of pieces in
    a row and how many each has. lower: the vocabulary ignores the case of A-Z. A mark after a
    letter is a match of its own in both patterns, so a new piece that ends so is put together
    from the two.

    The memo has two generations of ``limit`` pieces: what isn't met in the time that the younger
    one takes to fill is forgotten. Results don't depend on it.
    """

    def __init__(self, leading_space: bool, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], lower: bool = False, limit: int = 500_000, longest: int = 64):
        self.leading_space, self.encode, self.lower, self.limit, self.longest = leading_space, encode, lower, limit, longest
        self.young, self.old = _Store(), _Store()

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces in a row, and where each text's begin (with the end)."""
        odd = pc.match_substring_regex(texts, _ODD)
        plain = pc.if_else(odd, "", texts)
        if self.lower:
            plain = pc.ascii_lower(plain)
        if self.leading_space:
            plain = pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n\0")
        else:
            plain = pc.replace_substring(pc.replace_substring(plain, " ", "\0"), "\n", "\0")
        lists = pc.split_pattern(plain, "\0")
        if pc.any(odd).as_py():
            rows, way = lists.to_pylist(), _SPACED if self.leading_space else _WORDS
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
                rows[i] = way(texts[i].as_py())
            lists = pa.array(rows, pa.list_(pa.string()))
        offsets = lists.offsets.to_numpy()
        return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]

    def _codes(self, pieces: list[str]) -> np.ndarray:
        """Codes in the young store of those that either generation has; -1 for others."""
        young, old = self.young, self.old
        codes = np.array(list(map(young.memo.get, pieces, repeat(-1))), np.int64)
        if old.memo and len(missing := np.flatnonzero(codes < 0)):
            names = [pieces[i] for i in missing.tolist()]
            before = np.array(list(map(old.memo.get, names, repeat(-1))), np.int64)
            known = np.flatnonzero(before >= 0)
            lengths = before[known] & 0xFFFFFF
            begin = young.add(old.ids[runs(before[known] >> 24, lengths)])
            codes[missing[known]] = young.name([names[i] for i in known.tolist()], begin, lengths)
        return codes

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Codes of new pieces."""
        ids, lengths = self.encode(pieces)
        return self.young.name(pieces, self.young.add(ids), lengths)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (with the end). A null is empty."""
        pieces, offsets = self.cut(pc.fill_null(texts.cast(pa.string()), ""))
        coded = pieces.dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.young.memo) > self.limit or self.young.size > 8 * self.limit:
            self.young, self.old = _Store(), self.young
        codes = self._codes(distinct)
        missing = np.flatnonzero(codes < 0)
        new = [distinct[i] for i in missing.tolist()]
        marked = np.array([x[-1:] in MARKS and x[-2:-1].isalpha() for x in new], bool)
        whole = [new[i] for i in np.flatnonzero(~marked).tolist()]
        if whole:
            codes[missing[~marked]] = self._learn(whole)
        both = [part for i in np.flatnonzero(marked).tolist() for part in (new[i][:-1], new[i][-1])]
        if both:
            parts = self._codes(both)
            names = list(dict.fromkeys(both[i] for i in np.flatnonzero(parts < 0).tolist()))
            if names:
                self._learn(names)
                parts = self._codes(both)
            lengths = parts & 0xFFFFFF
            begin = self.young.add(self.young.ids[runs(parts >> 24, lengths)])
            codes[missing[marked]] = self.young.name([new[i] for i in np.flatnonzero(marked).tolist()], begin, lengths.reshape(-1, 2).sum(1))
        for x in new:
            if len(x) > self.longest:
                del self.young.memo[x]
                self.young.memo.pop(x[:-1], None)
        each = (codes & 0xFFFFFF)[which]
        ends = np.cumsum(each, dtype=np.int32)  # a block has far fewer ids
        begins = (codes >> 24).astype(np.int32)[which]
        places = np.repeat(begins - ends + each.astype(np.int32), each)
        places += np.arange(len(places), dtype=np.int32)
        return self.young.ids[places], np.concatenate(([0], ends))[offsets]


class Merger:
    """Byte-level merges of a vocabulary of the tokenizers library, of many words at once.

    Words stand in one array of symbols. In each round every word's pair of the lowest rank, the
    leftmost of them, becomes one symbol, until no word has a pair with a merge. Merges are found
    by a table of open addresses.
    """

    NONE = np.int32(2**31 - 1)

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        letters = byte_letters()
        self.first = np.array([vocabulary.get(chr(letters[b]), 0) for b in range(256)], np.int32)
        self.last = np.array([vocabulary.get(chr(letters[b]) + suffix, 0) for b in range(256)], np.int32)
        keys = np.array([vocabulary[a] << 16 | vocabulary[b] for a, b in merges], np.uint64)
        self.bits = 2 + len(merges).bit_length()
        self.key, self.rank, self.made = np.full(1 << self.bits, 2**63, np.uint64), np.full(1 << self.bits, self.NONE, np.int32), np.zeros(1 << self.bits, np.int32)
        places, self.steps = self._place(keys), 1
        for rank, ((a, b), key, at) in enumerate(zip(merges, keys.tolist(), places.tolist(), strict=True)):
            steps = 1
            while self.key[at] not in (2**63, key):
                at, steps = (at + 1) & ((1 << self.bits) - 1), steps + 1
            if self.key[at] == 2**63:
                self.key[at], self.rank[at], self.made[at] = key, rank, vocabulary[a + b]
            self.steps = max(self.steps, steps)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair's merge (NONE: there is none), and the symbol it makes."""
        keys = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        at = self._place(keys)
        good = self.key[at] == keys
        rank, made = np.where(good, self.rank[at], self.NONE), self.made[at]
        open_ = np.flatnonzero(~good & (self.key[at] != 2**63))
        for _ in range(self.steps - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            here = self.key[at[open_]]
            good = here == keys[open_]
            rank[open_[good]], made[open_[good]] = self.rank[at[open_[good]]], self.made[at[open_[good]]]
            open_ = open_[~good & (here != 2**63)]
        return rank, made

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each word (none empty) has."""
        raw = np.frombuffer("".join(words).encode(), np.uint8)
        sizes = np.fromiter((len(x) if x.isascii() else len(x.encode()) for x in words), np.int64, len(words))
        symbols = self.first[raw]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[raw[ends]]
        counts, done = sizes.copy(), np.empty(0)
        word = np.arange(len(words))  # of the words still open
        out: list[tuple[np.ndarray, np.ndarray]] = []  # words that are done, and their symbols
        rank, made = np.full(len(symbols), self.NONE), np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            rank[:-1], made[:-1] = self._find(symbols[:-1], symbols[1:])
            rank[ends] = self.NONE
        while len(word):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, starts)
            open_ = least != self.NONE
            if not open_.all():
                inside = np.repeat(open_, sizes)
                counts[word[~open_]] = sizes[~open_]
                out.append((np.repeat(word[~open_], sizes[~open_]), symbols[~inside]))
                word, sizes, least = word[open_], sizes[open_], least[open_]
                symbols, rank, made = symbols[inside], rank[inside], made[inside]
                if not len(word):
                    break
            of = np.repeat(np.arange(len(word)), sizes)
            at = np.flatnonzero(rank == least[of])
            at = at[np.concatenate(([True], of[at][1:] != of[at][:-1]))]
            symbols[at] = made[at]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, rank, made = symbols[stays], rank[stays], made[stays]
            at -= np.arange(len(at))
            sizes = sizes - 1
            ends = np.cumsum(sizes) - 1
            begins = ends - sizes + 1
            for near, fine in ((at, at < ends), (at - 1, at > begins)):
                near = near[fine]
                rank[near], made[near] = self._find(symbols[near], symbols[near + 1])
            rank[ends] = self.NONE
        of, flat = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (done, done)
        return flat[np.argsort(of, kind="stable")].astype(np.uint32), counts


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: a printable one for
    itself, the others, in order, from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


_ENCODERS: dict[tuple, PieceEncoder] = {}


def library_encoder(path: str, leading_space: bool) -> PieceEncoder:
    """An encoder by a file of the tokenizers library, one for each worker process.

    Special tokens' strings are ordinary text. Pieces of one match go to the library's merges
    directly, others through the whole library.
    """
    if (key := (path, leading_space)) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "false", "1"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True

        model = json.loads(library.to_str())["model"]
        merge = Merger(model["vocab"], [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]], model["end_of_word_suffix"] or "")
        lowers = library.normalizer is not None

        def one_match(piece: str) -> bool:
            """Letters alone (and the space before) that the library's first steps don't change."""
            if leading_space:
                return piece.removeprefix(" ").isalpha()
            return piece.isalpha() and (not lowers or (piece == piece.lower() and is_normalized("NFC", piece)))

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            alone = np.array([len(x) <= AT_ONCE and one_match(x) for x in pieces], bool)
            ids, counts = [np.empty(0, np.uint32)], np.zeros(len(pieces), np.int64)
            rows = np.flatnonzero(alone)
            for at in range(0, len(rows), AT_ONCE):
                part = rows[at : at + AT_ONCE]
                found, counts[part] = merge([pieces[i] for i in part.tolist()])
                ids.append(found)
            others = np.flatnonzero(~alone)
            for at in range(0, len(others), 1000):
                part = others[at : at + 1000]
                lists = [x.ids for x in library.encode_batch_fast([pieces[i] for i in part.tolist()], add_special_tokens=False)]
                counts[part] = list(map(len, lists))
                ids.append(np.fromiter(chain.from_iterable(lists), np.uint32, counts[part].sum()))
            order = np.concatenate((rows, others))
            begin = np.empty(len(pieces), np.int64)
            begin[order] = np.cumsum(counts[order]) - counts[order]
            return np.concatenate(ids)[runs(begin, counts)], counts

        _ENCODERS[key] = PieceEncoder(leading_space, encode, lowers)
    return _ENCODERS[key]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
