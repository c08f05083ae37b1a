"""Best-fit packing of documents into sequences, by bin completion.

A sequence holds ``capacity`` tokens. Only how many pieces there are of each length matters for
how many sequences are needed, so the search runs over a histogram of at most ``capacity``
lengths, whatever the number of documents: bin completion takes the largest length left,
enumerates the undominated ways to fill up its sequence, uses a way as often as the pieces
last (or less often), and goes on; it branches over the ways, in the order of their
discrepancies, prunes a branch when the space wasted so far can't beat the incumbent, and starts
from the best-fit-decreasing packing as the incumbent. The plan then says, for each length, which ranks of its pieces go where, and
every piece looks up its place by its rank.

Defined cases: a null or empty text has only the end id; null and repeated document ids are
packed like any other row (a piece is known by its row, not by its id); an empty table gives
an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm import store, tokens

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"


# --- the search -------------------------------------------------------------------------------


def best_fit(counts: list[int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing on a histogram: (how often, lengths in the sequence), ...

    Pieces of one length go to open sequences of the tightest space, as many as fit, and then
    to new ones; sequences filled alike are kept as one entry.
    """
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    spaces: list[int] = []  # of open_, sorted

    def add(space: int, times: int, held: tuple[int, ...]) -> None:
        if space not in open_:
            open_[space] = []
            spaces.insert(int(np.searchsorted(spaces, space)), space)
        open_[space].append((times, held))

    for length in range(capacity, 0, -1):
        left = counts[length]
        while left:
            at = int(np.searchsorted(spaces, length))
            if at < len(spaces):
                space = spaces[at]
                times, held = open_[space].pop()
                if not open_[space]:
                    del open_[space], spaces[at]
            else:
                space, times, held = capacity, left, ()
            each = space // length
            full = min(times, left // each)
            if full:
                add(space - each * length, full, held + (length,) * each)
                left -= full * each
            rest, fresh = times - full, not held
            if left and rest and left < each:
                add(space - left * length, 1, held + (length,) * left)
                rest, left = rest - 1, 0
            if rest and not fresh:
                add(space, rest, held)
    return [x for groups in open_.values() for x in groups]


def fillings(counts: np.ndarray, space: int) -> list[tuple[int, ...]]:
    """Of the fillings with one, two and three pieces, from the largest piece down, one each of the
    least waste (of those, with the largest first piece); none that wastes as much as one with
    fewer pieces does, which dominates it."""
    there = np.flatnonzero(counts[1 : space + 1]) + 1
    if not len(there):
        return []
    below = np.zeros(space + 1, np.int64)  # the largest length up to each
    below[there] = there
    np.maximum.accumulate(below, out=below)
    found = [(int(below[space]),)]

    def next_(most: np.ndarray, *used: np.ndarray) -> np.ndarray:
        """The largest length up to ``most`` of which a piece is left when one of each of ``used`` is taken."""
        c = below[np.maximum(most, 0)]
        taken = sum((u == c).astype(np.int64) for u in used)
        return np.where((taken > 0) & (counts[c] <= taken), below[np.maximum(c - 1, 0)], c)

    a = there
    b = next_(np.minimum(a, space - a), a)
    sums = np.where(b > 0, a + b, 0)
    at = len(sums) - 1 - int(sums[::-1].argmax())
    if sums[at] > sum(found[-1]):
        found.append((int(a[at]), int(b[at])))
    if sum(found[-1]) < space:
        i, j = np.nonzero((a[:, None] >= a) & (a[:, None] + a < space) & ((a[:, None] > a) | (counts[a] > 1)[:, None]))
        first, second = a[i], a[j]
        third = next_(np.minimum(second, space - first - second), first, second)
        sums = np.where(third > 0, first + second + third, 0)
        at = len(sums) - 1 - int(sums[::-1].argmax()) if len(sums) else 0
        if len(sums) and sums[at] > sum(found[-1]):
            found.append((int(first[at]), int(second[at]), int(third[at])))
    return found


def filled(counts: np.ndarray, space: int, price: float) -> list[tuple[int, ...]]:
    """Ways to fill ``space`` so that nothing more fits, by their waste and a price of each piece
    after the first: small pieces are worth more later, when less is left to choose from."""
    out = []
    for held in fillings(counts, space):
        left = space - sum(held)
        while left > 0:
            for x in held:
                counts[x] -= 1
            more = min(fillings(counts, left), key=lambda f: left - sum(f) + price * len(f), default=())
            for x in held:
                counts[x] += 1
            if not more:
                break
            held, left = (*held, *more), left - sum(more)
        out.append((left + price * (len(held) - 1), tuple(sorted(held, reverse=True))))
    return [held for _, held in sorted(out, key=lambda x: (x[0], len(x[1])))]


def every_filling(counts: np.ndarray, space: int, more: Callable[[], bool]) -> Iterator[tuple[int, ...]]:
    """All undominated ways to fill ``space``: nothing more fits, no larger piece could stand for
    one of them, and no piece for two of them, without going beyond the space. Each step asks
    whether there may be more."""
    used: dict[int, int] = {}

    def left(low: int, high: int) -> bool:
        return any(counts[x] > used.get(x, 0) for x in range(max(1, low), high + 1))

    def dominated(held: tuple[int, ...], waste: int) -> bool:
        if any(left(a + 1, a + waste) for a in held):
            return True
        return any(left(a + b, a + b + waste) for i, a in enumerate(held) for b in held[i + 1 :])

    def fill(room: int, most: int, held: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if not left(1, room):
            if not dominated(held, room):
                yield held
            return
        for x in range(min(room, most), 0, -1):
            if counts[x] > used.get(x, 0) and more():
                used[x] = used.get(x, 0) + 1
                yield from fill(room - x, x, (*held, x))
                used[x] -= 1

    yield from fill(space, space, ())


def complete(counts: list[int], capacity: int, nodes: int = 20_000, prices: tuple[float, ...] = (8, 2, 32, 0)) -> tuple[list[tuple[int, tuple[int, ...]]], bool]:
    """A packing with as few sequences as the search finds: (how often, lengths), ...; and whether
    it is known that fewer don't do.

    counts: pieces by length, 0 to capacity. Bin completion: the largest piece left is taken, the
    ways to fill up its sequence are the branches, each used as often as the pieces last, half as
    often, or once; a branch is left when the space wasted so far can't be made good by any
    packing better than the incumbent (best-fit decreasing at first). The branches are visited in
    the order of their discrepancies, the times that another than the first way is taken: first
    none, by each of the ``prices``, then one, two, four and so on, until nothing was left out.
    ``nodes`` bounds the branches visited (ten steps of enumerating all fillings count as one); the incumbent is always a whole
    packing, so a bound that is reached costs sequences at most, never pieces.
    """
    best = best_fit(counts, capacity)
    fewest = sum(t for t, _ in best)
    total = sum(i * n for i, n in enumerate(counts))
    least = max(-(-total // capacity), sum(counts[capacity // 2 + 1 :]))
    now = np.array(counts, np.int64)

    def more() -> bool:
        nonlocal nodes
        nodes -= 0.1
        return nodes > 0

    def branches(price: float) -> Iterator[tuple[int, tuple[int, ...]]]:
        first = int(np.flatnonzero(now)[-1])
        now[first] -= 1
        ways = filled(now, capacity - first, price) or [()]
        now[first] += 1
        often = {}
        for way in dict.fromkeys(ways):
            held = (first, *way)
            often[way] = most = min(int(now[x]) // held.count(x) for x in set(held))
            yield from ((times, held) for times in dict.fromkeys((most, -(-most // 2), 1)))
        now[first] -= 1
        rest = every_filling(now.copy(), capacity - first, more)
        now[first] += 1
        for way in chain(often, (x for x in rest if x not in often)):
            held = (first, *way)
            most = min(int(now[x]) // held.count(x) for x in set(held))
            done = (most, -(-most // 2), 1) if way in often else ()
            yield from ((times, held) for times in range(most, 0, -1) if times not in done)

    def visit(limit: float, price: float) -> bool:
        """All branches of up to ``limit`` discrepancies; whether there were no others."""
        nonlocal best, fewest, nodes
        whole, chosen, used, waste = True, [], 0, 0
        stack = [[branches(price), limit]] if total else []
        while stack:
            ways, left = stack[-1]
            step = next(ways, None) if left >= 0 else None
            if step is None or nodes <= 0 or fewest <= least:
                whole &= step is None and left >= 0 and nodes > 0
                stack.pop()
                if chosen:
                    times, held = chosen.pop()
                    used, waste = used - times, waste - times * (capacity - sum(held))
                    for x in held:
                        now[x] += times
                continue
            stack[-1][1] -= 1
            times, held = step
            nodes -= 1
            lost = times * (capacity - sum(held))
            if used + times >= fewest or waste + lost > (fewest - 1) * capacity - total:
                continue
            for x in held:
                now[x] -= times
            chosen.append(step)
            used, waste = used + times, waste + lost
            if now.any():
                stack.append([branches(price), left])
            else:
                best, fewest = list(chosen), used
                stack.append([iter(()), 0])
        return whole

    whole, limit = fewest <= least, 0
    while not whole and nodes > 0 and fewest > least:
        for price in prices if not limit else prices[:1]:
            whole = whole or visit(limit, price)
        limit = 2 * limit or 1
    return best, whole or fewest <= least


def places(plan: list[tuple[int, tuple[int, ...]]], capacity: int) -> dict[str, np.ndarray]:
    """The plan by length: the pieces of ranks from ``key`` on (length << 44 | rank) go to
    sequences ``sequence`` + rank, at ``offset``."""
    taken, rows, base = [0] * (capacity + 1), [], 0
    for times, held in plan:
        offset = 0
        for x in held:
            rows.append((x << 44 | taken[x], base - taken[x], offset))
            taken[x] += times
            offset += x
        base += times
    rows.sort()
    key, sequence, offset = np.array(rows or [(0, 0, 0)], np.int64).T
    return {"key": key, "sequence": sequence, "offset": offset}


# --- Spark ------------------------------------------------------------------------------------


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokens.library_encoder(path, True), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for block in tokens.blocks(batches, "text"):
            ids, at = encode(block.column("text"))
            ids = np.insert(ids, at[1:], end_id).astype("<u4")
            at = at + np.arange(len(at))
            sizes = np.diff(at)
            many = np.maximum(1, -(-sizes // capacity))  # pieces of each document
            row = np.repeat(np.arange(len(sizes)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            first = sizes - (many - 1) * capacity  # the first piece is the short one
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            order = np.argsort(length, kind="stable")
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.searchsorted(length[order], length[order])
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            view, begin = memoryview(ids).cast("B"), at[row] + start
            sums = [crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            columns = [block.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(sums, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(rank)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, begin[-1:] + length[-1:]).astype(np.int32)), pa.array(ids.view(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _place(plan: dict[str, np.ndarray]):
    key, sequence, offset = plan["key"], plan["sequence"], plan["offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence[at] + rank), pa.array(offset[at])], [*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Cut documents into pieces of at most ``capacity`` tokens and place them in sequences.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids
    themselves if asked for. Only documents longer than a sequence are cut; then the first
    piece is the shorter one.

    Pieces are encoded once and kept in the shared folder with their rank among the pieces of
    their length in their task. The driver gets one count for each length (at most
    ``capacity``); ranks in all the table come from one running sum over a row for each task
    and length, so no length, however common, is gathered in one task.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    pieces = store.keep(rows.mapInArrow(_cut(vocabulary, end_id, capacity, with_ids), schema), "packing-pieces")
    tally = store.keep(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-tally")
    counts = [0] * (capacity + 1)
    for length, n in tally.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = places(complete(counts, capacity)[0], capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = tally.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), (F.col("rank") + F.col("base")).alias("rank"))
    out = "doc_id long, piece int, start long, length int, ids_crc32 long" + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place(plan), out).withColumn("length", F.col("length").cast("long"))
