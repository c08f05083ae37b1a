"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits of a fingerprint are dealt into parts, correlated bits into the same one. Two
fingerprints that differ in at most ``tau`` bits differ, in some part i, in at most t_i bits, if
the thresholds t_i (-1: the part isn't used) satisfy sum(t_i + 1) = tau + 1. The number of parts
and their thresholds are those with the least estimated work, by dynamic programming on the
candidates expected in each part at each threshold. Each fingerprint is then put under its own
value in each part, probes the values within the part's threshold, and every candidate is
verified; so the links are exact, whatever the estimates.

Equal fingerprints are one. Values under which many fingerprints lie are dealt into tiles of
bounded size, by counts made before the shuffle. A task verifies its tiles and hands on a forest
of what it has linked, not the pairs. Components are then found by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm import store, tokens
from boxstats.llm.components import components
from boxstats.llm.forest import forest

BITS = 64
#: Fingerprints under one value that one tile holds of either kind.
TILE = 512
#: Fingerprints that the estimates look at; links don't depend on them.
SAMPLE = 2000
#: Candidates that a task verifies at once.
AT_ONCE = 1 << 21
#: Bands, and MinHashes of each, by which texts with similar shingles meet.
BANDS, ROWS = 24, 4
#: Texts of a band that the others are verified against first; links don't depend on it.
PIVOTS = 6
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of a text: A-Z lower-cased, words between ASCII blanks, shingles of words
    (repeats count; of fewer words, the whole sequence; of none, zero), each hashed by XXH64; a
    bit is 1 if it is in over half of the hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > shingle:
        starts, ends = starts[: -shingle + 1] if shingle > 1 else starts, ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), "<u8", len(starts))
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, "text"):
            found = np.array([fingerprint(x, shingle, seed) for x in block.column("text").to_pylist()], np.uint64)
            block = block.drop_columns("text")
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(found.view(np.int64))], [*block.schema.names, "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long) of every row. A null text has no words."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


# --- the plan: parts and thresholds -----------------------------------------------------------


def deal_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal size: each part takes the first bit left and then, one by
    one, the bit that is most correlated with those it has."""
    left, dealt = list(range(len(correlation))), []
    for k in range(parts):
        size = len(left) // (parts - k)
        part = [left.pop(0)]
        while len(part) < size:
            best = max(left, key=lambda b: (sum(correlation[b][x] for x in part), -b))
            left.remove(best)
            part.append(best)
        dealt.append(sorted(part))
    return dealt


def mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(costs: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """The least sum of costs[i][t_i + 1] with sum(t_i + 1) = tau + 1, and its thresholds."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (sum_, chosen) in best.items():
            for extra, c in enumerate(cost):
                to = (sum_ + c, [*chosen, extra - 1])
                if spent + extra <= tau + 1 and to < after.get(spent + extra, (float("inf"), [])):
                    after[spent + extra] = to
        best = after
    return best[tau + 1]


def choose(ones: np.ndarray, sample: np.ndarray, n: int, tau: int) -> list[tuple[int, int, list[int]]]:
    """(threshold, mask, bits) of the parts used. ones[i][j]: fingerprints with bits i and j."""
    mean = np.diag(ones) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    correlation = np.abs(ones / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    best: tuple[float, list] = (float("inf"), [])
    for parts in range(1, tau + 2):
        dealt, costs = deal_bits(correlation, parts), []
        for bits in dealt:
            inside = sample & np.uint64(mask(bits))
            apart = np.zeros(BITS + 1)
            for at in range(0, len(inside), 256):
                apart += np.bincount(np.bitwise_count(inside[at : at + 256, None] ^ inside[None, :]).ravel(), minlength=BITS + 1)
            pairs = max(1, len(inside) * (len(inside) - 1))
            apart[0] -= len(inside)
            cost = [0.0]
            for t in range(tau + 1):
                # two of random bits alike, at least, so that a sample without any isn't none
                share = max(apart[: t + 1].sum() / pairs, sum(comb(len(bits), k) for k in range(t + 1)) / 2.0 ** len(bits))
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                cost.append(n * n / 2 * share + 30.0 * n * probes * (1 + log2(max(2, n)) / 20))
            costs.append(cost)
        total, chosen = allocate(costs, tau)
        best = min(best, (total, [(t, mask(bits), bits) for t, bits in zip(chosen, dealt, strict=True) if t >= 0]), key=lambda x: x[0])
    return best[1]


def _co_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for batch in batches:
        fp = batch.column("fp").to_numpy().astype(np.int64)
        for at in range(0, len(fp), 1 << 14):
            bits = np.unpackbits(fp[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
    cells = np.arange(BITS * BITS)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel().astype(np.int64))], ["cell", "n"])


# --- candidates -------------------------------------------------------------------------------


def _entries(plan: list[tuple[int, int, list[int]]]):
    """Rows (part, value, own, fp): each fingerprint under its own value and those it probes."""
    flips = []
    for t, inside, bits in plan:
        own = [(0, True)]
        own += [(mask(list(c)), False) for k in range(1, t + 1) for c in combinations(bits, k)]
        flips.append((inside, np.array([f for f, _ in own], np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            for at in range(0, len(all_), 2000):
                fp = all_[at : at + 2000]
                for part, (inside, flip) in enumerate(flips):
                    value = ((fp & np.uint64(inside))[:, None] ^ flip).ravel().view(np.int64)
                    own = np.tile(np.arange(len(flip)) == 0, len(fp))
                    rows = [pa.array(np.full(len(value), part, np.int32)), pa.array(value), pa.array(own), pa.array(np.repeat(fp, len(flip)).view(np.int64))]
                    yield pa.RecordBatch.from_arrays(rows, ["part", "value", "own", "fp"])

    return run


def _pairs(others: np.ndarray, first: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (x, y) in runs of about ``most``: row x with ``others`` rows from ``first`` on."""
    ends, at = np.cumsum(others), 0
    while at < len(others):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        n = others[at:to]
        x = np.repeat(np.arange(at, to), n)
        yield x, np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:to], n)
        at = to


def link_tiles(tile: np.ndarray, a: np.ndarray, b: np.ndarray, fp: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among rows sorted by tile, those on its right side (b) first. a:
    the row stands on the left side."""
    starts = np.concatenate(([0], np.flatnonzero(np.diff(tile)) + 1))
    sizes = np.diff(np.concatenate((starts, [len(tile)])))
    rights = np.add.reduceat(b.astype(np.int64), starts)
    run_of = np.repeat(np.arange(len(sizes)), sizes)
    others = np.where(a, rights[run_of], 0)
    found_x, found_y = [], []
    for x, y in _pairs(others, starts[run_of], AT_ONCE):
        u, v = fp[x], fp[y]
        good = u != v
        good[good] = np.bitwise_count((u[good] ^ v[good]).view(np.uint64)) <= tau
        if good.any():
            x, y = forest(u[good], v[good])
            found_x.append(x)
            found_y.append(y)
    if not found_x:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(found_x), np.concatenate(found_y))


def _verify(tau: int, flush: int = 200_000):
    """Reads rows sorted by (part, value, x, y, right first), whole tiles at a time."""

    def links(batch: pa.Table) -> pa.RecordBatch | None:
        columns = [batch.column(c).to_numpy() for c in ("part", "value", "x", "y")]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        x, y = link_tiles(np.cumsum(new), batch.column("side").to_numpy() != 1, batch.column("right").to_numpy(), batch.column("fp").to_numpy(), tau)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"]) if len(x) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < flush:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = [table.column(c).to_numpy() for c in ("part", "value", "x", "y")]
            last = np.ones(rows, bool)
            for k in keys:
                last &= k == k[-1]
            cut = rows - int(last[::-1].argmin()) if not last.all() else 0  # the last tile may go on
            if cut:
                if (out := links(table.slice(0, cut))) is not None:
                    yield out
                held = table.slice(cut).to_batches()
                rows -= cut
        if rows:
            if (out := links(pa.Table.from_batches(held).combine_chunks())) is not None:
                yield out

    return run


def link(distinct: DataFrame, tau: int = 4) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect all of ``distinct`` (column fp, each once,
    written) that differ in at most ``tau`` bits."""
    n = distinct.count()
    ones = np.zeros(BITS * BITS)
    for cell, k in distinct.mapInArrow(_co_ones, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        ones[cell] = k
    sample = np.array([r[0] for r in distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()], np.int64).view(np.uint64)
    plan = choose(ones.reshape(BITS, BITS), sample, n, tau)
    entries = distinct.select("fp").mapInArrow(_entries(plan), "part int, value long, own boolean, fp long")
    crowded = entries.groupBy("part", "value").agg(F.count("*").alias("rows"), F.count(F.when(F.col("own"), 1)).alias("owners")).where(f"rows > {TILE} and owners > 0")
    crowded = store.keep(crowded.select("part", "value", F.ceil(F.col("rows") / TILE).cast("int").alias("lefts"), F.ceil(F.col("owners") / TILE).cast("int").alias("rights")), "simhash-crowded")
    # In a crowded value each row is on the left in one strip of tiles, each owner on the right
    # in another; elsewhere a row is on both sides of the only tile.
    where = entries.join(crowded, ["part", "value"], "left")
    deal = F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("lefts", F.lit(1))).cast("int")
    deal_own = F.pmod(F.xxhash64("fp", F.lit(2)), F.coalesce("rights", F.lit(1))).cast("int")
    left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda y: F.struct(deal.alias("x"), y.alias("y"), F.lit(0).alias("side")))
    right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda x: F.struct(x.alias("x"), deal_own.alias("y"), F.lit(1).alias("side")))
    both = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(2).alias("side")))
    tiles = F.when(F.col("lefts").isNull(), both).when(F.col("own"), F.concat(left, right)).otherwise(left)
    dealt = where.select("part", "value", "own", "fp", F.inline(tiles)).select("part", "value", "x", "y", "side", (F.col("own") & (F.col("side") != 0)).alias("right"), "fp")
    dealt = dealt.repartition("part", "value", "x", "y").sortWithinPartitions("part", "value", "x", "y", F.desc("right"))
    return dealt.mapInArrow(_verify(tau), "a long, b long")


def near_duplicates(docs: DataFrame, tau: int = 4, shingle: int = 4, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest document id
    connected by fingerprints that differ in at most ``tau`` bits) of every row.

    Defined cases: a null, empty or blank text has the fingerprint zero, which links like any
    other; rows of one document id are all returned; a null document id doesn't name a component
    (one of null ids alone has null); an empty table gives none; other columns are not looked at.
    """
    spark = docs.sparkSession
    marked = store.keep(fingerprints(docs, shingle, seed, id_column, text_column), "simhash-documents")
    distinct = store.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    stars = store.keep(components(link(distinct, tau)), "simhash-stars")
    joined = distinct.join(stars.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "least", F.coalesce("component_id", "fp").alias("root"))
    least = store.keep(joined.groupBy("root").agg(F.min("least").alias("component")), "simhash-least")  # else a root's rows are one task's
    named = store.keep(joined.join(least, "root").select("fp", "component"), "simhash-named")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(named, "fp").select("doc_id", digits, F.col("component").alias("component_id"))


def representatives(docs: DataFrame, tau: int = 4, shingle: int = 4, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one of each group of near-duplicates
    stays: the one of the smallest document id (nulls last; then by a hash of the row). Of rows alike
    in all columns one stays.

    Texts are shuffled by id only against the rows that go, and not at all while Spark can
    broadcast those.
    """
    key = F.col(f"`{id_column}`").cast("long")
    rows = docs.select(key.alias("doc_id"), F.col(text_column).cast("string").alias("text"), _whole(docs).alias("hash")).select("doc_id", "hash", "text")
    marked = store.keep(rows.mapInArrow(_fingerprints(shingle, seed), "doc_id long, hash long, fp long"), "simhash-documents")
    distinct = store.keep(marked.groupBy("fp").agg(F.count("*").alias("rows")), "simhash-distinct")
    stars = store.keep(components(link(distinct, tau)), "simhash-stars")
    rooted = marked.join(stars.withColumnRenamed("id", "fp"), "fp", "left").select("doc_id", "hash", F.coalesce("component_id", "fp").alias("root"))
    return _firsts(docs, store.keep(rooted, "simhash-rooted"), id_column)


def _whole(docs: DataFrame) -> Column:
    """A hash of a row's columns; a document is known by its id and this."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))


def _firsts(docs: DataFrame, rooted: DataFrame, id_column: str) -> DataFrame:
    """One row of ``docs`` of each root; rooted: doc_id, hash (of the row) and root of all rows."""
    # The first of each root is written, so that the join is one that Spark can split: a root's rows
    # may be a third of all.
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first"))
    first = store.keep(first.select(F.col("root").alias("of"), F.col("first.doc_id").alias("first_id"), F.col("first.hash").alias("first_hash")), "simhash-firsts")
    lost = rooted.join(first, F.col("root") == F.col("of")).where(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))))
    lost_id, lost_hash = store.free(docs, "lost_id", "lost_hash")
    lost = store.keep(lost.select(F.col("doc_id").alias(lost_id), F.col("hash").alias(lost_hash)).distinct(), "simhash-lost")
    key, whole = F.col(f"`{id_column}`").cast("long"), _whole(docs)
    kept = docs.join(lost, key.eqNullSafe(F.col(f"`{lost_id}`")) & (whole == F.col(f"`{lost_hash}`")), "left_anti")
    if rooted.groupBy("doc_id", "hash").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumns({lost_id: key, lost_hash: whole}).dropDuplicates([lost_id, lost_hash]).drop(lost_id, lost_hash)


# --- near-duplicates by the shingles themselves -----------------------------------------------


def shingles(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; words and shingles as for fingerprints."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    n = max(1, len(words) - shingle + 1) if words else 0
    return np.unique(np.fromiter((xxh64_intdigest(b" ".join(words[i : i + shingle]), seed) for i in range(n)), np.uint64, n))


def bands(hashes: np.ndarray, n: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash of each band of ``rows`` MinHashes; none of no shingles."""
    if not len(hashes):
        return np.empty(0, np.int64)
    mixed = np.random.default_rng(7).integers(0, 2**63, (n * rows, 2), np.uint64)
    least = np.array([((hashes ^ a) * (b | np.uint64(1)) >> np.uint64(20)).min() for a, b in mixed], np.uint64).reshape(n, rows)
    value = np.zeros(n, np.uint64)
    for column in least.T:
        value = (value ^ column) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def _banded(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for block in tokens.blocks(batches, "text"):
            sets = [shingles(x, shingle, seed) for x in block.column("text").to_pylist()]
            names = np.array([xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("hash"), pa.array(names), pa.array([bands(x) for x in sets], pa.list_(pa.int64()))], ["doc_id", "hash", "name", "bands"])

    return run


def _each_shingle(shingle: int, seed: int):
    """Of rows (name, root, text): a row for each distinct shingle, with how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, "text", 1 << 20):
            sets = [shingles(x, shingle, seed) for x in block.column("text").to_pylist()]
            sizes = np.array(list(map(len, sets)), np.int64)
            which = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays([block.column("name").take(which), block.column("root").take(which), pa.array(np.repeat(sizes, sizes).astype(np.int32)), pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))], ["name", "root", "size", "token"])

    return run


def _alike(shingle: int, seed: int, similarity: float):
    """Of rows (a, b, text_a, text_b) sorted by a, the pairs similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, left = a, shingles(batch.column("text_a")[i].as_py(), shingle, seed)
                right = shingles(batch.column("text_b")[i].as_py(), shingle, seed)
                both = len(np.intersect1d(left, right, assume_unique=True))
                good[i] = both >= similarity * (len(left) + len(right) - both) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def candidates(rows: DataFrame, distinct: DataFrame, tau: int = 4, seed: int = 42) -> DataFrame:
    """Pairs (a < b) of names that connect all texts whose fingerprints link. rows: doc_id, hash, text;
    distinct: the name and one hash of each text."""
    marked = rows.mapInArrow(_fingerprints(4, seed), "doc_id long, hash long, fp long").select("hash", "fp")
    named = store.keep(marked.join(distinct, "hash").select("name", "fp").distinct(), "simhash-names")
    first = store.keep(named.groupBy("fp").agg(F.min("name").alias("pivot")), "simhash-distinct")
    equal = named.join(first, "fp").select("name", "pivot")
    ends = [first.select(F.col("fp").alias(c), F.col("pivot").alias(f"pivot_{c}")) for c in ("a", "b")]
    near = link(first.select("fp"), tau).join(ends[0], "a").join(ends[1], "b").select("pivot_a", "pivot_b")
    return equal.union(near).where("name <> pivot").select(F.least("name", "pivot").alias("a"), F.greatest("name", "pivot").alias("b")).distinct()


def similar_representatives(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, seed: int = 42, id_column: str = "doc_id", text_column: str = "text", tau: int = 4) -> DataFrame:
    """As ``representatives``, with groups connected by texts whose sets of shingles have a Jaccard
    similarity of at least ``similarity``; texts without words are alike.

    Candidates are the texts whose SimHash fingerprints link (at most ``tau`` bits apart, found as
    for ``near_duplicates``). At 0.8 some ten of 64 bits differ, so others come from bands of
    MinHashes: of pairs of 0.8 all but 3 in a million meet. Each link is verified by the shingles,
    so it depends on neither. A band's texts are first verified against a few of them;
    then those that this hasn't connected, where they share one of their rarest shingles, which
    leaves out none.
    """
    key = F.col(f"`{id_column}`").cast("long")
    rows = docs.select(key.alias("doc_id"), F.col(text_column).cast("string").alias("text"), _whole(docs).alias("hash"))
    marked = store.keep(rows.select("doc_id", "hash", "text").mapInArrow(_banded(shingle, seed), "doc_id long, hash long, name long, bands array<long>"), "similar-documents")
    distinct = marked.groupBy("name").agg(F.min("hash").alias("hash"))
    banded = marked.join(distinct, ["name", "hash"]).dropDuplicates(["name"]).select("name", F.posexplode("bands").alias("band", "value"))
    crowd = banded.groupBy("band", "value").agg(F.array_distinct(F.array(*[F.min(F.struct(F.xxhash64("name", F.lit(i)), "name")).getField("name") for i in range(PIVOTS)])).alias("pivots"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = store.keep(banded.join(crowd, ["band", "value"]), "similar-bands")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = store.keep(pairs.distinct(), "similar-pairs")
        names = pairs.select(F.col("a").alias("name")).union(pairs.select(F.col("b").alias("name"))).distinct()
        texts = store.keep(rows.select("hash", "text").join(distinct.join(names, "name"), "hash").dropDuplicates(["name"]).select("name", "text"), "similar-texts")
        a, b = (texts.select(F.col("name").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
        met = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").sortWithinPartitions("a")
        return store.keep(met.mapInArrow(_alike(shingle, seed, similarity), "a long, b long"), "similar-links")

    alike = candidates(rows.select("doc_id", "hash", "text"), distinct, tau, seed)
    links = verified(members.select("name", F.explode("pivots").alias("pivot")).where("name <> pivot").select(F.least("name", "pivot").alias("a"), F.greatest("name", "pivot").alias("b")).union(alike))
    stars = store.keep(components(links), "similar-stars")
    apart = members.join(stars.withColumnRenamed("id", "name"), "name", "left").select("band", "value", "name", F.coalesce("component_id", "name").alias("root"))
    # Texts of a band that aren't connected may be many that share a passage and no more. Two sets of
    # this similarity have a shingle in common among the rarest of each, as many as they may differ
    # in and one more; so such texts meet by those, not pair by pair.
    several = apart.groupBy("band", "value").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("band", "value")
    several = store.keep(several, "similar-several")
    left = store.keep(apart.join(several, ["band", "value"]).select("name", "root").distinct(), "similar-left")
    texts = rows.select("hash", "text").join(distinct.join(left, "name"), "hash").select("name", "root", "text").dropDuplicates(["name"])
    each = store.keep(texts.mapInArrow(_each_shingle(shingle, seed), "name long, root long, size int, token long"), "similar-shingles")
    often = store.keep(each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "similar-often")
    place = F.row_number().over(Window.partitionBy("name").orderBy("n", "token"))
    ranked = each.join(often, "token", "left").withColumn("n", F.coalesce("n", F.lit(1))).withColumn("place", place)
    rarest = store.keep(ranked.where((F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1) & (F.col("n") > 1)).select("token", "name", "root", "size", "place"), "similar-rarest")
    # Of two that aren't connected, one at least isn't in the largest group that has the shingle.
    sizes = rarest.groupBy("token", "root").agg(F.count("*").alias("n"))
    large = sizes.groupBy("token").agg(F.max(F.struct("n", "root")).getField("root").alias("large"), F.count("*").alias("roots")).where("roots > 1")
    large = store.keep(large.select("token", "large"), "similar-large")
    other = rarest.select("token", F.col("name").alias("other"), F.col("root").alias("other_root"), F.col("size").alias("other_size"), F.col("place").alias("other_place"))
    met = rarest.join(large, "token").where("root <> large").join(other, "token").where("root <> other_root")
    # The first shingle in common has this many behind it at most; so many must be common.
    most = 1 + F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    met = met.where(most >= (F.col("size") + F.col("other_size")) * (similarity / (1 + similarity)) - 1e-9)
    more = verified(met.select(F.least("name", "other").alias("a"), F.greatest("name", "other").alias("b")))
    stars = store.keep(components(links.union(more)), "similar-stars")
    rooted = marked.join(stars.withColumnRenamed("id", "name"), "name", "left").select("doc_id", "hash", F.coalesce("component_id", "name").alias("root"))
    return _firsts(docs, store.keep(rooted, "similar-rooted"), id_column)
