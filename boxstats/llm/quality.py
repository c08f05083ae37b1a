"""Quality rules: plain counts, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted in one pass: one of all documents, one of
trusted ones. A document's score is the log of the ratio of its likelihoods under the trusted
and the raw model, divided by its number of n-grams (plus a few that count as neutral, so that
short texts aren't judged by a handful). Every document is scored, and kept if the score is at
least a fixed threshold and the plain counts pass.

The raw counts cover all documents; the trusted model is fitted on at most ``trusted_most``
labelled documents, the first by a hash of their ids, so that their ids fit a broadcast of known
size. Each task counts into one array and hands on its buckets, which are summed by bucket; the
driver gets one row for each of ``2 ** bits`` buckets. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.llm import tokens

GRAM, BITS = 3, 16
#: Least score, and neutral n-grams added to each text.
THRESHOLD, NEUTRAL = -0.75, 64
#: Labelled documents that the trusted model is fitted on.
TRUSTED_MOST = 200_000
#: N-grams, dealt out as in the raw model, that are added to the trusted one: with few trusted
#: texts the two are alike, and an n-gram that none of them has isn't impossible.
SMOOTHING = 1000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[48:58] = 48
WINDOW = 5


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each text's begin (with the end)."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.string()), "")])
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def _buckets(flat: np.ndarray, gram: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte (none at the last ones); all digits are
    one, since numbers say nothing of a text."""
    flat = _FOLDED[flat]
    n = max(0, len(flat) - gram + 1)
    value = np.zeros(n, np.uint64)
    for k in range(gram):
        value |= flat[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    return ((value * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _count(trusted: np.ndarray, gram: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for block in tokens.blocks(batches, "text"):
            flat, at = _bytes(block.column("text"))
            which = _buckets(flat, gram, bits)
            inside = np.ones(len(which), bool)
            for back in range(1, gram):  # n-grams don't go on into the next text
                ends = at[1:] - back
                inside[ends[(ends >= 0) & (ends < len(which))]] = False
            raw += np.bincount(which[inside], minlength=1 << bits)
            ids = pc.fill_null(block.column("doc_id"), -1).to_numpy(zero_copy_only=False)
            known = np.isin(ids, trusted) & block.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            inside &= np.repeat(known, np.diff(at))[: len(which)]
            good += np.bincount(which[inside], minlength=1 << bits)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], ["bucket", "n_raw", "n_trusted"])

    return run


def fit(docs: DataFrame, trusted: DataFrame, gram: int = GRAM, bits: int = BITS, trusted_most: int = TRUSTED_MOST) -> np.ndarray:
    """The log ratio of each bucket's probabilities; zeros if no trusted document is there.

    docs: doc_id, text. trusted: doc_id.
    """
    ids = trusted.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct().orderBy(F.xxhash64("doc_id")).limit(trusted_most)
    known = np.sort(np.array([r[0] for r in ids.collect()], np.int64))
    counts = np.zeros((2, 1 << bits))
    summed = docs.mapInArrow(_count(known, gram, bits), "bucket long, n_raw long, n_trusted long").groupBy("bucket").agg(F.sum("n_raw"), F.sum("n_trusted"))
    for bucket, raw, good in summed.collect():
        counts[:, bucket] = raw, good
    if not counts[1].any():
        return np.zeros(1 << bits)
    share, n = counts[0] / counts[0].sum(), counts[1].sum()
    seen = share > 0
    ratio = np.zeros(1 << bits)
    ratio[seen] = np.log((counts[1][seen] / share[seen] + SMOOTHING) / (n + SMOOTHING))
    return ratio


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that are found twice or more, the first included."""
    seen: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i in range(len(words) - window + 1):
        key = tuple(words[i : i + window])
        if (first := seen.setdefault(key, i)) != i:
            for at in (first, i):
                covered[at] += 1
                covered[at + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _may_repeat(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Documents in which two windows have one hash: all that repeat a window, and by chance
    another one. first: the first word of each document (with the end)."""
    n = len(begins)
    if n < window:
        return np.empty(0, np.int64)
    lengths = ends - begins
    place = np.arange(int(lengths.max()), dtype=np.uint64)
    power = (place * np.uint64(2) + np.uint64(1)) * _MIX
    power ^= power >> np.uint64(29)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hashed = np.add.reduceat((flat[_runs(begins, lengths)].astype(np.uint64) + np.uint64(1)) * power[inside], np.cumsum(lengths) - lengths)
    hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = doc[: n - window + 1].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    for k in range(window):
        total = (total ^ hashed[k : k + n - window + 1]) * _MIX
        total ^= total >> np.uint64(32)
    whole = doc[: n - window + 1] == doc[window - 1 :]
    total, doc = total[whole], doc[: n - window + 1][whole]
    order = np.argsort(total)
    total, doc = total[order], doc[order]
    return np.unique(doc[1:][total[1:] == total[:-1]])


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    flat, at = _bytes(texts)
    rows = len(at) - 1
    word = ~_BLANK[flat]
    before = np.zeros(len(flat), bool)
    before[1:] = word[:-1]
    limits = at[:-1][at[:-1] < len(flat)]
    before[limits] = False
    begins = np.flatnonzero(word & ~before)
    after = np.zeros(len(flat), bool)
    after[:-1] = word[1:]
    last = at[1:][at[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(word & ~after) + 1

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[at[1:]] - total[at[:-1]]

    first = np.searchsorted(begins, at)
    counts = {"n_words": np.diff(first), "word_chars": per_text(word & ((flat & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[flat])}
    dup_lines, repeats = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    raw = flat.tobytes()
    for i in np.flatnonzero(per_text(flat == 10)).tolist():
        lines = [x for x in raw[at[i] : at[i + 1]].split(b"\n") if x.strip()]
        dup_lines[i] = len(lines) - len(set(lines))
    for i in _may_repeat(flat, begins, ends, first, WINDOW).tolist():
        repeats[i] = repeated_words(raw[at[i] : at[i + 1]].split())
    return counts | {"n_dup_lines": dup_lines, "n_repeat_words": repeats}


def scores(texts: pa.Array, ratio: np.ndarray, gram: int = GRAM, neutral: int = NEUTRAL) -> np.ndarray:
    """The length-normalised log-likelihood ratio of each text."""
    flat, at = _bytes(texts)
    bits = int(len(ratio)).bit_length() - 1
    value = np.concatenate((ratio[_buckets(flat, gram, bits)], np.zeros(gram - 1)))[: len(flat)]
    total = np.concatenate(([0.0], np.cumsum(value)))
    n = np.maximum(np.diff(at) - gram + 1, 0)
    return (total[at[:-1] + n] - total[at[:-1]]) / (n + neutral)


def _verdicts(texts: pa.Array, ratio: np.ndarray, gram: int, threshold: float) -> dict[str, np.ndarray]:
    c = base_counts(texts)
    score = scores(texts, ratio, gram)
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    # Rounded, so that the order in which sums were made can't turn a verdict.
    return c | {"base_failed": failed, "kept": ~failed & (np.round(score, 6) >= threshold), "score": score}


def _judge(ratio, gram: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, "text"):
            found = _verdicts(block.column("text"), ratio.value, gram, threshold)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])

    return run


def _accept(ratio, gram: int, threshold: float, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, text_column):
            yield block.filter(pa.array(_verdicts(block.column(text_column), ratio.value, gram, threshold)["kept"]))

    return run


def _ratio(docs: DataFrame, trusted: DataFrame, gram: int, bits: int, id_column: str, text_column: str):
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows, docs.sparkSession.sparkContext.broadcast(fit(rows, trusted, gram, bits))


_ADDED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, gram: int = GRAM, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    score of every row.

    trusted: a DataFrame with the ids of trusted documents (doc_id). Defined cases: a null or
    empty text has no words and fails; a null document id is never trusted; repeated rows are
    judged alike, and counted as often as they are there; with no trusted document the plain
    counts decide alone; an empty table gives none; other columns are not looked at.
    """
    rows, ratio = _ratio(docs, trusted, gram, bits, id_column, text_column)
    return rows.mapInArrow(_judge(ratio, gram, threshold), f"doc_id long, {_ADDED}")


def accepted(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, gram: int = GRAM, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    docs = docs.withColumn(text_column, F.col(f"`{text_column}`").cast("string"))
    _, ratio = _ratio(docs, trusted, gram, bits, id_column, text_column)
    return docs.mapInArrow(_accept(ratio, gram, threshold, text_column), docs.schema)
