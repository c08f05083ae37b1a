"""Personal data: base patterns, and candidates that boosted trees judge.

Four base kinds (email, ip, card, phone) are found by their patterns and always stay. Beyond
them, generators of high recall propose spans of further kinds, which may overlap; gradient-
boosted trees give each a probability from features of its format and context, and those above
their kind's threshold are selected, the likeliest first, where they overlap nothing selected.

The trees are trained on the driver, in a second or two, on ``EXAMPLES`` texts that a fixed
seed makes: values of each kind, and look-alikes of the same generators that are none
(versions, prices, dates, hashes, identifiers), in prose. Thresholds are calibrated on held-out
examples: the least probability from which on at least ``PRECISION`` of a kind's candidates are
true. Texts are read once, where they lie; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.llm import boosting, tokens

BASE = ("email", "ip", "card", "phone")
EXAMPLES, PRECISION, SEED = 6000, 0.99, 7

Span = tuple[str, int, int]

# --- the base kinds ---------------------------------------------------------------------------

_DIGITS = re.compile(r"[0-9]++")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, which finds what the pattern finds from the left, in linear time."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            yield start, end.end()
            done = at = end.end()
        else:
            at += 1


def ips(text: str) -> Iterator[tuple[int, int]]:
    """A match can only begin where a run of digits does."""
    done = 0
    for run in _DIGITS.finditer(text):
        if run.start() >= done and (m := _IP.match(text, run.start())):
            done = m.end()
            if all(int(x) <= 255 if len(x) < 9 else not x.strip("0") or int(x[-9:]) <= 255 and not x[:-9].strip("0") for x in m[0].split(".")):
                yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind as listed and start."""
    found: list[Span] = []
    if "@" in text:
        found += (("email", *x) for x in emails(text))
    if _DIGITS.search(text):
        found += (("ip", *x) for x in ips(text))
        found += (("card", *x) for x in cards(text))
        if "+" in text:
            found += (("phone", *x) for x in phones(text))
    return found


# --- candidates of further kinds --------------------------------------------------------------

#: (kind, characters one of which a text needs, pattern). Runs have bounded lengths or are
#: possessive, so that a pattern's time is linear in the text.
GENERATORS = (
    ("email_written", "tT", re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,}+ ?(?:\[at\]|\(at\)|\{at\}| at ) ?[A-Za-z0-9-]{2,}+ ?(?:\[dot\]|\(dot\)|\{dot\}| dot ) ?[A-Za-z]{2,}+(?![0-9_])")),
    ("phone_local", "0123456789", re.compile(r"(?<![0-9])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")),
    ("ssn", "0123456789", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("iban", "0123456789", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("mac", ":-", re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])")),
    ("ipv6", ":", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}:?(?:[0-9A-Fa-f]{1,4}:){0,5}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("secret", "=:", re.compile(r"(?<=[=:])[ ]?[\"']?[A-Za-z0-9_+/.-]{8,}+[\"']?")),
    ("key", "0123456789", re.compile(r"(?<![A-Za-z0-9_])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+")),
)
#: Characters of a candidate that are judged; an accepted span goes on to the end of its run.
JUDGED = {"secret": 200, "key": 100}
KINDS = tuple(kind for kind, _, _ in GENERATORS)
_NEEDS = {kind: re.compile(f"[{re.escape(needed)}]") for kind, needed, _ in GENERATORS}
_SECRET_WORD = re.compile(r"(?:token|passw(?:or)?d|pwd|secret|api[_-]?key|auth|bearer|credential|key)\W{0,4}$", re.IGNORECASE)
_PHONE_WORD = re.compile(r"(?:tel|phone|call|mobile|fax|cell)\W{0,4}$", re.IGNORECASE)
_ID_WORD = re.compile(r"(?:ssn|social|iban|account|acct|konto|mac|ip|mail|contact)\W{0,4}$", re.IGNORECASE)
_OTHER_WORD = re.compile(r"(?:version|commit|page|isbn|sha|md5|build|ref|order|file|on|from|id|date|line|chapter)\W{0,4}$", re.IGNORECASE)
_HEX = frozenset("0123456789abcdefABCDEF")


def candidates(text: str) -> list[Span]:
    found: list[Span] = []
    digits = bool(_DIGITS.search(text))
    for kind, needed, pattern in GENERATORS:
        if kind == "email_written" and not ("dot" in text and ("(at)" in text or "[at]" in text or "{at}" in text or " at " in text)):
            continue
        if needed[0] == "0" and not digits or kind in ("mac", "ipv6") and not (digits and _NEEDS[kind].search(text)) or kind == "secret" and not _NEEDS[kind].search(text):
            continue
        for m in pattern.finditer(text):
            skip = len(m[0]) - len(m[0].lstrip(" \"'"))
            found.append((kind, m.start() + skip, m.start() + len(m[0].rstrip("\"'."))))
    return [x for x in found if x[2] > x[1]]


def features(text: str, span: Span) -> list[float]:
    """Of the format: the kind, length, classes of characters, longest run of digits, variety,
    checks; of the context: the characters around and the word before."""
    kind, start, end = span
    body, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 1]
    if kind in JUDGED and len(body) > JUDGED[kind]:
        body, after = body[: JUDGED[kind]], body[JUDGED[kind]]
    size = len(body)
    digits = sum(c.isdigit() for c in body)
    numbers = "".join(c for c in body if c.isdigit())
    lowers, uppers = sum(c.islower() for c in body), sum(c.isupper() for c in body)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(body, body[1:], strict=False))
    return [
        KINDS.index(kind), size, digits, digits / size, lowers / size, uppers / size, sum(c in _HEX for c in body) / size,
        max((len(x) for x in _DIGITS.findall(body)), default=0), len(set(body)) / size, changes / size, sum(body.count(c) for c in " -.:()") / size, body.count("."), body.count("-"),
        float(luhn(numbers)) if numbers else 0.0, float(size > 3 and sum(int(c, 36) if c.isalnum() and c.isascii() else 0 for c in body) % 9 == 0),
        float(body.startswith(("AKIA", "ghp_", "sk-", "sk_", "xox", "eyJ"))), float(body[:3] in ("000", "666") or body[:1] == "9"),
        float("=" in before[-4:]), float('"' in before[-2:] or "'" in before[-2:]), float(before[-1:].isalnum()), float(after.isalnum()), float(after in ("%", "€", "$")), float(before[-2:].strip() in ("$", "€", "#")),
        float(bool(_SECRET_WORD.search(before))), float(bool(_PHONE_WORD.search(before))), float(bool(_ID_WORD.search(before))), float(bool(_OTHER_WORD.search(before))),
    ]


# --- training ---------------------------------------------------------------------------------


def _prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("an", "the", "ti", "on", "re", "lo", "mi", "sch", "é", "que", "ver", "ing")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _example(rng: random.Random) -> tuple[str, Span | None]:
    """A text, and the span in it that is personal data, if any."""

    def d(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def h(n: int, letters: str = "0123456789abcdef") -> str:
        return "".join(rng.choice(letters) for _ in range(n))

    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789"
    name, host = _prose(rng, 1) + d(2), _prose(rng, 1)
    true = {
        "email_written": lambda: ("", rng.choice((f"{name} [at] {host} [dot] com", f"{name} (at) {host} (dot) org", f"{name}{{at}}{host}{{dot}}net", f"{name} at {host} dot com"))),
        "phone_local": lambda: (rng.choice(("", "tel ", "call ", "phone: ")), rng.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}"))),
        "ssn": lambda: (rng.choice(("", "ssn ", "SSN: ", "social ")), f"{rng.randint(1, 8)}{d(2)}-{d(2)}-{d(4)}"),
        "iban": lambda: (rng.choice(("", "iban ", "account: ")), rng.choice((f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", f"GB{d(2)}{h(4, upper[:26])}{d(14)}", f"FR{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(4)} {d(3)}"))),
        "mac": lambda: ("", rng.choice((":", "-")).join(h(2) for _ in range(6))),
        "ipv6": lambda: ("", rng.choice((":".join(h(4) for _ in range(8)), f"2001:db8::{h(4)}:{h(4)}", f"fe80::{h(4)}:{h(4)}:{h(4)}:{h(4)}"))),
        "secret": lambda: (rng.choice(("password=", "token = ", 'token = "', "secret: ", "api_key=", "pwd=")), rng.choice((h(18), h(40), h(32), h(24, mixed), h(12, mixed) + d(2)))),
        "key": lambda: ("", rng.choice(("AKIA" + h(16, upper), "ghp_" + h(36, mixed), "sk-" + h(32, mixed), "eyJ" + h(rng.randint(17, 60), mixed + "-_")))),
    }
    false = (
        lambda: ("version ", f"{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}"), lambda: ("commit ", h(40)), lambda: ("sha ", h(32)), lambda: ("on ", f"20{d(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"),
        lambda: ("order ", f"{d(4)}-{d(4)}-{d(4)}-{d(4)}"), lambda: ("isbn ", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"), lambda: ("", f"{d(2)}:{d(2)}:{d(2)}"), lambda: ("pages ", f"{d(3)}-{d(3)}"), lambda: ("$", f"{d(3)} {d(3)} {d(3)}"),
        lambda: ("ref ", f"{h(2, upper[:26])}{d(2)} {h(4, upper)} {h(4, upper)}"), lambda: ("", f"{_prose(rng, 1)}_{_prose(rng, 1)}_{d(2)}_{_prose(rng, 1)}"), lambda: ("", f"note: {_prose(rng, 1)}{_prose(rng, 1)}"), lambda: ("file ", f"{_prose(rng, 1)}-{_prose(rng, 1)}-20{d(2)}-{d(2)}-{d(2)}"),
        lambda: ("", f"x={_prose(rng, 1)}{_prose(rng, 1)}{_prose(rng, 1)}"), lambda: ("", d(rng.randint(8, 30))), lambda: ("build ", f"{d(3)}.{d(3)}.{d(4)}"), lambda: ("", f"{_prose(rng, 1)} at {_prose(rng, 1)} dotted {_prose(rng, 1)}"), lambda: ("id ", f"9{d(2)}-{d(2)}-{d(4)}"), lambda: ("", f"{d(3)} {d(3)} {d(3)}"),
    )
    kind = rng.choice((*KINDS, *KINDS, None, None, None, None, None, None, None, None, None, None, None, None))
    lead, value = true[kind]() if kind else rng.choice(false)()
    text = _prose(rng, rng.randint(0, 8)) + rng.choice((" ", ", ", "\n")) + lead
    start = len(text)
    text += value
    span = (kind, start, len(text)) if kind else None
    return text + rng.choice((" ", ". ", ", ", '" ', "\n")) + _prose(rng, rng.randint(0, 8)), span


@dataclass(frozen=True)
class Judge:
    model: boosting.Boosted
    thresholds: tuple[float, ...]

    def select(self, text: str, taken: list[Span]) -> list[Span]:
        """The candidates selected, besides the spans taken already."""
        proposed = [x for x in dict.fromkeys(candidates(text)) if not any(x[1] < t[2] and t[1] < x[2] for t in taken)]
        if not proposed:
            return []
        p = self.model.probability(np.array([features(text, x) for x in proposed]))
        kept: list[Span] = []
        for i in sorted(range(len(proposed)), key=lambda i: (-round(p[i], 9), proposed[i])):
            x = proposed[i]
            if p[i] >= self.thresholds[KINDS.index(x[0])] and not any(x[1] < k[2] and k[1] < x[2] for k in kept):
                kept.append(x)
        return sorted(kept, key=lambda x: (KINDS.index(x[0]), x[1]))


@cache
def train(examples: int = EXAMPLES, precision: float = PRECISION, seed: int = SEED) -> Judge:
    """Trees from three quarters of the examples, thresholds from the rest."""
    rng = random.Random(seed)
    rows, truth, held = [], [], []
    for k in range(examples):
        text, span = _example(rng)
        base = base_spans(text)
        for x in candidates(text):
            if any(x[1] < b[2] and b[1] < x[2] for b in base):
                continue
            rows.append(features(text, x))
            truth.append(span is not None and x[1] < span[2] and span[1] < x[2] and abs(x[1] - span[1]) + abs(x[2] - span[2]) <= 2 and (x[0] == span[0] or span[0] in ("secret", "key")))
            held.append(k % 4 == 0)
    x, y, held_ = np.array(rows), np.array(truth, float), np.array(held)
    model = boosting.train(x[~held_], y[~held_])
    p, y, kind = model.probability(x[held_]), y[held_], x[held_][:, 0]
    thresholds = []
    for k in range(len(KINDS)):
        order = np.argsort(-p[kind == k], kind="stable")
        score, true = p[kind == k][order], y[kind == k][order]
        share = np.cumsum(true) / np.arange(1, len(true) + 1)
        fine = np.flatnonzero(share >= precision)
        thresholds.append(max(0.5, float(score[fine[-1]])) if len(fine) else 1.1)
    return Judge(model, tuple(thresholds))


# --- Spark ------------------------------------------------------------------------------------


def spans(text: str | None, judge: Judge) -> tuple[list[Span], list[Span]]:
    """The base spans and the added ones."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, judge.select(text, base)


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str, found: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the one
    that begins first names them all."""
    out, done = [], 0
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += (text[done:a], f"[{kind.upper()}]")
        done = max(done, b)
    return "".join([*out, text[done:]])


def _find(judge: Judge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, "text"):
            found = [spans(x, judge) for x in block.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in BASE]
            digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            told = pa.array([joined([*base, *more]) for base, more in found], pa.string())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *counts, digests, told], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return run


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans) and spans (all,
    as kind:start:end, the base kinds first) of every row. The four counts are of base spans;
    added spans have kinds of their own.

    Defined cases: a null or empty text has no spans; null and repeated document ids are rows
    like any other; an empty table gives none; other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_find(train()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def _redact(judge: Judge, text_column: str, length_column: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tokens.blocks(batches, text_column):
            texts = [x and (redact(x, [*a, *b]) if (a or b) else x) for x, (a, b) in ((x, spans(x, judge)) for x in block.column(text_column).to_pylist())]
            block = block.set_column(block.schema.get_field_index(text_column), text_column, pa.array(texts, pa.string()))
            if length_column and length_column in block.schema.names:
                block = block.set_column(block.schema.get_field_index(length_column), length_column, pa.array([None if x is None else len(x) for x in texts], pa.int64()))
            yield block

    return run


def redacted(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """``docs`` with all spans in the text replaced; a column of the text's length follows it. A
    null text stays null; a text column of another type becomes a string."""
    docs = docs.withColumn(text_column, F.col(f"`{text_column}`").cast("string"))
    if length_column in docs.columns:
        docs = docs.withColumn(length_column, F.col(length_column).cast("long"))
    return docs.mapInArrow(_redact(train(), text_column, length_column), docs.schema)
