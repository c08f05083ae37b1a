"""Near-duplicates, passages, lines and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

simhash = pytest.importorskip("boxstats.llm.simhash")
from boxstats.llm import embeddings, lines, passages  # noqa: E402
from boxstats.llm.components import components  # noqa: E402
from boxstats.llm.forest import forest  # noqa: E402


class Union:
    def __init__(self, ids):
        self.of = {i: i for i in ids}

    def find(self, x):
        while self.of[x] != x:
            x = self.of[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)


def test_forest_and_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(900, 1000 + i) for i in range(200)] + [(i, i + 1) for i in range(2000, 2060)]
    union = Union({x for link in links for x in link})
    for a, b in links:
        union.link(a, b)
    expected = {x: union.find(x) for a, b in links if a != b for x in (a, b)}
    x, y = forest(*(np.array(c) for c in zip(*links, strict=True)))
    assert dict(zip(x.tolist(), y.tolist(), strict=True)) == {k: v for k, v in expected.items() if k != v}
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.id: r.component_id for r in components(frame).collect()}
    assert found == expected
    assert components(frame.limit(0)).count() == 0


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 3, 4, 5, 30, 200]))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = rng.choice(base).split(" ")
        if len(words) > 20 and rng.random() < 0.8:
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice("xyz")
        rows.append((i * 3 + 1, rng.choice([" ", " ", "\n"]).join(words), 0))
    return rows + [(5000, None, 1), (5001, "", 1), (5002, " \t ", 1), (5003, "ÀB c", 1), (7, rows[2][1], 1), (7, rows[2][1], 1)]


def test_simhash(spark, documents, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 20)
    prints = [brute_fingerprint(t) for _, t, _ in documents]
    union = Union(range(len(documents)))
    for i in range(len(documents)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                union.link(i, j)
    least: dict[int, int] = {}
    for i, (d, _, _) in enumerate(documents):
        least[union.find(i)] = min(d, least.get(union.find(i), d))
    expected = sorted((d, format(f, "016x"), least[union.find(i)]) for i, ((d, _, _), f) in enumerate(zip(documents, prints, strict=True)))
    frame = spark.createDataFrame(documents, "doc_id long, text string, fp int").repartition(3)
    assert sorted(map(tuple, simhash.near_duplicates(frame).collect())) == expected
    kept = simhash.representatives(frame).collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values()) and kept[0].__fields__ == ["doc_id", "text", "fp"]
    assert simhash.near_duplicates(frame.limit(0)).count() == simhash.representatives(frame.limit(0)).count() == 0


def test_pipeline_drops_similar_documents(spark, documents):
    import corpus_pipeline

    rng = random.Random(9)
    rows = list(documents)
    for i in range(6000, 6120, 4):  # chains of copies, some over 0.8 alike and some under
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
        for j in range(4):
            rows.append((i + j, " ".join(words), 0))
            for _ in range(rng.choice([2, 4, 6])):
                words[rng.randrange(200)] = "changed"
    sets = []
    for _, text, _ in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    union = Union(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                union.link(i, j)
    least: dict[int, int] = {}
    for i, (d, _, _) in enumerate(rows):
        least[union.find(i)] = min(d, least.get(union.find(i), d))
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int").repartition(3)
    kept = corpus_pipeline.simhash_dedup(spark, frame, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values()) and kept[0].__fields__ == ["doc_id", "text", "fp"]
    assert corpus_pipeline.simhash_dedup(spark, frame.limit(0), "").count() == 0


@pytest.mark.parametrize(("tau", "n"), [(2, 10**9), (3, 200_000), (4, 10**8)])
def test_pigeonhole_finds_all(spark, monkeypatch, tau, n):
    rng = random.Random(tau)
    prints = np.unique(np.array([rng.getrandbits(64) & 0xFFFF for _ in range(120)] + [rng.getrandbits(64) for _ in range(120)], np.uint64)).view(np.int64)
    choose = simhash.choose
    monkeypatch.setattr(simhash, "choose", lambda ones, sample, _, t: choose(ones, sample, n, t))
    found = simhash.link(spark.createDataFrame([(int(x),) for x in prints], "fp long"), tau).collect()
    a, b = Union(prints.tolist()), Union(prints.tolist())
    for r in found:
        assert (r.a ^ r.b) % 2**64 and int(r.a ^ r.b) % 2**64 >= 0
        a.link(r.a, r.b)
    for i, x in enumerate(prints.tolist()):
        for y in prints[:i].tolist():
            if ((x ^ y) % 2**64).bit_count() <= tau:
                b.link(x, y)
    assert {x: a.find(x) for x in a.of} == {x: b.find(x) for x in b.of}


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 30)
    rng = np.random.default_rng(1)
    rows = []
    for label in (1, 2, None):
        centres = rng.normal(size=(30, 16))
        for _ in range(120):
            v = centres[rng.integers(30)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.16])
            rows.append([label, [float(np.float32(x)) for x in v]])
    rows += [[1, None], [1, [0.0] * 16], [1, [0.0] * 16], [2, [float("nan")] + [1.0] * 15], [1, [None] + [1.0] * 15], [1, []], [1, [1.0, 2.0]], [1, [2.0, 4.0]], [1, [1e300, 2e300]], [2, [float("inf")] * 16]]
    rows = [(2 * i + 5, v, lab, 0) for i, (lab, v) in enumerate(rows)]
    able = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    union, links = Union(r[0] for r in rows), dict.fromkeys((r[0] for r in rows), 0)
    for i, (a, u, lab, _) in enumerate(able):
        for b, v, other, _ in able[:i]:
            if lab == other and len(u) == len(v):
                x, y = np.array(u) / max(map(abs, u)), np.array(v) / max(map(abs, v))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    union.link(a, b)
                    links[a] += 1
                    links[b] += 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell int").repartition(5)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame, 0.98).collect()}
    assert found == {k: (links[k], union.find(k), union.find(k) == k) for k in links}
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_chains_follow_both_orders():
    x = np.array([0, 10, 20, 30, 40, 60, 70])
    y = np.array([5, 15, 25, 2, 45, 65, 300])
    assert passages.chains(x, y)[0] == [0, 1, 2, 4, 5]
    assert passages.common_words([1, 2, 3, 4], [2, 9, 4, 1]) == 2


def test_passages(spark):
    rng = random.Random(8)

    def prose(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]

    rows, planted = [], {}
    for i in range(120):
        rows.append((i, " ".join(prose(rng.randint(60, 300)))))
    for group in range(12):
        passage = prose(rng.randint(55, 90))
        for n, d in enumerate(rng.sample(range(120), rng.choice([2, 3, 6]))):
            words, copy = rows[d][1].split(), list(passage)
            if n == 0 and group % 2:  # a word changed
                copy[rng.randrange(len(copy))] = "zzz"
            words = copy + words if rng.random() < 0.5 else words + copy  # not within another passage
            rows[d] = (d, " ".join(words))
            planted.setdefault(group, set()).add(d)
    copies = " ".join(prose(200))
    rows += [(500, copies), (501, copies), (501, copies), (502, None), (503, ""), (None, copies)]
    found = passages.shared(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(4)).collect()
    union = Union([*range(120), 500, 501, None and 0 or -1])
    for r in found:
        assert min(r.end_word - r.start_word, r.other_end - r.other_start) >= 50
        assert r.n_equal >= 0.8 * max(r.end_word - r.start_word, r.other_end - r.other_start)
        ids = [-1 if x is None else x for x in (r.doc_id, r.other_id)]
        union.link(*ids)
    for docs in planted.values():
        assert len({union.find(d) for d in docs}) == 1
    assert {d for d in union.of if union.find(d) != d or list(map(union.find, union.of)).count(d) > 1} == set.union(*planted.values()) | {500, 501, -1}
    assert passages.shared(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passage_of_lines_that_stand_alone_elsewhere(spark):
    rng = random.Random(3)

    def prose(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 8))) for _ in range(n)]

    rows, pairs, n = [], [], 0
    for _ in range(12):
        lines_ = prose(rng.randint(26, 45)), prose(rng.randint(26, 45))
        pairs.append((n, n + 1))
        for _ in range(2):
            rows.append((n, " ".join(prose(70) + lines_[0] + lines_[1] + prose(70))))
            n += 1
        for line in lines_:
            for _ in range(12):  # both ends of the order of keys, nearly always
                rows.append((n, " ".join(prose(70) + line + prose(70))))
                n += 1
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in found} == set(pairs)
    assert all(r.start_word <= 71 and r.end_word >= 120 for r in found)


def test_passage_with_a_line_that_stands_alone_before(spark):
    rng = random.Random(5)

    def prose(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]

    rows, planted = [], []
    for n in range(0, 60, 2):
        line, head, tail = prose(30), prose(18), prose(18)
        passage = head + line + tail
        change = list(passage)
        change[24] = change[41] = "zzz"  # no run of 50 words is the same
        rows.append((n, " ".join(prose(80) + line + prose(90) + passage + prose(70))))
        rows.append((n + 1, " ".join(prose(90) + line + prose(80) + change + prose(70))))
        planted.append((n, n + 1))
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in found if r.end_word - r.start_word >= 60}
    assert whole <= set(planted) and len(whole) >= 27


@pytest.mark.parametrize(("changes", "least"), [(6, 40), (9, 39), (12, 37)])
def test_passages_down_to_the_share(changes, least):
    rng, found = np.random.default_rng(changes), 0
    for _ in range(40):
        a, b = rng.integers(1, 2**62, (2, 220)).astype(np.uint64)
        b[80:140] = a[80:140]
        b[80 + rng.choice(60, changes, False)] = 1
        (sa, xa, _), (sb, xb, _) = (passages.seeds(v, np.array([0, len(v)])) for v in (a, b))
        met = sorted((int(i), int(j)) for s, i in zip(sa, xa, strict=True) for t, j in zip(sb, xb, strict=True) if s == t)
        if met:
            x, y = map(np.array, zip(*met, strict=True))
            m = passages.MARGIN
            for c in passages.chains(x, y):
                low, high = x[c[0]] - m, x[c[-1]] + passages.K + m
                if passages.passages(a[max(0, low) : high], b[max(0, low) : high], (x[c] - max(0, low)).tolist(), (y[c] - max(0, low)).tolist()):
                    found += 1
                    break
    assert found >= least


def brute_passage(a: list[str], b: list[str], least: int, share: float) -> bool:
    """Whether some stretches of both, of ``least`` words or more that begin and end with a word
    in common, have that share of the longer one's words in common, in order."""
    same = np.array([[x == y for y in b] for x in a])
    for i, j in zip(*np.nonzero(same), strict=True):
        if i and j and same[i - 1, j - 1]:
            continue  # it is longer with the words before
        common = np.zeros(len(b) - j + 1, int)
        for n, row in enumerate(same[i:, j:], 1):
            common[1:] = np.maximum.accumulate(np.maximum(common[1:], common[:-1] + row))
            size = np.arange(1, len(b) - j + 1)
            if (row & (np.minimum(n, size) >= least) & (common[1:] >= share * np.maximum(n, size) - 1e-9)).any():
                return True
    return False


def test_passages_are_those_of_a_brute_aligner(spark):
    """Documents in pairs, with passages of 50 to 110 words, unchanged or with words changed, left
    out and put in; those that local alignment over all words finds are found, 95 of 100 at least,
    and no other pair is."""
    rng, rows, near = random.Random(11), [], {}
    for n in range(0, 240, 2):
        word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 6)))
        passage = [word() for _ in range(rng.choice([30, 40, 50, 50, 52, 55, 60, 70, 90, 110]))]
        copy = list(passage)
        for _ in range(rng.choice([0, 0, 1, 2, 4, len(copy) // 10, len(copy) // 7])):
            at, what = rng.randrange(len(copy)), rng.random()
            copy[at : at + 1] = [word()] if what < 0.7 else [] if what < 0.85 else [copy[at], word()]
        texts = [[word() for _ in range(rng.randint(0, 70))] + p + [word() for _ in range(rng.randint(0, 70))] for p in (passage, copy)]
        rows += [(n + i, " ".join(t)) for i, t in enumerate(texts)]
        near[n, n + 1] = brute_passage(*texts, 50, 0.8)
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    pairs = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in found}
    wanted = {p for p, good in near.items() if good}
    assert 60 < len(wanted) < 100 and pairs <= wanted and len(pairs) >= 0.95 * len(wanted)


def test_seeds_of_a_long_text_and_of_the_same_word():
    words, bounds = passages.words_of(pa.array([None, "", "A b\tC", " ".join(["x"] * 20000), "a B c", "é É"]))
    assert np.diff(bounds).tolist() == [0, 0, 3, 20000, 3, 2]
    assert words[bounds[2] : bounds[3]].tolist() == words[bounds[4] : bounds[5]].tolist() and words[-1] != words[-2]
    marks, at, known = passages.seeds(words, bounds, 5, 8, 43)
    assert len(marks) <= 20000 // 4 + 8 and len(set(marks.tolist())) == 1 and np.diff(at).max() <= 8 and (known > 0).sum() > 4900


def test_passage_with_changes_near_its_ends():
    a, b = np.arange(1000, 1200, dtype=np.uint64), np.arange(5000, 5200, dtype=np.uint64)
    b[60:115] = a[60:115]
    b[105:107] = 1, 2  # 45 equal, 2 changed, 8 equal
    assert passages.passages(a, b, [70], [70]) == [(60, 115, 60, 115, 53)]
    b[107:115] = 3  # 45 equal words alone aren't enough
    assert passages.passages(a, b, [70], [70]) == []


def test_lines(spark, duck, data, compare):
    rows = [(i, f"own {i}\nshared\n\n  \nshared" + ("\nrare" if i < 2 else ""), "a", 5, "x") for i in range(20)] + [(30, "shared", None, 1, "x"), (31, None, "a", None, "x"), (32, "shared", "b", 6, "x"), (33, "shared", "a", 6, "x"), (33, "shared", "a", 6, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, host string")
    found = {r.doc_id: r for r in lines.cleaned(frame, count_columns=("n", "dropped")).collect()}
    assert found[5].text == "own 5\n\n  " and found[5].n_chars == len(found[5].text) and (found[5].n, found[5].dropped) == (3, 2)
    assert found[1].text.endswith("rare") and found[30].text == found[32].text == "shared" and found[31].text is None and found[33].text == ""
    assert lines.cleaned(frame.limit(0)).columns == frame.columns and lines.cleaned(frame.limit(0)).count() == 0


def test_lines_of_small_hosts_and_clashing_columns(spark):
    long = "\n".join(f"line {i}" for i in range(40000))
    rows = [(0, "only here", "one", 1, 2), (1, "both\nown 1", "two", 1, 2), (2, "both\nown 2", "two", 1, 2), (3, long, "three", 1, 2), (4, "line 39999\nx", "three", 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, host int, Marks int")
    found = {r.doc_id: r.text for r in lines.cleaned(frame).collect()}
    assert found == {0: "only here", 1: "own 1", 2: "own 2", 3: long.rpartition("\n")[0], 4: "x"}
    assert lines.cleaned(frame).columns == frame.columns


def test_representatives_with_clashing_columns_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text, "b", 1), (7, text, "a", 1), (7, text, "a", 1), (9, text + " end", "c", 1), (None, text, "d", 1), (11, "other words altogether, and a few more", "e", 1), (12, None, "f", 1), (13, "", "g", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lost_id string, hash int")
    for kept in (simhash.similar_representatives(frame), simhash.representatives(frame)):
        found = kept.collect()
        assert sorted(r.doc_id for r in found) == [7, 11, 12] and kept.columns == frame.columns
        assert {r.lost_id for r in found if r.doc_id == 7} <= {"a", "b"}


def test_very_long_texts(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the", "in"]) + str(rng.randint(0, 999)) for _ in range(60000))
    frame = spark.createDataFrame([(1, long), (2, long), (3, long[: len(long) // 2]), (4, "short one")], "doc_id long, text string")
    prints = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert prints[1] == prints[2] == 1 and prints[4] == 4
    found = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)): r for r in passages.shared(frame).collect()}
    assert set(found) >= {(1, 2)} or set(found) >= {(1, 3), (2, 3)}
    assert max(r.end_word - r.start_word for r in found.values()) >= 29999


def test_pipeline_takes_candidates_from_fingerprints(spark, monkeypatch):
    import corpus_pipeline

    rng = random.Random(21)
    words = [["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)] for _ in range(20)]
    rows = [(n, " ".join(w)) for n, w in enumerate(words)] + [(100 + n, " ".join([*w[:-1], "changed"])) for n, w in enumerate(words)]
    apart = {n: bin(simhash.fingerprint(rows[n][1]) ^ simhash.fingerprint(rows[20 + n][1])).count("1") for n in range(20)}
    close = {n for n, bits in apart.items() if bits <= 4}
    assert len(close) >= 15
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = frame.select("doc_id", F.col("doc_id").alias("hash"), "text")
    found = simhash.candidates(hashed, frame.select(F.col("doc_id").alias("hash"), F.col("doc_id").alias("name"))).collect()
    assert {(r.a, r.b) for r in found} == {(n, 100 + n) for n in close}
    # without bands, the pipeline drops those that the fingerprints bring together, and no others
    monkeypatch.setattr(simhash, "_banded", lambda shingle, seed, made=simhash._banded: lambda batches: (b.set_column(3, "bands", pa.array([[hash(str(x)) % 2**62 for x in (d, "own")] for d in b.column("doc_id").to_pylist()], pa.list_(pa.int64()))) for b in made(shingle, seed)(batches)))
    kept = {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, frame, "").collect()}
    assert kept == set(range(20)) | {100 + n for n in range(20) if n not in close}


def test_every_document_of_a_passage_has_a_row(spark):
    rng = random.Random(9)

    def prose(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]

    passage = prose(60)
    rows = [(n, " ".join(prose(40) + passage + prose(40))) for n in range(7)] + [(n, " ".join(prose(140))) for n in range(7, 12)]
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(7))
    rows_ = {(r.doc_id, r.start_word, r.end_word, r.other_id, r.other_start, r.other_end, r.n_equal) for r in found}
    assert rows_ == {(*r[3:6], *r[:3], r[6]) for r in rows_}
