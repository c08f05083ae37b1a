"""Encoding, decoding, token files and packing against the public libraries."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

public = pytest.importorskip("public_tokenizers")
bpe = pytest.importorskip("boxstats.llm.bpe")
from boxstats.llm import packing, token_files, tokens  # noqa: E402

ODD = [
    None, "", " ", "\n", " \n \n", "a\x1cb  c\n\n d\t e's 'S I'Ll  ", "<|endoftext|> <|startoftext|>x", "Ab, c! İstanbul. ΑΣ, É. a.. b?! x.,", "½Ⅷ² ‘x’ \u3000x\u2003y\x85z\u200bq ﬁ 中文字 \U0001f600\U0001f600 ",
    "a" * 3000, "the" * 500, "-" * 1000, " " * 999, " " * 100 + "x", "==" * 300, "e\u0301 E\u0301, x\x00y",
]


def texts(n=400):
    rng = random.Random(4)
    vocabulary = list(tokens.read_ranks(public.path("byte_bpe_50k.tiktoken")))
    made = ["".join(rng.choice("abcdeothinr ing'S\n.,!0189é中\U0001f600") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    made += [b"".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))).decode("utf8", "ignore") for _ in range(n)]
    return ODD + made


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_librarys_ids(name, spaced):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path(name))
    library.encode_special_tokens = True
    for rows in (texts(), ["x"], [], [None]):
        ids, at = tokens.library_encoder(public.path(name), spaced)(pa.array(rows, pa.string()))
        for i, x in enumerate(library.encode_batch([x or "" for x in rows], add_special_tokens=False)):
            assert ids[at[i] : at[i + 1]].tolist() == x.ids


def test_memo_that_overflows():
    encoder = tokens.PieceEncoder(False, lambda pieces: (np.array(list(map(len, pieces)), np.uint32), np.ones(len(pieces), np.int64)), limit=3, longest=4)
    for n in range(1, 9):
        ids, at = encoder(pa.array(["a bb ccc dddd", "eeeee, a", "f" * n]))
        assert ids.tolist() == [1, 2, 3, 4, 5, 1, 1, n] and at.tolist() == [0, 4, 7, 8]
        assert all(len(x) <= 4 for x in encoder.young.memo)


def test_transducer_is_the_librarys_merging():
    import tiktoken

    path = public.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=tokens.read_ranks(path), special_tokens={})
    encoder, decoder = bpe.coder(path, public.PATTERN)
    rows = texts()
    ids, at = encoder(pa.array(rows))
    for i, x in enumerate(rows):
        own = ids[at[i] : at[i + 1]]
        assert own.tolist() == library.encode_ordinary(x or "")
        assert "".join(decoder.stream(own, 3)) == (x or "")


def test_utf8_machine_at_any_cut():
    text = "aé中\U0001f600z" * 3
    raw = text.encode()
    for size in range(1, 9):
        machine = bpe.Utf8Machine()
        assert "".join([*(machine.feed(raw[i : i + size]) for i in range(0, len(raw), size)), machine.close()]) == text
    broken = b"a\xff\xe4\xb8" + b"b\xf0\x9f"
    machine = bpe.Utf8Machine()
    assert machine.feed(broken[:4]) + machine.feed(broken[4:]) + machine.close() == broken.decode("utf8", "replace")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, x, "t") for i, x in enumerate(texts(60))] + [(None, "a b", "t"), (3, "again", "t"), (3, "again", "t"), (10**12, "word " * 3000, "t")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)


def test_encode_and_decode(spark, docs):
    path = public.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, public.PATTERN)
    back = Counter((r.doc_id, r.text) for r in bpe.decode(encoded, path, public.PATTERN).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in docs.collect())
    digests = bpe.round_trip(docs, path, public.PATTERN).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in digests) == Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert bpe.round_trip(docs.limit(0), path, public.PATTERN).count() == 0


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    out = str(tmp_path / "ids")
    token_files.write(docs, out, public.path("word_bpe_49k.json"), end_id=1)
    rows = sorted(token_files.digest(token_files.read(spark, out)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda d: -1 if d is None else d)
    start = 0
    expected = Counter()
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert [r.doc_id for r in token_files.read(spark, out, [5, -7]).collect()] == [5]
    empty = str(tmp_path / "none")
    token_files.write(docs.limit(0), empty, public.path("word_bpe_49k.json"), end_id=1)
    assert token_files.digest(token_files.read(spark, empty)).count() == 0


def test_packing_search():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 17, 30, 100])
        counts = [0] * (capacity + 1)
        for _ in range(rng.randint(0, 60)):
            counts[rng.randint(1, capacity)] += rng.choice([1, 1, 2, 7])
        first, best = packing.best_fit(counts, capacity), packing.complete(counts, capacity, nodes=500)[0]
        for plan in (first, best):
            got = [0] * (capacity + 1)
            for times, held in plan:
                assert times > 0 and 0 < sum(held) <= capacity
                for x in held:
                    got[x] += times
            assert got == counts
        assert sum(t for t, _ in best) <= sum(t for t, _ in first)


def fewest_bins(sizes: list[int], capacity: int) -> int:
    """Exact, over all subsets: the least (bins, content of the last)."""
    best = [(0, capacity)] + [(len(sizes) + 1, 0)] * (2 ** len(sizes) - 1)
    for held in range(1, 2 ** len(sizes)):
        for i, x in enumerate(sizes):
            if held >> i & 1:
                bins, last = best[held ^ 1 << i]
                best[held] = min(best[held], (bins, last + x) if last + x <= capacity else (bins + 1, x))
    return best[-1][0]


def test_completion_is_exact_on_small_instances():
    rng, better = random.Random(9), 0
    for _ in range(150):
        capacity = rng.choice([12, 20, 50, 100])
        sizes = [rng.randint(max(1, capacity // 8), max(2, capacity * 6 // 10)) for _ in range(rng.randint(4, 11))]
        counts = np.bincount(sizes, minlength=capacity + 1).tolist()
        plan, known = packing.complete(counts, capacity)
        best = fewest_bins(sizes, capacity)
        assert known and sum(t for t, _ in plan) == best, sizes
        better += best < sum(t for t, _ in packing.best_fit(counts, capacity))
    assert better >= 2  # cases in which best fit isn't


def test_completion_of_the_documents_lengths():
    """Lengths with a bound that best fit misses by two sequences and the search reaches."""
    counts = [0] * 1025
    rng = random.Random(3)
    for _ in range(1500):
        counts[min(1024, max(2, int(rng.lognormvariate(6.2, 1.0))))] += 1
    first, (best, known) = packing.best_fit(counts, 1024), packing.complete(counts, 1024)
    assert sum(t for t, _ in best) < sum(t for t, _ in first)
    assert known == (sum(t for t, _ in best) == max(-(-sum(i * n for i, n in enumerate(counts)) // 1024), sum(counts[513:])))


def test_every_filling_is_maximal_and_undominated():
    counts = np.bincount([9, 7, 6, 5, 4, 4, 2, 1], minlength=13)
    assert sorted(packing.every_filling(counts, 12, lambda: True)) == [(6, 4, 2), (7, 5), (9, 2, 1)]


def test_packing_places_every_token(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = packing.pack(docs, public.path("byte_bpe_50k.json"), end_id=2, capacity=1024, with_ids=True).collect()
    fills: dict[int, list] = {}
    total = 0
    for r in rows:
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    for held in fills.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(fills) <= -(-total // 1024) + 1
    long = sorted((r for r in rows if r.doc_id == 10**12), key=lambda r: r.piece)
    ids = [*library.encode("word " * 3000, add_special_tokens=False).ids, 2]
    assert [x for r in long for x in r.ids] == ids and all(r.length == 1024 for r in long[1:]) and [r.start for r in long] == [0, *range(long[0].length, len(ids), 1024)]
    assert packing.pack(docs.limit(0), public.path("byte_bpe_50k.json"), end_id=2).count() == 0


def test_packing_search_reaches_the_bound():
    import random

    from boxstats.llm import packing

    rng, counts = random.Random(4), [0] * 201
    for _ in range(600):
        counts[min(200, max(5, int(rng.lognormvariate(4.2, 0.6))))] += 1
    assert sum(t for t, _ in packing.complete(counts, 200)[0]) == 235 == max(-(-sum(i * n for i, n in enumerate(counts)) // 200), sum(counts[101:]))
