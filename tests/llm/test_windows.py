"""Online packing by the sum of squares."""

import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assaylake.llm import packing, queries
from assaylake.llm import sum_of_squares as sos

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def check_windows(rows, ids, capacity=1024):
    """Every id in one piece, windows without gaps or padding; the windows' fills."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert pieces.keys() == ids.keys()
    for d, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            raw = b"".join(x.to_bytes(4, "little") for x in ids[d][at : at + r["length"]])
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(raw), len(ids[d]))
            at += r["length"]
        assert at == len(ids[d])
    fills = []
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity and at & (at - 1) == 0
        fills.append(at)
    return fills


def test_windows_against_the_ids(spark):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"]: [*reference.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    packed = queries.op11_sum_of_squares_packing(spark, SF)
    rows = packed.collect()
    fills = check_windows(rows, ids)
    total = sum(map(len, ids.values()))
    assert len(fills) <= -(-total // 1024) + 10  # one task
    (sums,) = sos.padding(packed).collect()
    assert (sums["sequences"], sums["tokens"], sums["padding"]) == (len(fills), total, 0)
    held = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, packed).collect()}
    for r in rows:
        span = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == span


def test_the_level_makes_the_squares_least():
    rng = random.Random(3)
    capacity = 32
    levels, counts = sos.Levels(capacity), Counter()
    for _ in range(3000):
        size = rng.choice([3, 5, 7, 11, 13, 17, 30, 32])
        squares = {}
        for h in [0, *(h for h in counts if counts[h])]:
            if h + size <= capacity:
                after = Counter(counts)
                if h:
                    after[h] -= 1
                if h + size < capacity:
                    after[h + size] += 1
                squares[h] = sum(n * n for n in after.values())
        best = levels.best(size)
        assert best == max(h for h in squares if squares[h] == min(squares.values()))
        for level, by in ((best, -1), (best + size, 1)):
            levels.add(level, by)
            if 0 < level < capacity:
                counts[level] += by


@given(st.lists(st.integers(1, 200), max_size=200), st.integers(1, 20))
@settings(max_examples=100, deadline=None)
def test_packing_of_any_lengths(lengths, most_open):
    packer = sos.Packer(64, most_open)
    docs = [sos.Piece(k, 0, b"".join(x.to_bytes(4, "little") for x in range(n)), n) for k, n in enumerate(lengths)]
    windows = [w for d in docs for w in packer.add(d)]
    assert packer.open <= most_open
    windows += packer.finish()
    seen = defaultdict(list)
    for w in windows:
        fill = sum(p.length for p in w)
        assert 0 < fill <= 64 and fill & (fill - 1) == 0
        for p in w:
            got = [int.from_bytes(p.ids[i : i + 4], "little") for i in range(0, len(p.ids), 4)]
            assert got == list(range(p.start, p.start + p.length))
            seen[p.doc_id] += got
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in enumerate(lengths)}


def test_the_share_of_open_windows_falls_with_the_stream():
    cut = []
    for n in (500, 20_000):
        rng, packer = random.Random(n), sos.Packer()
        windows = []
        for k in range(n):
            size = min(1024, int(rng.lognormvariate(5.8, 0.7)) + 1)
            windows += packer.add(sos.Piece(k, 0, bytes(4 * size), size))
        windows += packer.finish()
        pieces = Counter(p.doc_id for w in windows for p in w)
        cut.append(sum(c > 1 for c in pieces.values()) / n)
    assert cut[1] < 0.05 < cut[0]


def test_documents_that_pack_perfectly_are_not_cut():
    packer = sos.Packer()
    rng = random.Random(1)
    windows = []
    for k in range(4000):
        windows += packer.add(sos.Piece(k, 0, bytes(4 * (n := rng.choice([256, 512, 768]))), n))
    assert packer.open < 100
    windows += packer.finish()
    assert Counter(p.doc_id for w in windows for p in w).most_common(40)[-1][1] == 1


def test_windows_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (None, ""), (3, "x"), (3, "x"), (3, "y"), (4, "z " * 7000), (5, "<|endoftext|>")], DOCS
    ).selectExpr("*", "'q' as length", "1 as level", "2 as sequence_id", "3 as start")
    got = sos.pack_online(docs).collect()
    assert sorted((r["doc_tokens"]) for r in got if r["doc_id"] == 3 and r["start"] == 0) == [2, 2, 2]
    assert sum(r["length"] for r in got if r["doc_id"] == 5) == 2
    assert sum(r["length"] for r in got if r["doc_id"] in (None, 1)) == 2
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert all(n & (n - 1) == 0 for n in fill.values())
    empty = docs.limit(0)
    assert sos.pack_online(empty).collect() == []
    assert sos.padding(sos.pack_online(empty)).first().asDict() == {"sequences": 0, "tokens": 0, "padding": 0}
    with pytest.raises(ValueError):
        sos.Packer(1000)


def test_a_third_of_equal_documents(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', repeat('w ', int(id % 1500))) as text")
    got = sos.pack_online(docs.repartition(7)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert sum(r["start"] == 0 for r in got) == 3000
