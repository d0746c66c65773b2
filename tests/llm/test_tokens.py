import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assaylake.llm import packing, token_counts
from assaylake.llm.tokens import token_count, token_ids

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


ODD = ["", " ", "  x", "x  y\n\n z \n", "<|endoftext|>", "a\x85b c　d\x1c\x1de", "it's I'LL 'S", "½ ² ١٢٣",
       "\0\0", "é" * 300, "a" * 3000, " " * 3000 + "x", "\r\n\t\tx", "👩‍👩‍👧 ok"]


def test_ids_are_those_of_the_json_vocabulary(reference, texts):
    for text in [*ODD, *texts.values()]:
        assert list(token_ids(text)) == reference(text)


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_ids_of_any_text(text):
    t = test_ids_of_any_text
    if not hasattr(t, "reference"):
        t.reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        t.reference.encode_special_tokens = True
    assert list(token_ids(text)) == t.reference.encode(text, add_special_tokens=False).ids


# ---- op1 --------------------------------------------------------------------


def test_histogram_against_brute_force(spark, texts):
    lengths = [token_count(t) for t in texts.values()]
    got = token_counts.token_lengths(spark.read.parquet(f"{SF}/documents.parquet"), limits=[1, 100, 10**6]).collect()
    assert {r["n_tokens"]: r["n_docs"] for r in got if r["n_docs"]} == Counter(lengths)
    assert {1, 100, 10**6} <= {r["n_tokens"] for r in got}
    for r in got:
        limit = r["n_tokens"]
        assert r["docs_upto"] == sum(x <= limit for x in lengths)
        assert r["docs_longer"] == sum(x > limit for x in lengths)
        assert r["tokens_upto"] == sum(x for x in lengths if x <= limit)
        assert r["truncated_tokens"] == sum(min(x, limit) for x in lengths)
        assert r["lost_tokens"] == sum(max(0, x - limit) for x in lengths)
        assert r["share_upto"] == pytest.approx(r["docs_upto"] / len(lengths))


def test_quantiles_are_exact(spark, texts):
    lengths = sorted(token_count(t) for t in texts.values())
    table = token_counts.token_lengths(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["quantile"]: r["n_tokens"] for r in token_counts.length_quantiles(table, [0.0, 0.5, 0.9, 1.0]).collect()}
    assert got == {0.0: lengths[0], 0.5: lengths[len(lengths) // 2 - 1], 0.9: lengths[int(0.9 * len(lengths)) - 1],
                   1.0: lengths[-1]}


def test_histogram_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (1, "x"), (1, "x"), (2, "y " * 9000)], DOCS)
    docs = docs.selectExpr("*", "1 as n_tokens", "2 as block")
    got = {r["n_tokens"]: r["n_docs"] for r in token_counts.token_lengths(docs).collect()}
    assert got == {0: 2, 1: 2, token_count("y " * 9000): 1}
    assert token_counts.token_lengths(docs.limit(0)).collect() == []


def test_blocks_do_not_change_the_sums(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(token_counts.token_lengths(docs).collect())
    monkeypatch.setattr(token_counts, "BLOCK", 50)
    assert sorted(token_counts.token_lengths(docs).collect()) == whole


# ---- op2 --------------------------------------------------------------------


def check_packing(got, texts, reference, capacity=2048):
    ids = {d: [*reference(t or ""), 0] for d, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids.keys()
    for d, pieces in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            raw = b"".join(x.to_bytes(4, "little") for x in ids[d][at : at + r["length"]])
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(raw))
            assert r["length"] == capacity if k else 0 < r["length"] <= capacity
            at += r["length"]
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return by_sequence, sum(map(len, ids.values()))


def test_packing_against_the_ids(spark, texts, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = packing.pack(docs)
    sequences, total = check_packing(packed.collect(), texts, reference)
    assert len(sequences) <= -(-total // 2048) + 1


def test_sequences_hold_the_ids(spark, texts, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = packing.pack(docs)
    rows = packing.sequences(docs, packed).collect()
    held = {r["sequence_id"]: r for r in rows}
    for p in packed.collect():
        r, span = held[p["sequence_id"]], slice(p["offset"], p["offset"] + p["length"])
        assert r["ids"][span] == [*reference(texts[p["doc_id"]]), 0][p["start"] : p["start"] + p["length"]]
        assert set(r["doc_ids"][span]) == {p["doc_id"]}


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (None, ""), (3, "x"), (3, "x"), (3, "y"), (4, "z " * 7000)], DOCS
    ).selectExpr("*", "'q' as length", "1 as __rank", "2 as sequence_id", "3 as piece")
    got = packing.pack(docs).collect()
    assert sum(r["piece"] == 0 for r in got) == 6
    assert sorted(r["length"] for r in got if r["doc_id"] != 4) == [1, 1, 2, 2, 2]
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for (s, o, n), (t, p, _) in zip(spans, spans[1:], strict=False):
        assert p == (o + n if s == t else 0)
    assert packing.pack(docs.limit(0)).collect() == []


def test_a_hot_length_is_ranked_by_many_tasks(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'same text' as text")
    got = packing.pack(docs).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3000
    assert len({r["sequence_id"] for r in got}) == -(-3000 // (2048 // got[0]["length"]))


def optimum(items, capacity):
    """Least number of bins, by search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                go(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=300, deadline=None)
def test_reduction_keeps_the_optimum(items):
    rest = packing._Counts(Counter(items))
    fixed = packing.reduce_dominated(rest, 20)
    left = [s for s, n in rest.n.items() for _ in range(n)]
    placed = Counter(left)
    for members, times in fixed:
        assert sum(members) <= 20
        for s in members:
            placed[s] += times
    assert placed == Counter(items)
    assert sum(t for _, t in fixed) + optimum(left, 20) == optimum(items, 20)


@given(st.dictionaries(st.integers(1, 100), st.integers(1, 500), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_plan_places_every_piece(counts):
    runs, sequences = packing.plan(counts, 100)
    fill = Counter()
    ranks = Counter()
    spans = []
    for r in runs:
        assert r.rank == ranks[r.size]
        ranks[r.size] += r.n
        for k in range(r.n):
            at = (r.sequence + k // r.each, r.offset + k % r.each * r.size)
            spans.append((*at, r.size))
            fill[at[0]] += r.size
    assert ranks == counts
    assert set(fill) == set(range(sequences)) and max(fill.values()) <= 100
    spans.sort()
    for (s, o, n), (t, p, _) in zip(spans, spans[1:], strict=False):
        assert p == (o + n if s == t else 0)
    bins: list[int] = []
    for size in sorted((s for s, n in counts.items() for _ in range(min(n, 20))), reverse=True):
        at = next((k for k, b in enumerate(bins) if b + size <= 100), None)
        if at is None:
            bins.append(size)
        else:
            bins[at] += size
    if max(counts.values()) <= 20:
        assert sequences <= 1.2 * len(bins) + 1


def test_added_tokens_have_their_own_ids(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y", "<|endoftext|", "é <|endoftext|>", *ODD]
    want = dict(enumerate(plain.encode(t, add_special_tokens=False).ids for t in texts))
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    check_packing(packing.pack(docs).collect(), want, lambda ids: ids or [])
    lengths = {r["n_tokens"]: r["n_docs"] for r in token_counts.token_lengths(docs).collect() if r["n_docs"]}
    assert lengths == Counter(map(len, want.values()))
