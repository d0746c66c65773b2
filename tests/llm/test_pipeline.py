"""The queries as they are registered, and the pipeline."""

import random
import re

import corpus_pipeline
import pytest
from verification.compare import connect, differences

import __spark_entry__ as entry
from assaylake.llm import cuckoo_lines, importance, oracles, packing, queries
from assaylake.session import settled

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    got = entry.queries()
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= got.keys()
    assert oracles.ORACLES.keys() <= entry.oracle_sql().keys() <= got.keys()


COLUMNS = {
    "op2": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4": "doc_id fingerprint component_id",
    "op6": "page_id url text n_chars",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9": "doc_id n_lines n_dropped kept_sha256",
    "op10": "doc_id held_out score predicted",
    "op11": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op12": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13": "vec_id code error label_error codebooks_sha256",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_queries_return_their_columns(spark, name):
    query = next(f for k, f in queries.QUERIES.items() if k.startswith(f"{name}_"))
    assert set(COLUMNS[name].split()) <= set(query(spark, SF).columns)


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_queries_against_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF), connect(SF), oracles.ORACLES[name]) == []


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    assert names == ("quality", "lines", "near_duplicates", "decontamination", "packing")
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    good = settled(stages[0](spark, docs, SF), "test")
    assert good.columns == docs.columns
    chosen = importance.resample(docs, labels).filter("selected")
    assert ids(good) == ids(chosen)

    cut = settled(stages[1](spark, good, SF), "test")
    assert cut.columns == docs.columns
    want = {r["doc_id"]: r["text"] for r in cuckoo_lines.dedupe_lines(good).collect()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    once = settled(stages[2](spark, cut, SF), "test")
    assert once.columns == docs.columns
    shingles = {}
    for d, t in texts.items():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split()
        shingles[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    kept = ids(once)
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    gone = texts.keys() - kept
    for d in gone:  # only documents with a near copy go
        assert any(similar(shingles[d], shingles[o]) for o in texts if o != d)
    left = sorted(kept)
    assert [(a, b) for k, a in enumerate(left) for b in left[k + 1 :] if similar(shingles[a], shingles[b])] == []

    clean = settled(stages[3](spark, once, SF), "test")
    assert clean.columns == docs.columns
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    unleaked = ids(clean)
    for d in kept:
        text = " ".join(re.findall(r"\w+", texts[d].lower()))
        assert (d in unleaked) == (not any(f" {i} " in f" {text} " for i in items))

    packed = stages[4](spark, clean, SF).collect()
    assert {r["doc_id"] for r in packed} == ids(clean)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(
        map(str, packing.pack(clean).drop("sequence_id", "offset").collect())
    )


def test_pipeline_of_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0)]
    rows += [(10 + k, " ".join(rng.choices("one two three four five six seven".split(), k=30)), "en", "hot", 1)
             for k in range(30)]
    rows += [(50 + k, "a hot copy of the same text " * 3, None, "hot", 84) for k in range(20)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    sf = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{sf}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    # of the equal lines the last stays; the others' texts are empty then, and copies of the empty text of 1
    assert {None, 1, 69} <= packed and not packed & {2, *range(50, 69)}
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
