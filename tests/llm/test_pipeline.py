import random
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from appendlake.llm import mixing

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 200))]
        if i % 10 == 0:
            words[3] = "nastyword"
        if i % 7 == 0:
            words.append(f"mail me{i}@example.com")
        rows.append((i, " ".join(words), "en", ["a", "b", None][i % 3], 0))
        labels.append((i, 1, int(i % 10 == 0)))
    near = rows[1][1].split()
    near[len(near) // 2] = "changed"
    rows += [(1000, rows[1][1], "en", "a", 0), (1001, " ".join(near), "de", "b", 0), (1002, None, None, None, None), (1003, "", "en", "a", 0)]
    place = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_stages_against_plain_python(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, results[-1], folder).write.parquet(f"{tmp_path}/{name}")
        results.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(r.columns == docs.columns for r in results[1:-1])
    rows = [{(r.doc_id, r.text) for r in r.select("doc_id", "text").collect()} for r in results[:-1]]
    ids = [{i for i, _ in r} for r in rows]
    assert ids[0] - ids[1] == {i for i in ids[0] if i % 10 == 0 and i < 1000}
    # Copies of document 1 go; of the two texts without words the first stays.
    assert ids[1] - ids[2] == {1000, 1001, 1003}
    for doc_id, text in rows[3]:
        before = dict(rows[2])[doc_id]
        assert text == (before and before.replace(f"me{doc_id}@example.com", "<EMAIL>"))
    mix = results[4].collect()
    sizes = defaultdict(int)
    for r in results[3].collect():
        sizes[r.source] += len((r.text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s, target in zip(names, mixing.targets([sizes[n] for n in names])):
        assert abs(sum(len((r.text or "").split()) for r in mix if r.source == s) - target) <= 100
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = results[5].collect()
    assert sum(r.length for r in packed) == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mix)
    for r in packed:
        assert r.length == len(r.ids) and r.offset + r.length <= 2048


def test_further_columns_pass_through(spark, folder):
    """Names that operators use themselves, a dotted one and one that differs in its case only."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["size", "Score", "row", "a.b", "copies", "h", "spans", "c", "further_columns", "target"]
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    rows = spark.conf.get(corpus_pipeline.ARROW_ROWS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in found for n in names)
    spark.conf.set(corpus_pipeline.ARROW_ROWS, rows)


def test_batches_of_long_texts(spark):
    """A batch of whole texts is bounded by bytes, not by rows alone."""
    before = {c: spark.conf.get(c) for c in (corpus_pipeline.ARROW_ROWS, corpus_pipeline.ARROW_BYTES)}
    try:
        corpus_pipeline.batches_of(spark, 10_000)
        texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
        sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long")
        sizes = [r.n for r in sizes.collect()]
        assert sum(sizes) >= 300 * 100_000 and max(sizes) <= corpus_pipeline.BATCH_BYTES + 200_000
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_no_documents(spark, folder, name):
    assert STAGES[name](spark, spark.createDataFrame([], DOCUMENTS), folder).count() == 0


def test_registered():
    names = list(contract.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names
