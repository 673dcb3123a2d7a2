"""The queries of these operators, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.llm import alignment, conversations, cws, hosts, mixing, packing, pii, sharding, simhash, token_counts, topk, toxicity, word_bpe
from appendlake.llm.inputs import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 3 or fewer differing bits."""
    prints = simhash.fingerprints(table(spark, sf_dir, "documents"))
    found = simhash.groups(prints, simhash.Index())
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens, packed into as few sequences of 2048 as it can."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents"), path, with_ids=False))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    rows = mixing.placed(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.size("copies")).cast("long").alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all whole texts, learned from the labels of four fifths of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = toxicity.trained(toxicity.labelled(docs, table(spark, sf_dir, "labels"), ~held_out))
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector with all others."""
    return topk.top_k(topk.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all whole texts."""
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent weighted samples of all texts and of their edited texts."""
    return cws.edited(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all whole texts; counts are of the base spans."""
    rows, _ = pii.found(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    digest = F.sha2(pii.shown(base).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *[count(k) for k in pii.KINDS], digest, pii.shown(F.col("spans")).alias("spans"))


def op9_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls: rules, else the host's trust and distrust."""
    return hosts.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts of shards differ by one at most."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return sharding.sharded(rows, ["doc_id", "text_crc32", "size"], 16).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over all whole texts, and how common the links are."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = alignment.aligned(table(spark, sf_dir, "documents"), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return alignment.counted(rows.withColumn("groups_sha256", digest).drop("groups"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by checksum: faults, the cheapest repair, and the repaired text."""
    rows = table(spark, sf_dir, "conversations")
    return conversations.checked(rows, conversations.damaged(rows))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all whole texts and the texts they decode to."""
    rows = word_bpe.coded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digest = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_packing, op3_mixing, op4_toxicity, op5_topk, op6_token_counts, op7_fingerprints, op8_pii, op9_hosts, op10_sharding, op11_alignment, op12_conversations, op13_word_bpe)
}
SQL: dict[str, str] = {
    "op5_topk": """
        WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
                  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 20""",
}
