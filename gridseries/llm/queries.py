"""The registered queries of this package and the SQL that states their results, where SQL can."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm import decontaminate, licenses, lines, lm, merkle, mixing, pieces, quality, scratch, simhash, toxicity, urls, warc, whiten

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_mixing(spark, folder):
    docs = table(spark, folder, "documents")
    # Everything by which rows differ, without the texts themselves.
    sized = scratch.stored(docs.select("doc_id", "source", "lang", mixing.word_count(F.col("text")).alias("words"), *[
        F.xxhash64(F.lit(k), "text").alias(f"text_{k}") for k in (0, 1)]))
    return mixing.mix(sized, F.col("words")).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("placed.shard").alias("shards"))


@query
def op2_quality(spark, folder):
    judged = quality.apply_policy(quality.measure(table(spark, folder, "documents")))
    base_failed = F.col("failures").bitwiseAND(F.lit(quality.BASE)) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "kept", "failures")


def fold() -> Column:
    """The remainder by 5 of the id's checksum; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5


@query
def op3_scoring(spark, folder):
    scored = lm.score(table(spark, folder, "documents"), fold() != 1)
    return scored.select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query
def op4_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


@query
def op5_decontamination(spark, folder):
    pairs = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return pairs.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


@query
def op6_licenses(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    base, method = F.col("base_places"), F.col("detections")

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["place"])).alias("first_word"),
        F.array_max(F.transform(base, lambda b: b["place"])).alias("last_word"),
        joined(F.transform(base, lambda b: b["label"])).alias("base_labels"),
        joined(F.concat(F.transform(base, lambda b: b["label"]), F.transform(method, lambda d: d["label"]))).alias("labels"),
        licenses.confidence(base, method).alias("score"))


@query
def op7_simhash(spark, folder):
    prints = scratch.stored(simhash.fingerprints(table(spark, folder, "documents")))
    return simhash.groups(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_lines(spark, folder):
    cleaned = lines.dedup(table(spark, folder, "documents"), removed="removed_lines", cleaned="kept_text")
    return cleaned.select(
        "doc_id", F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed_lines", lambda i: i.cast("string")), ",").alias("removed_lines"),
        F.md5("kept_text").alias("kept_md5"))


@query
def op9_urls(spark, folder):
    return urls.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op10_warc(spark, folder):
    place = scratch.folder(spark)
    warc.write_arcs(table(spark, folder, "pages"), f"{place}/arc")
    records = warc.convert(spark, f"{place}/arc", f"{place}/warc")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_pieces(spark, folder):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), model, packed=True)
    return pieces.decode(ids.drop("text"), model).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op12_whitening(spark, folder):
    return whiten.whiten(table(spark, folder, "embeddings"))


@query
def op13_merkle(spark, folder):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    docs = table(spark, folder, "documents").select(*fields).withColumn("tampered", F.when(
        hit, merkle.leaf(*[lowered if c == "text" else F.col(c) for c in fields])))
    proven = merkle.manifest(docs, fields, carry=["doc_id", "tampered"])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"), F.col("path"))
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
