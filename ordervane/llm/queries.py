"""The queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from . import (
    byte_bpe,
    decontaminate,
    hyperminhash,
    language_id,
    line_dedup,
    lm_score,
    neighbours,
    periodic_runs,
    personal_data,
    substring_dedup,
    suffix_array,
    va_clusters,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_language_id(spark, folder):
    """The language of every document, learned from the labelled ones of four fifths."""
    docs = _table(spark, folder, "documents").withColumn("held_out", language_id.held_out())
    net = language_id.train(docs.filter(~F.col("held_out")))
    return language_id.label_languages(docs, net, keep=["doc_id", "held_out"])


@query
def op2_decontaminate(spark, folder):
    """Every passage that a document shares with a benchmark item."""
    return decontaminate.find_passages(spark, _table(spark, folder, "documents"), _table(spark, folder, "benchmark"),
                                       scratch_folder(spark, "seeds"))


@query
def op3_lm_score(spark, folder):
    """Every document's log-probability, learned from four fifths of the documents."""
    docs = _table(spark, folder, "documents")
    place = scratch_folder(spark, "lm")
    model = lm_score.train(spark, docs.filter(lm_score.trained_on()), f"{place}/counts")
    scored = lm_score.score(spark, docs, model, f"{place}/counts", f"{place}/texts")
    return scored.select("doc_id", (~lm_score.trained_on()).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


@query
def op4_neighbours(spark, folder):
    """The 20 nearest vectors of every twentieth one."""
    found = neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, most=20)
    return found.withColumn("query_id", F.col("query_id").cast("bigint")).withColumn("vec_id", F.col("vec_id").cast("bigint"))


@query
def op5_substring_dedup(spark, folder):
    """Words left in every document without runs that earlier documents have."""
    docs = _table(spark, folder, "documents")
    cut = substring_dedup.remove_repeats(spark, docs, scratch_folder(spark, "substrings"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_byte_bpe(spark, folder):
    """Token count and digests of every document's tokens and of the bytes they decode to."""
    coded = byte_bpe.decode(byte_bpe.encode(_table(spark, folder, "documents")))
    return coded.select(
        "doc_id", byte_bpe.n_tokens("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_hyperminhash(spark, folder):
    """The class of near copies of every document, on shingles of four words."""
    docs = _table(spark, folder, "documents")
    return hyperminhash.near_duplicates(spark, docs, scratch_folder(spark, "near"), words=4, percent=80)


@query
def op8_warc(spark, folder):
    """All pages written as archives and read back."""
    pages = _table(spark, folder, "pages")
    place = scratch_folder(spark, "warc")
    warc.write_archives(warc.classify(pages), place, warc.train_dictionary(pages))
    read = warc.read_archives(spark, place)
    key = pages.schema["page_id"].dataType
    response = F.col("record_type") == "response"
    return read.select(
        F.col("name").cast(key).alias("page_id"), "payload_bytes",
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast(key).alias("refers_to"),
    )


@query
def op9_suffix_array(spark, folder):
    """Bytes left in every document without strings that occur elsewhere."""
    docs = _table(spark, folder, "documents")
    cut = suffix_array.remove_repeats(spark, docs, scratch_folder(spark, "suffixes"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_line_dedup(spark, folder):
    """Lines left in every document without those that an earlier line equals up to one edit."""
    docs = _table(spark, folder, "documents")
    cut = line_dedup.remove_lines(spark, docs, scratch_folder(spark, "lines"))
    return cut.select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_repair_runs(spark, folder):
    """The periodic runs of words of every document, a tenth of which get a periodic end first."""
    number = F.crc32(F.col("doc_id").cast("string"))
    seed = F.when(number % 10 == 0, F.floor(number / 10))
    found = periodic_runs.find_periodic_runs(_table(spark, folder, "documents"), tail_seed=seed)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", periodic_runs.longest_run()).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_personal_data(spark, folder):
    """Personal data of every document, by patterns (counts, digest) and with what the model adds (spans)."""
    docs = _table(spark, folder, "documents")
    found = personal_data.find_personal_data(docs, personal_data.train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in personal_data.KINDS], F.sha2(personal_data.span_text(base), 256).alias("base_sha256"),
        personal_data.span_text(F.col("spans")).alias("spans"),
    )


@query
def op13_va_clusters(spark, folder):
    """The cluster of every vector after three rounds, with the sums of squared distances."""
    place = scratch_folder(spark, "clusters")
    found = va_clusters.cluster_vectors(spark, _table(spark, folder, "embeddings"), place)
    return va_clusters.with_inertia(spark, found, place).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.concat_ws(",", "centroid"), 256).alias("centroid_sha256"),
    )
