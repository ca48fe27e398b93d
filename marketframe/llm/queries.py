"""The queries of this package: each applies one operator to its whole table with its default parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import ann, audit, centroids, chat, html, langid, minhash, mixing, packing, quality, sharding, simhash, warc
from marketframe.llm.common import stored
from marketframe.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    statistics = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return quality.assess(docs.select("doc_id", "text"), labels).select("doc.doc_id", *statistics)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.schedule(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text")))))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents")).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), docs.select("doc_id", "text", "lang"))
    return found.select("doc.doc_id", "held_out", "lang_pred", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    # without payloads: small, and parsed once instead of once per kind of record
    records = stored(warc.read_payload_figures(warc.read_records(spark, path)), "warc-records")
    return warc.resolve(warc.assemble(records))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = simhash.label(_table(spark, sf_dir, "documents"))
    return labels.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.label(_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(_table(spark, sf_dir, "embeddings")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html, op2_quality, op3_mixing, op4_neighbours, op5_packing, op6_chat, op7_sharding, op8_language, op9_warc, op10_simhash,
        op11_audit, op12_minhash, op13_centroids,
    )
}

#: Operators that SQL cannot state (trained models, hashes it lacks, iteration) are tested against brute force.
ORACLES = {
    "op3_mixing": mixing.ORACLE, "op5_packing": packing.ORACLE, "op6_chat": chat.ORACLE, "op9_warc": warc.ORACLE,
    "op11_audit": audit.ORACLE, "op13_centroids": centroids.ORACLE,
}
