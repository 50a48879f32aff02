"""The registered queries of this subpackage and their expected-result SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from txnrisk.llm import bpe, ctw, decontaminate, language, oracles, periodic, pii, quality, repair, sharding, simhash, spotsigs, substring, suffix
from txnrisk.llm.common import documents, encoded, remainder


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: counts per base kind, a digest of the base spans, and all spans."""
    found = pii.detect(documents(spark, sf_dir), into="pii_spans")
    return found.select("doc_id", *[c.alias(n) for n, c in pii.digest(F.col("pii_spans")).items()])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text that repeat a 13-word window of a document with a smaller ID, removed."""
    kept = substring.deduplicate(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text covered by a 400-byte string that occurs anywhere else, removed."""
    kept = suffix.deduplicate(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every whole text and the smallest document ID reachable over links of at most two bits."""
    found = simhash.cluster(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, exactly or edited."""
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 40 shards whose row counts are at most one apart, in random order."""
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(content) + 16).cast("long").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    dealt = sharding.assign(rows, ["doc_id", "size", "text_crc32"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and its likeness to that and to the next document's."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = spotsigs.with_next(docs, {"prints": spotsigs.signatures(F.col("text"))})
    pairs = pairs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "prints", "next_prints", spotsigs.edited(F.col("text"), F.col("next_text")).alias("edited"))
    pairs = pairs.withColumn("edited_prints", spotsigs.signatures(F.col("edited")))
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.as_text(F.col("prints")).alias("fingerprint"), spotsigs.as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        spotsigs.likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the documents outside fold 2 of 4."""
    docs = documents(spark, sf_dir, F.col("lang").cast("string").alias("lang"))
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.train(docs.where(~held))
    found = docs.select("doc_id", held.alias("held_out"), language.identified(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from the labels outside fold 0 of 5."""
    docs = documents(spark, sf_dir)
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held))
    found = docs.select("doc_id", held.alias("held_out"), quality.scored(F.col("text"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token IDs of every whole text and the text decoded from them, as digests."""
    import public_tokenizers

    codec = bpe.Codec(spark, public_tokenizers.path("word_bpe_49k.json"))
    coded = documents(spark, sf_dir).select("doc_id", codec.round_trip(F.col("text"), packed=True).alias("c"))
    return coded.select(
        "doc_id", F.expr("octet_length(c.ids) div 4").cast("long").alias("n_tokens"), F.sha2("c.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("c.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree log probability and smoothed word-frequency score of every whole text, learned outside fold 2 of 7."""
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return ctw.score(documents(spark, sf_dir), ~held)


def with_period(doc_id: Column, text: Column) -> Column:
    """The words of a text, joined by one blank; those of one document in ten are made periodic from some word on (none without an ID)."""
    @F.arrow_udf("string")
    def run(hashes: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, words in zip(hashes.to_pylist(), (t.split() for t in encoded(texts))):
            n = len(words)
            if h is not None and h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                block = words[a:a + p]
                words = words[:a] + (block * (-(-(n - a) // p)))[:n - a]
            out.append(b" ".join(words).decode())
        return pa.array(out, pa.string())

    return run(F.crc32(doc_id.cast("string").cast("binary")), text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, some made periodic first: number, most repetitive run, digests of runs and collapsed text."""
    docs = documents(spark, sf_dir).select("doc_id", with_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.detect(docs).select("doc_id", "periodic.*")
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.aggregate("runs", none, lambda best, r: F.when(best.isNull() | more(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations damaged by a hash of conversation and turn, and their cheapest repairs."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    damaged = rows.withColumn("fault", fault).where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    found = repair.report(damaged).alias("r")
    every = rows.select("conv_id").distinct().alias("l")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.expr("l.conv_id <=> r.conv_id"), "left").select(
        "l.conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


# What SQL can state of queries that it cannot state as a whole.

def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of ``op1_pii``."""
    return op1_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def shard_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of ``op6_sharding``, and whether its law holds and its slots have no gaps."""
    found = op6_sharding(spark, sf_dir)
    per = found.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots"), F.max("law").alias("law"))
    gapless = (F.col("first") == 0) & (F.col("last") == F.col("n") - 1) & (F.col("slots") == F.col("n"))
    return per.agg(
        F.sum("n").alias("documents"), F.count("*").alias("shards"), F.sum("bytes").alias("bytes"),
        ((F.max("n") - F.min("n") <= 1) & (F.max("law") == "rows") & (F.min("law") == "rows")).alias("law_holds"), F.bool_and(gapless).alias("slots_gapless"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts of ``op7_document_fingerprints``."""
    return op7_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op12_periodic_runs`` with -1 for the numbers that a document without runs lacks."""
    found = op12_periodic_runs(spark, sf_dir)
    return found.withColumns({c: F.coalesce(c, F.lit(-1)).cast("long") for c in ("start", "length", "period", "exponent_milli")})


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and base score of ``op11_context_tree_lm``."""
    return op11_context_tree_lm(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's last stage over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_substring_dedup, op3_suffix_array_dedup, op4_simhash_near_dedup, op5_benchmark_decontamination, op6_sharding, op7_document_fingerprints,
    op8_language_id, op9_quality_classifier, op10_bpe, op11_context_tree_lm, op12_periodic_runs, op13_conversation_repair, pipeline, pii_counts, shard_law, edited_texts, periodic_runs, lm_base_scores,
)}
ORACLES: dict[str, str] = {
    "op2_substring_dedup": oracles.SUBSTRING, "periodic_runs": oracles.PERIODIC, "pii_counts": oracles.PII_COUNTS, "edited_texts": oracles.EDITED_TEXTS,
    "shard_law": oracles.SHARD_LAW, "lm_base_scores": oracles.BASE_SCORES,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
