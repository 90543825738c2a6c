"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm import (
    chat, compression, decontamination, html_text, imatch, language, mixing, ngram_join, secrets, sharding, toxicity, trie, whitening,
)
from lamella.llm.common import documents, id_fold, staged
from lamella.llm.oracles import CHAT_FORMAT, MAIN_TEXT, NGRAM_GROUPS, PREFIX_TRIE

Query = Callable[[SparkSession, str], DataFrame]


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.col("placed")
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        sharding.jump("doc_id", 16).alias("placed"),
    ).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), placed["shard"].alias("shard"), placed["grown"].alias("grown_shard"))
    return sharding.with_slots(rows).withColumn("slot", F.col("slot").cast("long"))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = compression.fit(docs, documents(spark, sf_dir, "labels"), keep=~compression.held_out())
    return docs.select(
        "doc_id", compression.held_out().alias("held_out"), compression.scorer(model)(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    profiles = language.learn_profiles(docs, keep=~language.held_out())
    return language.identify(docs, profiles).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added spans are the opaque tokens that look live; of the base ones none is taken away."""
    found = secrets.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "opaque")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k).alias(f"n_{k}")
    return found.select(
        "doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.filter("spans", lambda s: (s["kind"] != "opaque") | s["live"])).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_copied"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return imatch.compare_with_edits(docs, imatch.learn_lexicon(docs))


def op6_ngram_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.group_by_ngrams(documents(spark, sf_dir), n=3, percent=90)


def op7_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"), keep=~toxicity.held_out())
    return docs.select(
        "doc_id", toxicity.held_out().alias("held_out"), toxicity.scorer(model)(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    own = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], own.schema)
    chats = chat.format_chats(own.unionByName(probe))
    read = chats.withColumn("turns", chat.parse_chats(chats)).withColumn("spans", chat.loss_spans())
    learnt = F.array_join(F.transform("spans", lambda s: chat.unescape(
        F.col("formatted").substr(s["start"] + 1, s["end"] - s["start"]))), "")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.withColumn("learnt", learnt).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, epochs=2.0)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.usable(documents(spark, sf_dir, "embeddings"), "embedding").select("vec_id", whitening.grid("embedding").alias("x"))
    model = whitening.fit(rows, components=16)
    shares = model.values / model.trace if model else []
    known = F.array(*(F.lit(float(s)) for s in shares)).cast("array<double>")
    done = whitening.whiten(rows, model, "x") if model else rows.select(
        "vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"), F.col("value").alias("whitened"),
        F.get(known, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.learn_weights(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations open with up to three turns of the first one of their block of twenty."""
    slim = staged(trie.digest_turns(documents(spark, sf_dir, "conversations")), "trie-turns")
    conv = F.col("conv_id")
    return trie.trie(trie.share_openings(slim, base=conv - conv % 20, taken=id_fold("conv_id", 4), most=3))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_jump_shards, op2_compression_quality, op3_language_profiles, op4_secret_ownership, op5_imatch, op6_ngram_groups, op7_counterfactual_toxicity,
    op8_chat_format, op9_benchmark_leaks, op10_mix_sources, op11_embedding_whitening,
    op12_main_text, op13_prefix_trie)}
ORACLES: dict[str, str] = {
    "op6_ngram_groups": NGRAM_GROUPS, "op8_chat_format": CHAT_FORMAT, "op12_main_text": MAIN_TEXT, "op13_prefix_trie": PREFIX_TRIE}
