"""The queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.llm import (
    ann, bpe, chat, decontaminate, langid, line_dedup, lm, merkle, prefix_trie, repeats, simhash, token_counts, url_filter,
)
from billbook.llm.common import table
from billbook.llm.sql import SQL_CHAT, SQL_DECONTAMINATION, SQL_LINE_DEDUP, SQL_MERKLE, SQL_PREFIX_TRIE, SQL_URL_FILTER

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts consist of control strings."""
    own = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    template = chat.ChatTemplate()
    done = chat.format_chats(turns.unionByName(extra), template)
    back = template.parsed(F.col("formatted"))
    loss = template.loss_text(F.col("formatted"), F.col("loss_spans"))
    read = done.select("conv_id", "formatted", back.alias("back"), loss.alias("loss"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list derived from the tables: an event of user u is an entry for the domain of page u.

    A leading www, m or blog is left off. An error blocks the domain, a purchase takes it off the list
    and other events allow it.
    """
    domains = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("user_id"),
        F.regexp_replace(url_filter.url_host(F.col("url")), r"^(www|m|blog)\.", "").alias("list_key"),
    )
    kind = F.col("event_type")
    action = F.when(kind == "error", "block").when(kind == "purchase", url_filter.REMOVED).otherwise("allow")
    return (
        table(spark, sf_dir, "events")
        .join(domains.where("list_key <> ''"), "user_id")
        .select("list_key", F.col("ts").alias("listed_at"), action.alias("action"))
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched when the event of its number happened."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("fetched_at"))
    pages = table(spark, sf_dir, "pages")
    captures = pages.join(events, pages["page_id"] == events["event_id"], "left").select(
        "page_id", "url", "fetched_at"
    )
    done = url_filter.filter_urls(captures, url_list(spark, sf_dir))
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return done.select("page_id", "host", at("fetched_at"), "action", "matched_key", at("listed_since"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def _fold(folds: int, column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id", "n_bytes", total.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _fold(7) == 2
    found = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.learn(docs.where(_fold(3) != 1).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, checked after one was added to n_chars of those that the fold picks."""
    docs = table(spark, sf_dir, "documents")
    record = lambda n: merkle.record_digest([F.col(c) for c in ("doc_id", "source", "lang")] + [n, F.col("text")])
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaves = docs.select(
        "doc_id", "lang", record(F.col("n_chars")).alias("leaf"), F.when(_fold(7) == 0, record(more)).alias("tampered")
    )
    found = merkle.manifest(leaves, "lang", "doc_id", "leaf", ["tampered"])
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with up to three first turns of one in twenty."""
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns, base, _fold(4, "conv_id"), 3))
    return found.withColumnRenamed("saved_words", "saved_tokens")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.with_marks(docs, line_dedup.line_marks(docs))
    kept = line_dedup.kept_text(F.col("text"), F.col("keep"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_byte_level_bpe": op5_byte_level_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_array": op7_suffix_array,
    "op8_simhash": op8_simhash,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": SQL_CHAT,
    "op2_decontamination": SQL_DECONTAMINATION,
    "op3_url_filter": SQL_URL_FILTER,
    "op11_merkle_manifest": SQL_MERKLE,
    "op12_prefix_trie": SQL_PREFIX_TRIE,
    "op13_line_dedup": SQL_LINE_DEDUP,
}
