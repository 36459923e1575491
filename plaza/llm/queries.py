"""The queries of this subpackage: each applies its operator to a whole table.

``SQL`` has the same results in DuckDB's SQL where SQL can express them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, fill_in_middle, jaccard_join, language_id, lm_score, mixing, piece_codec, pii, quality, substring_dedup, token_counts, view_maintenance
from .common import bucket_of_id, load

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str, pieces: str = PIECES) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, token_counts.load_pieces(pieces)).select("doc_id", "n_pretokens", "n_tokens")


def train_languages(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Dictionaries from the labelled documents that aren't held out."""
    return language_id.train_dictionaries(docs.where(bucket_of_id(of=4) != 2))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), train_languages(docs))
    return found.select("doc_id", F.coalesce(bucket_of_id(of=4) == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find_repeats(load(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "repeated_words", "removed_words", text("repeated_spans").alias("repeated_spans"), text("removed_spans").alias("removed_spans"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(load(spark, sf_dir, "documents"))


#: A conversation whose texts look like control strings, formatted with all others.
TRICKY = r"\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    done = chat_format.format_trees(chat_format.threads(rows.unionByName(tricky)))
    said = F.array_join(F.transform(chat_format.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.read_loss(F.col("formatted"), F.col("loss"))
    return done.select(
        F.col("tree").alias("conv_id"), F.size(chat_format.read_back(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def train_quality(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Ratios of three quarters of the documents labelled good and not toxic, thresholds from the fourth."""
    clean = "quality = 1 and toxic = 0"
    for_threshold = bucket_of_id(of=4) == 3
    return quality.fit(docs, labels.where(clean).where(~for_threshold), labels.where("toxic = 1"), labels.where(clean).where(for_threshold))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, load(spark, sf_dir, "labels"))
    judged = quality.judge(docs, model.ratios, threshold=model.threshold, toxic=model.toxic, toxic_threshold=model.toxic_threshold)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"), F.col("quality_toxicity").alias("toxicity"), F.col("quality_toxic").alias("toxic"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(load(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return drawn.select("doc_id", "source", F.col("mix_block").cast("long").alias("block"), F.round("mix_order", 6).alias("mix_order"), F.col("mix_tokens").alias("n_tokens"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket_of_id(of=10) == 0
    scored = lm_score.score(load(spark, sf_dir, "documents").select("doc_id", "text"), F.coalesce(~held_out, F.lit(False)))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [F.expr(f"cast(size(filter(pii_base, s -> s.kind = '{k}')) as long) as n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(_listed("pii_base"), 256).alias("base_sha256"), _listed("pii_spans").alias("spans"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_in_middle.restored(F.col("fim_text"), F.col("fim_form"))
    return made.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


def op12_view_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view_maintenance.shop_rows(*(load(spark, sf_dir, t) for t in ("clients", "sales", "sale_lines", "vendors", "nation")))
    group, ids = ["region", "part"], ["client_id", "item_id"]
    view = view_maintenance.view_after_batches(view_maintenance.lifetime_cube(rows, group, "revenue", ids), group, ids)
    return view.select(
        "batch", F.col("region").cast("int").alias("region"), "part", F.col("n").alias("n_lines"), F.col("total").alias("revenue"), F.col("least").alias("min_revenue"), F.col("n_client_id").alias("n_clients"), F.col("n_item_id").alias("n_items"),
    )


def op13_piece_codec(spark: SparkSession, sf_dir: str, pieces: str = PIECES) -> DataFrame:
    model = piece_codec.load_model(pieces)
    coded = piece_codec.decode(piece_codec.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text"), model)
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("piece_ids", ","), 256).alias("ids_sha256"), F.sha2("piece_text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_language_id, op3_substring_dedup, op4_jaccard_join, op5_chat_format, op6_quality_rules, op7_mixing, op8_lm_score, op9_pii, op10_decontaminate, op11_fill_in_middle, op12_view_maintenance, op13_piece_codec)
}
