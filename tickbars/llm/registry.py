"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tickbars.llm import chat, collocations, decontaminate, exact_dedup, hard_negatives, html_extract, language_id, lm_scoring, mixing, near_dedup, substring_dedup, token_counts, toxicity
from tickbars.llm.shared import crc_fold, documents, table


def op1_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeated(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    made = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    records = chat.records_of_rows(rows.unionByName(made))
    chats = chat.with_format(chat.canonical_turns(records).select("conv_id", "turns"))
    return chat.digests(chats, ["conv_id"])


def op3_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    mixed = mixing.mix(docs, mixing.repeating_weights(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    learn = toxicity.labelled(docs.where(crc_fold(F.col("doc_id"), 4) != 2), table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, toxicity.fit(learn), name="score")
    return scored.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_decontamination(spark, sf_dir):
    return decontaminate.report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fold = crc_fold(F.col("doc_id"), 7)
    model, counts = lm_scoring.fit(docs.where(fold != 2))
    scored = lm_scoring.with_scores(docs, model, counts, carry=["doc_id"])
    return scored.withColumn("held_out", fold == 2)


def op7_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    fold = crc_fold(F.col("doc_id"), 4)
    model = language_id.fit(docs.where(fold != 2).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = language_id.with_language(docs.select("doc_id", "text"), model, score="score")
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op8_near_dedup(spark, sf_dir):
    return near_dedup.mark_near_copies(documents(spark, sf_dir), k=2)


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(documents(spark, sf_dir))


def op10_html_extract(spark, sf_dir):
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


def op11_hard_negatives(spark, sf_dir):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


def op12_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


def op13_token_counts(spark, sf_dir):
    import public_tokenizers  # where the vocabulary file lies; only this query needs it

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return token_counts.count_tokens(documents(spark, sf_dir), model, ["doc_id"])


QUERIES = {
    query.__name__: query
    for query in (
        op1_substring_dedup,
        op2_chat_format,
        op3_mixing,
        op4_toxicity,
        op5_decontamination,
        op6_lm_scoring,
        op7_language_id,
        op8_near_dedup,
        op9_exact_dedup,
        op10_html_extract,
        op11_hard_negatives,
        op12_collocations,
        op13_token_counts,
    )
}
