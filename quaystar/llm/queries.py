"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.llm import class_lm, classifier, conversation_repair, hamming_index, html_text, mixing, packing, private_data, quality_rules, simhash, substring_dedup, token_alignment, warc
from quaystar.llm.common import table

# Parts of the mix; the sources that are not named share one part.
WEIGHTS = {"src0": 24, **{f"src{k}": 6 if k % 5 == 0 else 4 for k in range(1, 20)}}
REST = 1
# Vocabulary files of public tokenizers.
BPE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows, mix = mixing.scheduled(table(spark, folder, "documents"), WEIGHTS, REST)
    return rows.select("doc_id", "source", f"{mix}.*")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows, verdict = quality_rules.judged(table(spark, folder, "documents"))
    names = [*quality_rules.BASE, "base_failed", "kept"]
    return rows.select("doc_id", *[F.col(verdict)[name].alias(name) for name in names])


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.article_texts(table(spark, folder, "pages"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


def op7_private_data(spark: SparkSession, folder: str) -> DataFrame:
    rows, found = private_data.find(table(spark, folder, "documents"))
    base, spans = F.col(found)["base"], F.col(found)["all"]
    return rows.select(
        "doc_id",
        *[private_data.counted(base, kind).alias(f"n_{kind}") for kind in private_data.KINDS[:4]],
        F.sha2(private_data.as_text(base), 256).alias("base_sha256"),
        private_data.as_text(spans).alias("spans"),
    )


def op8_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_hamming_index(spark: SparkSession, folder: str) -> DataFrame:
    return hamming_index.nearest(table(spark, folder, "embeddings"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents")).drop("spans")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, folder, "documents"), BPE_FILE, PIECE_FILE)


def op12_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    return class_lm.scored(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair_report(table(spark, folder, "conversations"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_private_data": op7_private_data,
    "op8_classifier": op8_classifier,
    "op9_hamming_index": op9_hamming_index,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_class_lm": op12_class_lm,
    "op13_conversation_repair": op13_conversation_repair,
}
