"""The operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, embed, fillmiddle, hardneg, linededup
from .decontam import contamination_report
from .embed import near_duplicates
from .fillmiddle import fill_in_middle_digest
from .hardneg import hard_negatives
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .linededup import dedup_lines
from .maintext import extract_main_text
from .pieces import encode_documents
from .quality import fit_quality_model, quality_scores
from .secrets import secret_digest
from .tokencount import token_counts
from .toxicity import fit_toxicity_model, toxicity_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality_model(docs, table(spark, sf_dir, "labels")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths of their own: source, language and a hundred of ids make the folders."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"), ["doc_id"])


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digest(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the rows is filed under the next label, so that near rows of other labels are there to be found."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity_model(docs, table(spark, sf_dir, "labels")))


_ALL = (op1_token_counts, op2_quality, op3_jaccard_join, op4_sentence_pieces, op5_main_text, op6_line_dedup, op7_decontamination, op8_secrets, op9_embedding_dedup, op10_licenses, op11_fill_in_middle, op12_hard_negatives, op13_toxicity)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op6_line_dedup": linededup.ORACLE, "op7_decontamination": decontam.ORACLE, "op9_embedding_dedup": embed.ORACLE, "op11_fill_in_middle": fillmiddle.ORACLE, "op12_hard_negatives": hardneg.ORACLE}
