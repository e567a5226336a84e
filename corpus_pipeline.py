"""From raw documents to encoded training text in five stages, each written as Parquet and read again by the next.

quality classifier -> line dedup -> n-gram Jaccard join -> benchmark decontamination -> SentencePiece encoding.

Defined results: a null or empty text is scored as a text without features, has no lines to delete, links with nothing,
is clean and encodes to the begin and end ids; texts of any length count whole; of near copies the smallest id stays, of
two texts with that id the one with the smaller hash; rows with the same id and text become one in the third stage and
are treated alike before it; an empty table stays empty with its columns; all but the last stage keep every column as it
is, whatever its name, but for a shortened text and the n_chars of its row.
"""

from __future__ import annotations

from pathlib import PurePosixPath
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.decontam import drop_contaminated
from marlstone.llm.jaccard import keep_one
from marlstone.llm.linededup import dedup_lines
from marlstone.llm.pieces import encode_documents
from marlstone.llm.quality import fit_quality_model, keep_good
from marlstone.llm.shipping import quoted, shared_folder, unused


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more. Labels of held-out ids are never learnt from."""
    return keep_good(docs, fit_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of line runs of 50 words or more are deleted; a document that loses all its words goes."""
    names = unused(docs, "lines_before"), unused(docs, "lines_deleted")
    whole = F.col(names[1]) == 0
    counted = dedup_lines(docs, counts=True, names=names).filter(whole | F.col("text").rlike(r"\S"))
    return counted.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*map(quoted, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; repeated rows are one document."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), full=True).drop("decoded")


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]
#: A fitted classifier and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between them is kept in the shared checkpoint folder."""
    folder = PurePosixPath(f"pipeline-{uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        at = f"{shared_folder(spark)}/{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
