"""From raw documents to packed training sequences: the stages, each written as Parquet and read again by the next."""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from jobtide import files
from jobtide.llm import decontaminate, minhash, packing, quality_rules, suffix_dedup
from jobtide.llm.arrow import unpacked
from jobtide.sinks.scratch import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicate texts the row with the least id stays."""
    return minhash.keep_texts(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes or more that an earlier document has go, and documents of which nothing remains."""
    return suffix_dedup.remove(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share too much with the benchmark go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens, with their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "source", "lang"])
    return pieces.select(*unpacked(["doc_id", "source", "lang"]), *[c for c in pieces.columns if c != "row"])


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark),
    ("packing", sequences),
]

#: Tokenisers and signatures are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the last one's rows. What a stage read goes when it is written."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            files.delete(spark, f"{folder}/{number - 1}")
    return docs
