"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes each stage's result as
Parquet under ``spark.checkpoint.dir`` and reads it again for the next, so a lost
executor repeats part of one stage at most.

1. language ID: documents without a recognised language go;
2. SimHash near-dedup: of each group of near duplicates the smallest doc_id stays;
3. substring dedup: words of 50-word windows that a smaller doc_id also has go
   from the text; a document that loses all its words goes;
4. mixing: documents are sampled to tempered source, language and topic weights;
5. best-fit packing: what is left is packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.encoding import vocabulary_path
from vigil.llm.langid import predict, prototypes, recognised
from vigil.llm.mixing import mix_documents
from vigil.llm.packing import pack_documents
from vigil.llm.simhash import one_per_group
from vigil.llm.spark import stored, table
from vigil.llm.substring import remove_repeats

#: Part of the tokens that the mixture keeps.
KEEP = 0.8
#: How far a marginal of the mixture may be off, as a part of what is kept.
OFF = 5e-4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = predict(docs, prototypes(docs))
    lang, score = found.columns[-2:]
    return found.where(recognised(F.col(lang), F.col(score), F.col("text"))).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    changed = {
        "text": F.coalesce("kept_text", "row.text"),
        "n_chars": F.when(F.col("kept_text").isNull(), F.col("row.n_chars")).otherwise(
            F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        ),
    }
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, keep=KEEP, tolerance=OFF).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the first stage; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
