"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark
passages, token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet and reads again as the next one's ``docs``. All
but the last return the columns of ``documents``.

* quality_rules: documents that the rules reject go.
* near_duplicates: of each SimHash component the document with the smallest id stays.
* repeated_passages: words inside 35-word windows that start anywhere else too are removed;
  a document that loses none keeps its text as it is, ``n_chars`` follows the text.
* benchmark: documents that hold a benchmark window go.
* token_ids: ids by the byte-level BPE vocabulary and digests of what they decode to.

Null and empty texts fail the quality rules; an empty table runs through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import configure
from skein.llm import byte_bpe, decontaminate, quality_rules, recompress, simhash_cover
from skein.llm.common import Scratch, field, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return simhash_cover.one_of_each(docs, shingle=3, radius=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    done = recompress.remove_repeats(docs, window=35, keep_layout=True)
    new = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(field("n_chars"))}
    return done.select(*[new.get(c, field(c)).alias(c) for c in docs.columns])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = byte_bpe.encode(docs.select("doc_id", "text"), path, pattern, decoded=True)
    return both.select(
        field("doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", good_documents),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("token_ids", token_ids),
]

#: Near duplicates, recompression and BPE have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``."""
    configure(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
