"""Word count, line predicates and hashes over whole document texts (AGG-04, PRJ-10, FN-10/11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions.hashing import md5_bucket, md5_hex
from skein.functions.text import space_words
from skein.plans.oracle_ctes import sql
from skein.plans.registry import query
from skein.sources import fixtures as fx

BUCKETS = 1000


@query("word_count", sql("""
SELECT word, count(*) AS count FROM (
  SELECT unnest(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM doc_lines)
GROUP BY word""", "doc_lines"))
def word_count(spark, d):
    """AGG-04: words split on single spaces (trailing empties dropped, Q11), counted."""
    lines = fx.doc_lines(spark, d)
    return lines.select(F.explode(space_words(F.col("value"))).alias("word")).groupBy("word").count()


@query("lines_containing", sql("""
SELECT count(*) FILTER (WHERE value LIKE '%a%') AS num_a, count(*) FILTER (WHERE value LIKE '%b%') AS num_b FROM doc_lines""",
    "doc_lines"))
def lines_containing(spark, d):
    """PRJ-10: lines containing "a" and "b", counted in one pass."""
    lines = fx.doc_lines(spark, d)
    return lines.agg(F.count_if(F.col("value").contains("a")).alias("num_a"),
                     F.count_if(F.col("value").contains("b")).alias("num_b"))


@query("md5_hex", sql("SELECT doc_id, md5(text) AS md5 FROM documents"))
def md5_hex_q(spark, d):
    """FN-10: lower-case hex MD5 of each whole document text."""
    return fx.table(spark, d, "documents").select("doc_id", md5_hex(F.col("text")).alias("md5"))


@query("md5_bucket", sql(f"SELECT doc_id, CAST(CAST('0x' || md5(text) AS UHUGEINT) % {BUCKETS} AS BIGINT) AS bucket FROM documents"))
def md5_bucket_q(spark, d):
    """FN-11: MD5 as an unsigned 128-bit integer, reduced to a bucket."""
    return fx.table(spark, d, "documents").select("doc_id", md5_bucket(F.col("text"), BUCKETS).alias("bucket"))
