"""Publishing ranked lists and messages (SNK-08..11, SRC-20, SRC-21).

The key-value store of the original is modelled as tables: a published-list
table replaced per user (delete old list, write the new one with an expiry),
a rec-log table of shown items, and a model-pointer table. A publish is one
set operation per batch, idempotent when keyed by batch id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.constants import HOUR_SECONDS
from skein.functions.text import fmt6, key_template, r6


def publish(old: DataFrame, batch_users: DataFrame, new_rows: DataFrame, batch_ms: int, expire_hours: int,
            result_template: str) -> DataFrame:
    """SNK-10: ``old LEFT ANTI batch users UNION new`` with key and expiry.

    Every user of the batch loses the old list, even when the new one is empty (Q16).
    """
    expires = F.lit(batch_ms + expire_hours * HOUR_SECONDS * 1000).cast("bigint")
    new = new_rows.select("user", key_template(result_template, F.col("user")).alias("key"), "item",
                          F.col("rank").cast("bigint").alias("rank"), "score", expires.alias("expires_ms"))
    kept = old.join(batch_users.select("user").distinct(), "user", "left_anti").select(*new.columns)
    return kept.unionByName(new)


def reclog_lookup(users: DataFrame, rec_log: DataFrame) -> DataFrame:
    """SRC-20: each user with the items already shown (NULL item when none); no driver collect."""
    return users.select("user").join(rec_log.select("user", "item"), "user", "left")


def latest_model_path(pointers: DataFrame) -> DataFrame:
    """SRC-21: newest path per model key (ties: greatest path), a map-side-combinable max."""
    return pointers.groupBy("model_key").agg(F.max(F.struct("published_at", "path")).alias("m")).select(
        "model_key", F.col("m.path").alias("path"))


def json_payload(df: DataFrame, key: Column, fields: list[str]) -> DataFrame:
    """SNK-11 default serializer: ``key`` and ``to_json`` of the fields, ready for a Kafka-style sink."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def fixed_payload(df: DataFrame, key: Column) -> DataFrame:
    """SNK-11 serializer with fixed six-decimal scores (stable text across consumers)."""
    value = F.to_json(F.struct("user", "item", "rank", r6(F.col("score")).cast("decimal(38,6)").alias("score")))
    return df.select(key.cast("string").alias("key"), value.alias("value"))


def write_messages(payload: DataFrame, fmt: str = "kafka", **options) -> None:
    """Send (key, value) rows through any sink format (``kafka`` when its connector is present)."""
    payload.write.format(fmt).options(**options).save()


def rec_feature_blocks(recs: DataFrame) -> DataFrame:
    """SNK-08: one text block per user — the user, then ``item<TAB>score<TAB>explanation`` by rank.

    The per-user list is bounded by N, so collecting it per user is safe.
    """
    line = F.concat_ws("\t", F.col("item"), fmt6(F.col("score")), F.coalesce(F.col("explanation"), F.lit("")))
    g = recs.groupBy("user").agg(F.sort_array(F.collect_list(F.struct(F.col("rank"), line.alias("l")))).alias("xs"))
    return g.select("user", F.concat_ws("\n", F.col("user"), F.array_join(F.transform("xs", lambda x: x["l"]), "\n"))
                    .alias("block"))


def publication_rows(batch_users: DataFrame, new_rows: DataFrame, batch_ms: int, expire_hours: int,
                     result_template: str) -> DataFrame:
    """One micro-batch's entry in the append-only publication log.

    Each batch user gets its new list plus a tombstone row (item NULL), so that a user
    whose new list is empty still records that its old list is gone (Q16). Appending
    costs only the batch's rows; the full table is never rewritten per batch.
    """
    expires = F.lit(batch_ms + expire_hours * HOUR_SECONDS * 1000).cast("bigint")
    new = new_rows.select("user", key_template(result_template, F.col("user")).alias("key"), "item",
                          F.col("rank").cast("bigint").alias("rank"), "score", expires.alias("expires_ms"))
    tomb = batch_users.select("user").distinct().select(
        "user", key_template(result_template, F.col("user")).alias("key"), F.lit(None).cast("string").alias("item"),
        F.lit(0).cast("bigint").alias("rank"), F.lit(None).cast("double").alias("score"), expires.alias("expires_ms"))
    return new.unionByName(tomb)


def current_lists(log: DataFrame, now_ms: int | None = None) -> DataFrame:
    """The published lists in force: for each user, the rows of the latest batch that touched
    it, without those that have expired by ``now_ms`` (an expired list hides older ones too).

    ``log`` carries a ``batch_id`` column (the partition directory of each append). The
    per-user max combines map-side; the result is also what a compaction writes back.
    """
    latest = log.groupBy("user").agg(F.max("batch_id").alias("batch_id"))
    rows = log.join(latest, ["user", "batch_id"]).where(F.col("item").isNotNull()).drop("batch_id")
    return rows if now_ms is None else rows.where(F.col("expires_ms") > now_ms)


def compact(log: DataFrame, upto_batch: int, path: str, now_ms: int | None = None) -> str:
    """Fold the log's batches ``<= upto_batch`` into one base partition under ``path``.

    The base holds the lists in force at ``upto_batch`` and not expired (users with an
    empty list drop out); later batches appended under the same root still win per user,
    so ``current_lists`` over ``base + later batches`` equals it over the full log.
    """
    base = current_lists(log.where(F.col("batch_id") <= upto_batch), now_ms)
    out = f"{path}/batch_id={upto_batch}"
    base.write.mode("overwrite").parquet(out)
    return out


POINTER = "log_root string, folded long, refresh_ms long, v long"


def load_pointer(spark, root: str):
    """The newest row of a publisher's pointer (log_root, folded, refresh_ms, v), or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(POINTER).parquet(root)
    return rows.orderBy(F.desc("v")).first()


def save_pointer(spark, root: str, log_root: str, folded: int, refresh_ms: int) -> None:
    """A new version of the pointer: where the log is, the last batch folded into its base, and
    when the profiles were last loaded. The version counts once its one file is committed."""
    last = load_pointer(spark, root)
    row = spark.range(1).coalesce(1).select(F.lit(log_root).alias("log_root"), F.lit(folded).cast("long").alias("folded"), F.lit(refresh_ms).cast("long").alias("refresh_ms"))
    row.write.mode("overwrite").parquet(f"{root}/v={0 if last is None else last['v'] + 1}")


def publish_model(spark, pointers: str, model_key: str, path: str, published_ms: int) -> None:
    """Append one row to the pointer table: ``path`` is the newest model of ``model_key``."""
    row = spark.range(1).select(F.lit(model_key).alias("model_key"), F.lit(published_ms).cast("bigint").alias("published_at"),
                                F.lit(path).alias("path"))
    row.write.mode("append").parquet(pointers)
