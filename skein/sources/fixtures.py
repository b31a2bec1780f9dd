"""Adapters from the driver tables to the news-domain inputs (FIXTURES.md §2).

Each adapter is a Spark plan over the given parquet tables, so its size grows with
them. Article entities and tf-idf maps are taken from the whole document text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.constants import CATEGORY_NAMES
from skein.functions.text import epoch_s

# Fixed parameters of the test scenario.
LANG = "en"
BATCH_TS = dt.datetime(2024, 1, 31)
WINDOW_START_TS = dt.datetime(2024, 1, 28)
LAST_TS = dt.datetime(2024, 1, 29)  # previous refresh for the incremental scenarios
USER_FILTER = "v1"
N_TOP = 5
N_CANDIDATES = 10
ENTITY_SCALAR = 0.5
RECLOG_TEMPLATE = "reclog:%s"
RESULT_TEMPLATE = "rec:%s"
EXPIRE_HOURS = 6
MODEL_KEY = "model_click"

# Names of the 20 document sources: the known categories and seven others.
SOURCE_NAMES = [*CATEGORY_NAMES, "photo", "video", "joke", "local", "quiz", "deal", "misc"]

DATA_START_TS = dt.datetime(2024, 1, 1)


def _data_start() -> F.Column:
    return F.lit(DATA_START_TS).cast("timestamp_ntz")


# Tables whose rows carry heavy work; a bench over single-file tables may spread them.
HEAVY = {"documents", "events"}
SPREAD_CONF = "skein.fixtures.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(SPREAD_CONF, None)
    return df.repartition(int(parts)) if parts and name in HEAVY else df


def n_documents(spark: SparkSession, sf_dir: str) -> int:
    """Number of documents, over which event article ids are spread."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def _hours_after_start(n) -> F.Column:
    return F.timestamp_add("HOUR", n.cast("int"), _data_start())


def art(spark: SparkSession, sf_dir: str, with_maps: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Article profiles: one row per document (the profile collection), or of the articles ``ids`` alone."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    if ids is not None:
        # Here, since the optimizer does not push a semi join below the tokenising projection.
        d = d.join(ids.select(F.col(ids.columns[0]).cast("bigint").alias("doc_id")), "doc_id", "left_semi")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    names = F.array(*[F.lit(n) for n in SOURCE_NAMES])
    own = F.array(F.element_at(names, F.substring("source", 4, 10).cast("int") + 1))
    vec = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x))
    out = (
        d.join(lab, "doc_id", "left")
        .join(emb, "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("article_seq_id"),
            _hours_after_start((F.col("doc_id") * 37) % 720).alias("crawled_at"),
            (F.coalesce(F.col("quality"), F.lit(1)) == 1).alias("usable"),
            F.when(F.col("doc_id") % 50 == 7, F.lit(None).cast("array<string>"))
            .when(F.col("doc_id") % 5 == 0, F.concat(own, F.array(F.lit("cricket"))))
            .otherwise(own)
            .alias("category"),
            F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), 0).alias("title_name_entities"),
            F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0).alias("content_name_entities"),
            vec.alias("text_vector"),
            F.transform(vec, lambda x: F.try_divide(x, norm)).alias("title_vector"),
        )
    )
    if not with_maps:
        return out
    return with_tfidf_maps(out)


def with_tfidf_maps(profiles: DataFrame, kinds=("title", "content")) -> DataFrame:
    """Add ``<kind>_name_entities_tfidf`` map columns for the given profile rows.

    Maps are built only for the rows passed in: filter first (a scan's window), then
    build. Every map column is present; kinds not requested are empty maps.
    """
    empty = F.create_map().cast("map<string,double>")
    out = profiles
    for kind in ("title", "content"):
        name = f"{kind}_name_entities_tfidf"
        if kind not in kinds:
            out = out.withColumn(name, empty)
            continue
        m = (
            entity_tfidf(profiles, kind)
            .groupBy("article_seq_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("entity", "tfidf"))).alias(name))
        )
        out = out.join(m, "article_seq_id", "left").withColumn(name, F.coalesce(F.col(name), empty))
    return out


def entity_tfidf(profiles: DataFrame, kind: str = "content") -> DataFrame:
    """Long-form tf-idf of an entity list: weight = occurrences / list length; keys keep case."""
    col = f"{kind}_name_entities"
    # explode_outer + a null filter: a plain explode makes the optimizer infer
    # ``size(list) > 0`` and push it below the projection, tokenising every text twice.
    return (
        profiles.select("article_seq_id", F.explode_outer(col).alias("entity"), F.size(col).alias("n"))
        .where(F.col("entity").isNotNull())
        .groupBy("article_seq_id", "entity")
        .agg((F.count(F.lit(1)).cast("double") / F.max("n")).alias("tfidf"))
    )


def recrawled(profiles: DataFrame) -> DataFrame:
    """Later crawls of some articles: a day on, under another category."""
    again = profiles.where(F.col("article_seq_id").cast("bigint") % 20 == 3)
    return again.withColumn("crawled_at", F.timestamp_add("DAY", F.lit(1), F.col("crawled_at"))).withColumn(
        "category", F.array(F.lit("health")))


def art_crawls(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """The profile collection with articles that were crawled twice."""
    a = art(spark, sf_dir, ids=ids)
    return a.unionByName(recrawled(a))


def article_of(n_docs: int) -> F.Column:
    """Article of an event: a third of the events meet 100 hot articles, the others any document."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return F.when(F.col("event_id") % 3 == 0, k.cast("bigint")).otherwise((F.col("event_id") * 31 + k) % n_docs)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines (event_id, line): reads, refreshes, foreign-language reads, non-user lines."""
    return lines_from_events(table(spark, sf_dir, "events"), n_documents(spark, sf_dir))


def lines_from_events(events: DataFrame, n_docs: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """The event-line encoding of ``events`` rows (works on batch and streaming frames)."""
    e = events.withColumn("k", article_of(n_docs))
    uid = F.col("user_id").cast("string")
    k = F.col("k").cast("string")
    src = F.element_at(F.array(*[F.lit(s) for s in ("main", "hot", "trending", "push")]),
                       (F.col("event_id") % 4).cast("int") + 1)
    click = F.concat(
        F.lit('{"user_seq_id":'), uid, F.lit(',"article_seq_id":'), k,
        F.lit(',"article_type":"article","lang":"en","ts":'), epoch_s(F.col("ts")).cast("string"),
        F.lit(',"source":"'), src, F.lit('","custom_categories":["sports","local"]}'),
    )
    view = F.concat(
        F.lit('{"user_seq_id":'), uid, F.lit(',"article_seq_id":['), k, F.lit(","),
        ((F.col("k") + 1) % n_docs).cast("string"), F.lit(","), ((F.col("k") + 2) % n_docs).cast("string"),
        F.lit('],"article_type":"'),
        F.when(F.col("event_id") % 5 == 0, F.lit("video")).otherwise(F.lit("article")),
        F.lit('","lang":"en","ts":1,"subtype":"x","req_mode":"'),
        F.when(F.col("event_id") % 3 == 0, F.lit("offline")).otherwise(F.lit("online")),
        F.lit('","custom_categories":["cricket"]}'),
    )
    error = F.concat(
        F.lit('{"user_seq_id":'), uid, F.lit(',"article_seq_id":'), k,
        F.lit(',"lang":"hi","ts":1,"source":"main","custom_categories":[]}'),
    )
    other = F.concat(F.lit('{"device_id":'), uid, F.lit("}"))
    line = (
        F.when(F.col("event_type") == "click", click)
        .when(F.col("event_type") == "view", view)
        .when(F.col("event_type") == "error", error)
        .otherwise(other)
    )
    return e.select("event_id", *keep, line.alias("line"))


def torn_lines(lines: DataFrame) -> DataFrame:
    """Event lines of which every eleventh has lost its last character."""
    torn = F.col("line").substr(F.lit(1), F.length("line") - 1)
    return lines.withColumn("line", F.when(F.col("event_id") % 11 == 0, torn).otherwise(F.col("line")))


def lines_with_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the topic they arrive on: clicks on one, everything else on impressions."""
    e = lines_from_events(table(spark, sf_dir, "events"), n_documents(spark, sf_dir), keep=("event_type",))
    return e.select(
        "event_id",
        F.when(F.col("event_type") == "click", F.lit("click")).otherwise(F.lit("impression")).alias("topic"),
        "line",
    )


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("event_id", F.concat(F.lit("(null,"), "line", F.lit(")")).alias("line"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-action lines (event_id, line) from clicks and views."""
    return actions_from_events(table(spark, sf_dir, "events"))


def actions_from_events(events: DataFrame) -> DataFrame:
    e = events.where(F.col("event_type").isin("click", "view"))
    version = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"version":"v'), (F.col("event_id") % 3).cast("string"), F.lit('"'))
    )
    line = F.concat(F.lit('{"user_seq_id":'), F.col("user_id").cast("string"), version,
                    F.lit(',"custom_categories":[]}'))
    return e.select("event_id", line.alias("line"))


def rec_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items already shown: (user, item), one row per purchase at most."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(F.col("user_id").cast("string").alias("user"),
                    article_of(n_documents(spark, sf_dir)).cast("string").alias("item")).distinct()


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    extra = F.element_at(F.array(*[F.lit(x) for x in ("sports", "cricket", "youtubes", "local", "national")]),
                         (F.col("c_custkey") % 5).cast("int") + 1)
    return c.select(
        F.col("c_custkey").cast("string").alias("user_seq_id"),
        _hours_after_start((F.col("c_custkey") * 53) % 720).alias("updated_at"),
        F.array(F.lower("c_mktsegment"), extra).alias("custom_categories"),
    )


def user_profile_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later version of some user profiles (customers with a positive balance)."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    nation = F.element_at(F.array(*[F.lit(x) for x in SOURCE_NAMES]), (F.col("c_nationkey") % 20).cast("int") + 1)
    return c.select(
        F.col("c_custkey").cast("string").alias("user_seq_id"),
        _hours_after_start((F.col("c_custkey") * 53) % 720 + 24).alias("updated_at"),
        F.array(nation).alias("custom_categories"),
    )


def model_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published model paths: (model_key, published_at, path)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("model_"), F.col("event_type")).alias("model_key"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("published_at"),
        F.concat(F.lit("models/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")).alias("path"),
    )


# --- synthetic model state, by arithmetic so an oracle can repeat it -------------

def state_global(spark: SparkSession) -> DataFrame:
    """Global category weights ``g:c`` (13 rows, one per vocabulary slot)."""
    return spark.range(13).select(
        F.col("id").cast("int").alias("c"),
        ((((F.col("id") * 7) % 13) - 6) / 10.0).alias("weight"),
    )


def state_user_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-category weights ``u:user:c`` for every known user (customer) and slot."""
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return users.select(
        F.col("user_id").cast("string").alias("user"),
        F.explode(F.sequence(F.lit(0), F.lit(12))).alias("c"),
        "user_id",
    ).select("user", "c", ((((F.col("user_id") * 13 + F.col("c") * 7) % 41) - 20) / 100.0).alias("weight"))


def state_item_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item weights ``i:item`` for documents that carry a label row (others miss -> 0)."""
    lab = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return lab.select(
        F.col("doc_id").cast("string").alias("item"),
        ((((F.col("doc_id") * 31) % 101) - 50) / 100.0).alias("weight"),
    )


def old_user_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that every known user (customer) holds from earlier batches."""
    tag = F.concat(F.lit("tag"), (F.col("c_custkey") % 7).cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user"), F.explode(F.array(F.lit("the"), F.lit("The"), tag)).alias("entity"))


def state_user_entity(user_entities: DataFrame, *more: str) -> DataFrame:
    """User-tag weights for each (user, entity), with the columns ``more``."""
    return user_entities.select(
        *more, "user", "entity",
        ((((F.col("user").cast("bigint") * 5 + F.length("entity") * 3) % 21) - 10) / 100.0).alias("weight"),
    )


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of every document (whole texts split at newlines)."""
    return table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))


def doc_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a per-document record: the crawl (lang) and a later label (quality)."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("value"))
    lab = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("value"))
    base = _hours_after_start((F.col("doc_id") * 37) % 720)
    return (d.select(F.col("doc_id").cast("string").alias("key"), base.alias("ts"), "value")
            .unionByName(lab.select(F.col("doc_id").cast("string").alias("key"),
                                    F.timestamp_add("HOUR", F.lit(1), base).alias("ts"), "value")))


def refresh_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, target_ms, last_ms): batch times since the data start and the previous refresh."""
    from skein.functions.text import epoch_ms
    e = table(spark, sf_dir, "events")
    target = epoch_ms(F.col("ts")) - epoch_ms(_data_start())
    last = F.when(F.col("event_type") == "signup", F.lit(-1).cast("bigint")).otherwise(
        target - F.floor(F.col("value")) * 3_600_000)
    return e.select("event_id", target.alias("target_ms"), last.alias("last_ms"))
