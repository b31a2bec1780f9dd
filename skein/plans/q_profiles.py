"""Profile scans and encoders (SRC-01..16, FN-01..06, PRJ-01/02/03/07, JN-01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import encode as E
from skein.plans import common as C
from skein.plans.oracle_ctes import WINDOW, enc, idx_str, no_null, sql
from skein.plans.registry import query
from skein.sources import fixtures as fx
from skein.sources import profiles as P


@query("instance_profile_join", sql(f"""
SELECT i."user", i.item, i.label, p.article_seq_id IS NOT NULL AS has_profile, {idx_str('p.cat')} AS category_idx
FROM inst i LEFT JOIN prof p ON p.article_seq_id = i.item""", "inst", "prof"))
def instance_profile_join(spark, d):
    """JN-01: instances ⟕ window profiles on item; misses keep neutral (empty) features."""
    prof = C.window_profiles(spark, d)
    j = C.instances(spark, d).join(prof.withColumnRenamed("article_seq_id", "item"), "item", "left")
    return j.select("user", "item", "label", F.col("category_idx").isNotNull().alias("has_profile"),
                    E.idx_string("category_idx").alias("category_idx"))


def _valid(col="category"):
    return f"{no_null(col)} AND article_seq_id IS NOT NULL AND article_seq_id <> ''"


def _vec(name):
    from skein.functions.text import r6
    c = F.col(name)
    return [F.size(c).cast("bigint").alias(f"{name.split('_')[0]}_n"),
            r6(F.aggregate(c, F.lit(0.0), lambda a, x: a + x)).alias(f"{name.split('_')[0]}_sum")]


def _vec_sql(name):
    from skein.plans.oracle_ctes import vsum
    return f"CAST(len({name}) AS BIGINT) AS {name.split('_')[0]}_n, {vsum(name)} AS {name.split('_')[0]}_sum"


CAT = f"{idx_str(enc('category'))} AS category_idx"


@query("profile_category", sql(f"SELECT article_seq_id, {CAT} FROM art WHERE crawled_at > {WINDOW} AND {_valid()}", "art"))
def profile_category(spark, d):
    """SRC-01: id + category vector of profiles crawled after the window start."""
    df = P.profile_category(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("profile_category_usable", sql(
    f"SELECT article_seq_id, {CAT} FROM art WHERE crawled_at > {WINDOW} AND usable AND {_valid()}", "art"))
def profile_category_usable(spark, d):
    """SRC-02: as SRC-01, usable profiles only."""
    df = P.profile_category(fx.art(spark, d), fx.WINDOW_START_TS, usable_only=True)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("profile_by_ids", sql(
    f"SELECT article_seq_id, {CAT} FROM art WHERE article_seq_id IN (SELECT item FROM inst) AND {_valid()}", "art", "inst"))
def profile_by_ids(spark, d):
    """SRC-03: profiles whose id is in a given id set (the items of the instances)."""
    ids = C.instances(spark, d).select("item").distinct()
    df = P.profile_by_ids(fx.art(spark, d), ids)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


USER_VALID = "user_seq_id IS NOT NULL AND user_seq_id <> '' AND " + no_null("custom_categories")


@query("user_categories_since", sql(
    f"SELECT user_seq_id, {idx_str(enc('custom_categories'))} AS category_idx FROM user_profile "
    f"WHERE updated_at > {WINDOW} AND {USER_VALID}", "user_profile"))
def user_categories_since(spark, d):
    """SRC-04: user id + category vector for users updated after the window start (Q4 vocabulary)."""
    df = P.user_categories_since(fx.user_profile(spark, d), fx.WINDOW_START_TS)
    return df.select("user_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("user_categories_full", sql(f"""
SELECT user_seq_id, category_idx, updated_ms FROM (
  SELECT user_seq_id, {idx_str(enc('custom_categories'))} AS category_idx, epoch_ms(updated_at) AS updated_ms,
    row_number() OVER (PARTITION BY user_seq_id ORDER BY updated_at DESC) AS rn
  FROM (SELECT * FROM user_profile UNION ALL SELECT * FROM user_profile_v2) WHERE {USER_VALID})
WHERE rn = 1""", "user_profile", "user_profile_v2"))
def user_categories_full(spark, d):
    """SRC-05: every user's categories, one row per key (latest version wins)."""
    users = fx.user_profile(spark, d).unionByName(fx.user_profile_v2(spark, d))
    df = P.user_categories_full(users)
    return df.select("user_seq_id", E.idx_string("category_idx").alias("category_idx"),
                     C.ms_col("updated_at").alias("updated_ms"))


def _entities_sql(kind, window=True):
    col = f"{kind}_name_entities"
    lowered = f"list_distinct(list_transform({col}, lambda x: lower(x)))"
    where = f"crawled_at > {WINDOW} AND " if window else ""
    return sql(f"""
SELECT article_seq_id, category_idx, unnest(CASE WHEN len(ents) = 0 THEN [NULL] ELSE ents END) AS entity FROM (
  SELECT article_seq_id, {CAT}, {lowered} AS ents FROM art WHERE {where}{_valid()} AND {no_null(col)})""", "art")


def _entities(spark, d, kind):
    df = P.profile_entities(fx.art(spark, d), fx.WINDOW_START_TS, kind)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"),
                     F.explode_outer(f"{kind}_entities").alias("entity"))


@query("profile_title_entities", _entities_sql("title"))
def profile_title_entities(spark, d):
    """SRC-06: category + lower-cased distinct title entities (long form)."""
    return _entities(spark, d, "title")


@query("profile_content_entities", _entities_sql("content"))
def profile_content_entities(spark, d):
    """SRC-07: category + lower-cased distinct content entities (long form)."""
    return _entities(spark, d, "content")


def _tfidf_sql(kind, city=False):
    t = "art_title_tfidf" if kind == "title" else "art_tfidf"
    from skein.plans.oracle_ctes import enc_city, r6
    cat = f"{idx_str(enc_city('a.category'))} AS city_idx" if city else f"{idx_str(enc('a.category'))} AS category_idx"
    return sql(f"""
SELECT a.article_seq_id, {cat}, t.entity, {r6('t.tfidf')} AS tfidf
FROM art a JOIN {t} t ON t.article_seq_id = a.article_seq_id
WHERE a.crawled_at > {WINDOW} AND {no_null('a.category')} AND a.article_seq_id <> ''""", "art", t)


def _tfidf(spark, d, kind, city=False):
    from skein.functions.text import r6
    # The store's map columns are derived here, after the scan's window predicate.
    windowed = P.time_filter(fx.art(spark, d), fx.WINDOW_START_TS)
    df = P.profile_tfidf(fx.with_tfidf_maps(windowed, (kind,)), fx.WINDOW_START_TS, kind, city=city)
    name = "city_idx" if city else "category_idx"
    return df.select("article_seq_id", E.idx_string("category_idx").alias(name),
                     F.explode(f"{kind}_tfidf").alias("entity", "tfidf")).withColumn("tfidf", r6(F.col("tfidf")))


@query("profile_title_tfidf", _tfidf_sql("title"))
def profile_title_tfidf(spark, d):
    """SRC-08: category + title entity -> tf-idf (keys keep their case, Q20)."""
    return _tfidf(spark, d, "title")


@query("profile_content_tfidf", _tfidf_sql("content"))
def profile_content_tfidf(spark, d):
    """SRC-09: category + content entity -> tf-idf."""
    return _tfidf(spark, d, "content")


@query("profile_city_content_tfidf", _tfidf_sql("content", city=True))
def profile_city_content_tfidf(spark, d):
    """SRC-10: SRC-09 with the category-with-city vocabulary."""
    return _tfidf(spark, d, "content", city=True)


@query("profile_category_text", sql(
    f"SELECT article_seq_id, {CAT}, {_vec_sql('text_vector')} FROM art "
    f"WHERE crawled_at > {WINDOW} AND {_valid()} AND {no_null('text_vector')}", "art"))
def profile_category_text(spark, d):
    """SRC-11: category + numeric text vector, strict window."""
    df = P.profile_category_text(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"), *_vec("text_vector"))


@query("profile3", sql(
    f"SELECT article_seq_id, {CAT}, {_vec_sql('text_vector')}, {_vec_sql('title_vector')} FROM art "
    f"WHERE crawled_at >= {WINDOW} AND {_valid()} AND {no_null('text_vector')} AND {no_null('title_vector')}", "art"))
def profile3(spark, d):
    """SRC-12: text, title and category vectors, inclusive window."""
    df = P.profile3(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"),
                     *_vec("text_vector"), *_vec("title_vector"))


@query("profile_text_category", sql(
    f"SELECT article_seq_id, {CAT}, {_vec_sql('text_vector')} FROM art "
    f"WHERE crawled_at >= {WINDOW} AND {_valid()} AND {no_null('text_vector')}", "art"))
def profile_text_category(spark, d):
    """SRC-13: text + category vectors, inclusive window (title is not fetched)."""
    df = P.profile_text_category(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"), *_vec("text_vector"))


@query("profile2", sql(
    f"SELECT article_seq_id, {_vec_sql('text_vector')}, {_vec_sql('title_vector')} FROM art "
    f"WHERE crawled_at >= {WINDOW} AND article_seq_id <> '' AND {no_null('text_vector')} AND {no_null('title_vector')}",
    "art"))
def profile2(spark, d):
    """SRC-14: text + title vectors, inclusive window."""
    df = P.profile2(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", *_vec("text_vector"), *_vec("title_vector"))


@query("profile_text", sql(
    f"SELECT article_seq_id, {_vec_sql('text_vector')} FROM art "
    f"WHERE crawled_at >= {WINDOW} AND article_seq_id <> '' AND {no_null('text_vector')}", "art"))
def profile_text(spark, d):
    """SRC-15: text vector only, inclusive window."""
    df = P.profile_text(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", *_vec("text_vector"))


@query("profile_scan_any", sql("SELECT doc_id, text, lang, source, n_chars FROM documents"))
def profile_scan_any(spark, d):
    """SRC-16: a whole collection through a configurable data source."""
    df = P.read_collection(spark, f"{d}/documents.parquet", fmt="parquet")
    return df.select("doc_id", "text", "lang", "source", "n_chars")


@query("encode_category", sql(f"SELECT article_seq_id, {CAT} FROM art WHERE {_valid()}", "art"))
def encode_category(spark, d):
    """FN-01: names -> 13-slot vector; unknown names ignored."""
    a = fx.art(spark, d)
    df = P.scan_profiles(a, ["category"])
    return df.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("encode_category_city", sql(
    f"SELECT article_seq_id, {idx_str(__import__('skein.plans.oracle_ctes', fromlist=['x']).enc_city('category'))} AS city_idx "
    f"FROM art WHERE {_valid()}", "art"))
def encode_category_city(spark, d):
    """FN-02: names -> 3-slot category-with-city vector."""
    df = P.scan_profiles(fx.art(spark, d), ["category_city"])
    return df.select("article_seq_id", E.idx_string("category_idx").alias("city_idx"))


@query("encode_custom_category", sql(
    f"SELECT user_seq_id, {idx_str(__import__('skein.plans.oracle_ctes', fromlist=['x']).enc_custom('custom_categories'))} "
    f"AS custom_idx FROM user_profile WHERE {USER_VALID}", "user_profile"))
def encode_custom_category(spark, d):
    """FN-03: names -> 15-slot custom vector; unknown names set slot 0."""
    u = fx.user_profile(spark, d)
    return u.select("user_seq_id", E.idx_string(E.encode_custom_category(F.col("custom_categories"))).alias("custom_idx"))


@query("category_names", sql(f"""
SELECT article_seq_id, CAST(idx AS BIGINT) AS idx, {__import__('skein.plans.oracle_ctes', fromlist=['x']).VOCAB}[idx + 1] AS name
FROM (SELECT article_seq_id, unnest({enc('category')}) AS idx FROM art WHERE crawled_at > {WINDOW} AND {_valid()})""", "art"))
def category_names(spark, d):
    """FN-04: active slots of the window's category vectors, with their names."""
    df = P.profile_category(fx.art(spark, d), fx.WINDOW_START_TS)
    x = df.select("article_seq_id", F.explode("category_idx").alias("idx"))
    return x.select("article_seq_id", F.col("idx").cast("bigint").alias("idx"), E.category_names(F.col("idx")).alias("name"))


@query("entity_normalise", sql(f"""
SELECT article_seq_id, unnest(list_distinct(list_transform(title_name_entities, lambda x: lower(x)))) AS entity
FROM art WHERE {no_null('title_name_entities')}""", "art"))
def entity_normalise(spark, d):
    """FN-05: entity lists -> lower-cased distinct sets, all articles."""
    a = fx.art(spark, d).where(F.col("title_name_entities").isNotNull())
    return a.select("article_seq_id", F.explode(E.normalise_entities(F.col("title_name_entities"))).alias("entity"))


@query("vector_parse", sql(
    f"SELECT article_seq_id, {_vec_sql('text_vector')} FROM art WHERE {no_null('text_vector')}", "art"))
def vector_parse(spark, d):
    """FN-06: vector elements parsed through their text form; rows with a bad element drop."""
    a = fx.art(spark, d).select("article_seq_id", E.parse_vector(F.col("text_vector")).alias("text_vector"))
    a = a.where(F.col("text_vector").isNotNull() & ~E.has_null_element(F.col("text_vector")))
    return a.select("article_seq_id", *_vec("text_vector"))


@query("project_fields", sql("SELECT article_seq_id, epoch_ms(crawled_at) AS crawled_ms FROM art", "art"))
def project_fields(spark, d):
    """PRJ-01: fetch named fields only (the scan reads just those columns)."""
    return fx.art(spark, d).select("article_seq_id", C.ms_col("crawled_at").alias("crawled_ms"))


@query("drop_bad_rows", sql(f"""
SELECT article_seq_id, CASE WHEN NOT {no_null('category')} THEN 'category' ELSE 'text_vector' END AS reason
FROM art WHERE NOT ({no_null('category')} AND {no_null('text_vector')})""", "art"))
def drop_bad_rows(spark, d):
    """PRJ-02: the rows a category + text-vector scan rejects, with the failing field."""
    return P.rejected_profiles(fx.art(spark, d), ["category", "text_vector"])


@query("time_gt", sql(f"SELECT article_seq_id, epoch_ms(crawled_at) AS crawled_ms FROM art WHERE crawled_at > {WINDOW}", "art"))
def time_gt(spark, d):
    """PRJ-03: strict lower time bound."""
    df = P.time_filter(fx.art(spark, d), fx.WINDOW_START_TS)
    return df.select("article_seq_id", C.ms_col("crawled_at").alias("crawled_ms"))


@query("time_gte", sql(f"SELECT article_seq_id, epoch_ms(crawled_at) AS crawled_ms FROM art WHERE crawled_at >= {WINDOW}", "art"))
def time_gte(spark, d):
    """PRJ-03: inclusive lower time bound."""
    df = P.time_filter(fx.art(spark, d), fx.WINDOW_START_TS, inclusive=True)
    return df.select("article_seq_id", C.ms_col("crawled_at").alias("crawled_ms"))


@query("has_category", sql("SELECT article_seq_id FROM prof WHERE len(cat) > 0", "prof"))
def has_category(spark, d):
    """PRJ-07: window profiles with at least one active category."""
    return C.window_profiles(spark, d).where(F.size("category_idx") > 0).select("article_seq_id")
