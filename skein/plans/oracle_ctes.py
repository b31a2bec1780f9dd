"""DuckDB mirrors of the fixture adapters, as named CTEs with dependencies.

``sql(body, *names)`` prefixes ``body`` with a WITH clause holding the named CTEs
and everything they depend on, in dependency order. The driver tables are views.
"""

from __future__ import annotations

from skein.constants import CATEGORY_NAMES, CUSTOM_CATEGORY_INDEX
from skein.sources.fixtures import SOURCE_NAMES


def _lst(values) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


VOCAB = _lst(CATEGORY_NAMES)
SOURCES = _lst(SOURCE_NAMES)
WINDOW = "TIMESTAMP '2024-01-28 00:00:00'"
LAST = "TIMESTAMP '2024-01-29 00:00:00'"
BATCH = "TIMESTAMP '2024-01-31 00:00:00'"


def enc(col: str, vocab: str = VOCAB) -> str:
    """Names -> sorted distinct vocabulary indices (0-based)."""
    return (f"list_sort(list_distinct(list_filter(list_transform({col}, lambda x: list_position({vocab}, x) - 1), "
            f"lambda x: x IS NOT NULL)))")


def enc_city(col: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform({col}, lambda x: CASE x WHEN 'zzz' THEN 0 "
            f"WHEN 'hhh' THEN 2 END), lambda x: x IS NOT NULL)))")


CUSTOM = _lst(CUSTOM_CATEGORY_INDEX)


def enc_custom(col: str) -> str:
    return f"list_sort(list_distinct(list_transform({col}, lambda x: coalesce(list_position({CUSTOM}, x), 0))))"


def idx_str(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"


def no_null(col: str) -> str:
    return f"({col} IS NOT NULL AND len(list_filter({col}, lambda x: x IS NULL)) = 0)"


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def fmt6(expr: str) -> str:
    return f"printf('%.6f', {r6(expr)})"


def ms(expr: str) -> str:
    return f"epoch_ms({expr})"


def vsum(col: str) -> str:
    return r6(f"list_sum({col})")


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, list(deps))


cte("art", f"""
SELECT CAST(d.doc_id AS VARCHAR) AS article_seq_id,
  TIMESTAMP '2024-01-01' + to_hours(CAST((d.doc_id*37)%720 AS INT)) AS crawled_at,
  coalesce(l.quality,1)=1 AS usable,
  CASE WHEN d.doc_id%50=7 THEN NULL
       WHEN d.doc_id%5=0 THEN [nm.names[CAST(substr(d.source,4) AS INT)+1],'cricket']
       ELSE [nm.names[CAST(substr(d.source,4) AS INT)+1]] END AS category,
  regexp_extract_all(d.text,'[A-Z][a-z]+') AS title_name_entities,
  regexp_extract_all(d.text,'[A-Za-z]+') AS content_name_entities,
  CAST(e.embedding AS DOUBLE[]) AS text_vector,
  list_transform(CAST(e.embedding AS DOUBLE[]),
    lambda x: x / sqrt(list_sum(list_transform(CAST(e.embedding AS DOUBLE[]), lambda y: y*y)))) AS title_vector
FROM documents d LEFT JOIN labels l ON l.doc_id=d.doc_id LEFT JOIN embeddings e ON e.vec_id=d.doc_id
CROSS JOIN (SELECT {SOURCES} AS names) nm""")

cte("art_tfidf", """
SELECT article_seq_id, entity, CAST(count(*) AS DOUBLE)/max(n) AS tfidf
FROM (SELECT article_seq_id, unnest(content_name_entities) AS entity, len(content_name_entities) AS n FROM art)
GROUP BY 1, 2""", "art")

cte("art_title_tfidf", """
SELECT article_seq_id, entity, CAST(count(*) AS DOUBLE)/max(n) AS tfidf
FROM (SELECT article_seq_id, unnest(title_name_entities) AS entity, len(title_name_entities) AS n FROM art)
GROUP BY 1, 2""", "art")

cte("art_crawls", """
SELECT * FROM art UNION ALL
SELECT * REPLACE (crawled_at + INTERVAL 1 DAY AS crawled_at, ['health'] AS category) FROM art
WHERE CAST(article_seq_id AS BIGINT) % 20 = 3""", "art")

cte("ev_k", """
SELECT *, CASE WHEN event_id%3=0 THEN k0 ELSE (event_id*31 + k0) % n END AS k
FROM (SELECT *, CAST(regexp_extract(props,'[0-9]+') AS BIGINT) AS k0, (SELECT count(*) FROM documents) AS n FROM events)""")

cte("lines", """
SELECT event_id, CASE event_type
 WHEN 'click' THEN '{"user_seq_id":'||user_id||',"article_seq_id":'||k||',"article_type":"article","lang":"en","ts":'||CAST(floor(epoch(ts)) AS BIGINT)||',"source":"'||['main','hot','trending','push'][CAST(event_id%4 AS INT)+1]||'","custom_categories":["sports","local"]}'
 WHEN 'view' THEN '{"user_seq_id":'||user_id||',"article_seq_id":['||k||','||(k+1)%n||','||(k+2)%n||'],"article_type":"'||CASE WHEN event_id%5=0 THEN 'video' ELSE 'article' END||'","lang":"en","ts":1,"subtype":"x","req_mode":"'||CASE WHEN event_id%3=0 THEN 'offline' ELSE 'online' END||'","custom_categories":["cricket"]}'
 WHEN 'error' THEN '{"user_seq_id":'||user_id||',"article_seq_id":'||k||',"lang":"hi","ts":1,"source":"main","custom_categories":[]}'
 ELSE '{"device_id":'||user_id||'}' END AS line
FROM ev_k""", "ev_k")

cte("torn", """
SELECT event_id, CASE WHEN event_id%11=0 THEN left(line, length(line)-1) ELSE line END AS line, line AS whole FROM lines""", "lines")

cte("topic_lines", """
SELECT l.event_id, CASE WHEN e.event_type='click' THEN 'click' ELSE 'impression' END AS topic, l.line
FROM lines l JOIN events e ON e.event_id = l.event_id""", "lines")

cte("pair_lines", "SELECT event_id, '(null,'||line||')' AS line FROM lines", "lines")

cte("actions", """
SELECT event_id, '{"user_seq_id":'||user_id||CASE WHEN event_id%4=0 THEN '' ELSE ',"version":"v'||event_id%3||'"' END||',"custom_categories":[]}' AS line
FROM events WHERE event_type IN ('click','view')""")

cte("rec_log", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS "user", CAST(k AS VARCHAR) AS item FROM ev_k WHERE event_type='purchase'""", "ev_k")

cte("user_profile", """
SELECT CAST(c_custkey AS VARCHAR) AS user_seq_id,
  TIMESTAMP '2024-01-01' + to_hours(CAST((c_custkey*53)%720 AS INT)) AS updated_at,
  [lower(c_mktsegment), ['sports','cricket','youtubes','local','national'][CAST(c_custkey%5 AS INT)+1]] AS custom_categories
FROM customer""")

cte("user_profile_v2", f"""
SELECT CAST(c_custkey AS VARCHAR) AS user_seq_id,
  TIMESTAMP '2024-01-01' + to_hours(CAST((c_custkey*53)%720 + 24 AS INT)) AS updated_at,
  [{SOURCES}[CAST(c_nationkey%20 AS INT)+1]] AS custom_categories
FROM customer WHERE c_acctbal > 0""")

cte("model_pointer", """
SELECT 'model_'||event_type AS model_key, date_trunc('hour', ts) AS published_at,
  'models/'||event_type||'/'||CAST(event_id AS VARCHAR) AS path FROM events""")

cte("st_global", "SELECT CAST(c AS INT) AS c, ((c*7)%13 - 6)/10.0 AS weight FROM range(13) t(c)")

cte("st_user", """
SELECT CAST(u.user_id AS VARCHAR) AS "user", CAST(c AS INT) AS c, ((u.user_id*13 + c*7)%41 - 20)/100.0 AS weight
FROM (SELECT c_custkey AS user_id FROM customer) u CROSS JOIN range(13) t(c)""")

cte("st_item", """
SELECT CAST(doc_id AS VARCHAR) AS item, ((doc_id*31)%101 - 50)/100.0 AS weight FROM (SELECT DISTINCT doc_id FROM labels)""")

# --- parsed events and instances -------------------------------------------------
cte("ev", """
SELECT event_id, line, line LIKE '%source%' AS is_read FROM lines WHERE line LIKE '%user_seq_id%'""", "lines")

cte("ev_ok", """
SELECT event_id, is_read, CAST(line->>'$.user_seq_id' AS INT) AS user_seq_id, line,
  CAST(line->'$.custom_categories' AS VARCHAR[]) AS custom_categories
FROM ev
WHERE (is_read AND line->>'$.lang'='en' AND line->>'$.source' IN ('main','hot','trending'))
   OR (NOT is_read AND line->>'$.lang'='en' AND line->>'$.article_type'='article' AND line->>'$.req_mode'='online')""", "ev")

cte("inst_plus", """
SELECT CAST(user_seq_id AS VARCHAR) AS "user", CAST(CAST(line->>'$.article_seq_id' AS INT) AS VARCHAR) AS item,
  CAST(1.0 AS DOUBLE) AS label, custom_categories FROM ev_ok WHERE is_read
UNION ALL
SELECT CAST(user_seq_id AS VARCHAR), CAST(unnest(CAST(line->'$.article_seq_id' AS INT[])) AS VARCHAR),
  CAST(0.0 AS DOUBLE), custom_categories FROM ev_ok WHERE NOT is_read""", "ev_ok")

cte("inst", 'SELECT "user", item, label FROM inst_plus', "inst_plus")

cte("act", """
SELECT event_id, CAST(CAST(line->>'$.user_seq_id' AS BIGINT) AS VARCHAR) AS user_seq_id, line->>'$.version' AS version, line
FROM actions""", "actions")

cte("active", """
SELECT DISTINCT user_seq_id AS "user" FROM act WHERE version = 'v1' OR version IS NULL""", "act")

# --- the profile window used by training and ranking (usable, valid category) -------
cte("prof", f"""
SELECT article_seq_id, cat FROM (
  SELECT article_seq_id, {enc('category')} AS cat, row_number() OVER (PARTITION BY article_seq_id ORDER BY crawled_at DESC) AS rn
  FROM art_crawls WHERE crawled_at > {WINDOW} AND usable AND {no_null('category')}
    AND article_seq_id IS NOT NULL AND article_seq_id <> '') WHERE rn = 1""", "art_crawls")

cte("prof_tfidf", """
SELECT t.article_seq_id, t.entity, t.tfidf FROM art_tfidf t SEMI JOIN prof p ON p.article_seq_id = t.article_seq_id""",
    "art_tfidf", "prof")


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = body.strip()
    if not order:
        return body
    # Materialised: the cost does not depend on how the engine inlines them.
    parts = [f"{n} AS MATERIALIZED ({CTES[n][0].strip()})" for n in order]
    if body[:5].upper() == "WITH ":
        # The body has CTEs of its own: one WITH clause holds both lists.
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- model scenario: training examples, features, state, SGD, ranking ---------------
def term(feat: str, value: str, weight: str) -> str:
    w = fmt6(f"coalesce({weight}, 0.0)")
    return (f"CASE WHEN {value} = 1 THEN {feat}||': '||{w} WHEN {value} = 0 THEN {feat}||': ('||{w}||')' "
            f"ELSE {feat}||': '||{w}||' *'||{fmt6(value)} END")


cte("ex", 'SELECT "user", item, label, count(*) AS mult FROM inst GROUP BY ALL', "inst")

cte("ue_set", """
SELECT DISTINCT i."user", t.entity FROM (SELECT DISTINCT "user", item FROM inst) i
JOIN prof_tfidf t ON t.article_seq_id = i.item""", "inst", "prof_tfidf")

cte("st_ue", """
SELECT "user", entity, ((CAST("user" AS BIGINT)*5 + length(entity)*3)%21 - 10)/100.0 AS weight
FROM (SELECT "user", entity FROM ue_set UNION
  SELECT CAST(c_custkey AS VARCHAR), unnest(['the', 'The', 'tag'||c_custkey%7]) FROM customer)""", "ue_set")

cte("state", """
SELECT 'g' AS kind, CAST(c AS VARCHAR) AS k1, '' AS k2, weight FROM st_global
UNION ALL SELECT 'u', "user", CAST(c AS VARCHAR), weight FROM st_user
UNION ALL SELECT 'i', item, '', weight FROM st_item
UNION ALL SELECT 't', "user", entity, weight FROM st_ue""", "st_global", "st_user", "st_item", "st_ue")

cte("ex_cat", """
SELECT e."user", e.item, e.label, e.mult, unnest(p.cat) AS c FROM ex e JOIN prof p ON p.article_seq_id = e.item""",
    "ex", "prof")

cte("feats", """
SELECT *, CASE WHEN k2 = '' THEN kind||':'||k1 ELSE kind||':'||k1||':'||k2 END AS feat FROM (
  SELECT "user", item, label, mult, 'g' AS kind, CAST(c AS VARCHAR) AS k1, '' AS k2, 1.0::DOUBLE AS value FROM ex_cat
  UNION ALL SELECT "user", item, label, mult, 'u', "user", CAST(c AS VARCHAR), 1.0 FROM ex_cat
  UNION ALL SELECT "user", item, label, mult, 'i', item, '', 1.0 FROM ex
  UNION ALL SELECT e."user", e.item, e.label, e.mult, 't', e."user", t.entity, 0.5*t.tfidf
    FROM ex e JOIN prof_tfidf t ON t.article_seq_id = e.item)""", "ex_cat", "ex", "prof_tfidf")

cte("w0", """
SELECT s.kind, s.k1, s.k2, s.feat, coalesce(st.weight, 0.0) AS weight
FROM (SELECT DISTINCT kind, k1, k2, feat FROM feats) s LEFT JOIN state st USING (kind, k1, k2)""", "feats", "state")

cte("n_ex", "SELECT sum(mult) AS n FROM ex", "ex")


def _grad(w: str) -> str:
    return f"""
SELECT f.feat, sum(m.err * f.value) AS grad FROM feats f JOIN (
  SELECT "user", item, label, mult * (1.0/(1.0+exp(-sum(value*weight))) - label) AS err
  FROM (SELECT f."user", f.item, f.label, f.mult, f.value, coalesce(w.weight, 0.0) AS weight
        FROM feats f LEFT JOIN {w} w USING (feat)) GROUP BY "user", item, label, mult) m
USING ("user", item, label) GROUP BY f.feat"""


cte("g1", _grad("w0"), "feats", "w0")
cte("w1", """
SELECT w.kind, w.k1, w.k2, w.feat, w.weight - 1.0/sqrt(1) * coalesce(g.grad, 0.0)/n.n AS weight
FROM w0 w LEFT JOIN g1 g USING (feat) CROSS JOIN n_ex n""", "w0", "g1", "n_ex")
cte("g2", _grad("w1"), "feats", "w1")
cte("w2", """
SELECT w.kind, w.k1, w.k2, w.feat, w.weight - 1.0/sqrt(2) * coalesce(g.grad, 0.0)/n.n AS weight
FROM w1 w LEFT JOIN g2 g USING (feat) CROSS JOIN n_ex n""", "w1", "g2", "n_ex")

cte("cand", f"""
SELECT p.article_seq_id AS item, p.cat, {r6('coalesce(s.weight, 0.0)')} AS score
FROM prof p LEFT JOIN st_item s ON s.item = p.article_seq_id WHERE len(p.cat) > 0
ORDER BY score DESC, item DESC LIMIT 10""", "prof", "st_item")

cte("cand_cat", "SELECT item, unnest(cat) AS c FROM cand", "cand")

cte("cand_feat", """
SELECT x.item, 'g:'||CAST(x.c AS VARCHAR) AS feat, 1.0::DOUBLE AS value, g.weight FROM cand_cat x LEFT JOIN st_global g ON g.c = x.c
UNION ALL SELECT item, 'i:'||item, 1.0, score FROM cand""", "cand_cat", "st_global")

cte("cand_tfidf", "SELECT * FROM prof_tfidf WHERE article_seq_id IN (SELECT item FROM cand)", "prof_tfidf", "cand")

cte("contrib", """
SELECT a."user", f.item, f.feat, f.value, f.weight FROM active a CROSS JOIN cand_feat f
UNION ALL
SELECT u."user", x.item, 'u:'||u."user"||':'||CAST(x.c AS VARCHAR), 1.0, u.weight
FROM st_user u JOIN cand_cat x ON x.c = u.c WHERE u."user" IN (SELECT "user" FROM active)
UNION ALL
SELECT e."user", t.article_seq_id, 't:'||e."user"||':'||e.entity, 0.5*t.tfidf, e.weight
FROM st_ue e JOIN cand_tfidf t ON t.entity = e.entity WHERE e."user" IN (SELECT "user" FROM active)""",
    "active", "cand_feat", "st_user", "cand_cat", "st_ue", "cand_tfidf")

cte("scored", f"""
SELECT "user", item, {r6('sum(value * coalesce(weight, 0.0))')} AS score,
  string_agg({term('feat', 'value', 'weight')}, ', ' ORDER BY feat) AS explanation
FROM contrib GROUP BY "user", item""", "contrib")

cte("unshown", """
SELECT s.* FROM scored s WHERE NOT EXISTS (SELECT 1 FROM rec_log l WHERE l."user" = s."user" AND l.item = s.item)""",
    "scored", "rec_log")

cte("rec", """
SELECT * FROM (SELECT "user", item, score, explanation,
  row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item DESC) AS rank FROM unshown) WHERE rank <= 5""",
    "unshown")

cte("doc_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")

cte("refresh_pairs", """
SELECT event_id, epoch_us(ts) // 1000 - epoch_ms(TIMESTAMP '2024-01-01') AS target_ms,
  CASE WHEN event_type = 'signup' THEN -1
       ELSE epoch_us(ts) // 1000 - epoch_ms(TIMESTAMP '2024-01-01') - CAST(floor(value) AS BIGINT) * 3600000 END AS last_ms
FROM events""")

cte("registry", "SELECT feat, row_number() OVER (ORDER BY feat) - 1 AS idx FROM (SELECT DISTINCT feat FROM feats)", "feats")
