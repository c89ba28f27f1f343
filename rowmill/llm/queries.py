"""One registered query for each operator, over its whole table, and the SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import audit, brown, centroids, decontaminate, jaccard, language, nearest, private, substrings, tokens, urls, vectors
from rowmill.llm.frames import crc_mod, table

#: The key of the registered queries and the pipeline. A deployment passes a secret one.
PII_KEY = "rowmill"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op3_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    hashed = tokens.digests(table(spark, sf_dir, "documents"), "doc_id", "text", ranks, public_tokenizers.PATTERN)
    return hashed.withColumnRenamed("id", "doc_id")


@query("op10_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = tokens.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.PATTERN)
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


@query(
    "op6_substring_dedup",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    windows AS (
      SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
    repeated AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM repeated),
    kept AS (
      SELECT a.r, string_agg(a.x, ' ' ORDER BY a.j) AS t
      FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) a ANTI JOIN gone g ON a.r = g.r AND a.j = g.j
      GROUP BY a.r),
    removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
    """,
)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op7_decontamination",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    items AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    tests AS (
      SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
      FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
    windows AS (
      SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM tests))),
    hits AS (SELECT r, windows.k, i, item_id FROM windows JOIN tests ON windows.k = tests.k AND windows.t = tests.t),
    covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hits) GROUP BY r),
    named AS (
      SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """,
)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    "op1_ngram_jaccard_join",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '' ORDER BY g)) AS k FROM s GROUP BY doc_id),
    links AS (
      SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
      JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
      WHERE c >= 0.8 * (m.n + n.n - c) - 1e-9),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT d.doc_id, coalesce(k.copy_of, d.doc_id) AS copy_of, coalesce(l.n, 0)::BIGINT AS n_links, c.class_id
    FROM documents d
    LEFT JOIN (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS copy_of FROM sizes) k USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a) l USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a) c USING (doc_id)
    """,
)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language.fit(docs.where(~held_out), "doc_id", "text", "lang")
    named = language.identify(docs, model)
    return named.withColumnRenamed("id", "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op9_surrogates")
def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = private.replace_entities(table(spark, sf_dir, "documents"), PII_KEY)
    return made.withColumnRenamed("id", "doc_id")


#: The rules that op2 is asked to apply, each a host and the beginning of a path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query(
    "op2_url_filters",
    r"""
    WITH p AS (
      SELECT row_number() OVER () AS r, page_id, url,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    s AS (SELECT *, string_split(host, '.') AS l, list_filter(string_split(path, '/'), lambda x: x <> '') AS w FROM p),
    f AS (
      SELECT r, page_id, host, path, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(list_filter(list_concat([
        'scheme=' || regexp_extract(url, '^([A-Za-z]*)://', 1),
        'top=' || l[-1],
        'domain=' || array_to_string(l[greatest(len(l) - 1, 1):], '.'),
        'depth=' || len(w),
        CASE WHEN regexp_matches(w[-1], '\.[A-Za-z0-9]{1,8}$') THEN 'ext=' || string_split(w[-1], '.')[-1] END,
        CASE WHEN contains(url, '#') THEN 'fragment' END],
        list_transform(list_filter(l[:-3], lambda x: x <> ''), lambda x: 'host=' || x),
        list_transform(list_filter(flatten(list_transform(list_filter(l[:-3], lambda x: regexp_matches(x, '[-_]')),
          lambda x: string_split_regex(x, '[-_]+'))), lambda x: x <> ''), lambda x: 'name=' || x),
        list_transform(list_filter(string_split_regex(path, '[-/._~+,;=]+'), lambda x: x <> ''), lambda x: 'word=' || x),
        list_transform(list_filter(q, lambda x: string_split(x, '=')[1] <> ''), lambda x: 'key=' || string_split(x, '=')[1]),
        list_transform(list_filter(q, lambda x: x <> ''), lambda x: 'query=' || x)), lambda x: x IS NOT NULL))) END AS f
      FROM (SELECT *, string_split(regexp_extract(url, '\?([^#]*)', 1), '&') AS q FROM s)),
    known AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
    t AS (SELECT r, f, bad FROM f JOIN known ON page_id = doc_id WHERE len(f) > 0),
    e AS (SELECT r, f, bad, unnest(f) AS item FROM t),
    i AS (SELECT item, count(*) FILTER (bad) AS b, count(*) AS n FROM e GROUP BY item
      HAVING count(*) FILTER (bad) >= 10 AND count(*) FILTER (bad) / count(*) > (SELECT count(*) FILTER (bad) / count(*) FROM t)),
    best AS (SELECT r, list_sort(list(item ORDER BY b / n DESC, n DESC, item)[:10]) AS items FROM e JOIN i USING (item) WHERE bad GROUP BY r),
    sets AS (
      SELECT list_filter(items, lambda x, k: (m >> (k - 1)) & 1 = 1) AS items
      FROM (SELECT items, unnest(range(1, (1 << len(items))::BIGINT)) AS m FROM best)),
    frequent AS (SELECT items FROM sets GROUP BY items HAVING count(*) >= 10),
    rules AS (
      SELECT items, count(*) FILTER (bad) / count(*) AS confidence FROM frequent JOIN e ON e.item = items[1] AND list_has_all(e.f, items)
      GROUP BY items HAVING count(*) FILTER (bad) / count(*) >= 0.8),
    hits AS (
      SELECT f.f, max(confidence) AS confidence FROM (SELECT DISTINCT f FROM f) f JOIN rules ON list_has_all(f.f, rules.items) GROUP BY f.f),
    listed AS (
      SELECT f.*, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
      FROM f)
    SELECT page_id, host, path, rule, CASE
      WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
      WHEN confidence IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, confidence
    FROM listed LEFT JOIN hits ON listed.f = hits.f
    """,
)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.withColumnRenamed("id", "page_id")


@query(
    "op5_embedding_dedup",
    r"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
    FROM embeddings e
    LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
    JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
    """,
)
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = vectors.near_vectors(table(spark, sf_dir, "embeddings"))
    return near.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


@query("op8_brown_scores")
def brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_out = crc_mod("doc_id", 7) == 2
    scored = brown.score(table(spark, sf_dir, "documents"), ~left_out)
    held_out = F.coalesce(crc_mod("id", 7) == 2, F.lit(False))
    return scored.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query(
    "op11_exact_top_k",
    r"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    pairs AS (
      SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.x, v.x), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def _clusters_sql(k: int = 8, rounds: int = 10, seed: int = 3, size: int = 64) -> str:
    """The rounds written out one after the other."""
    nearest_to = """
      SELECT r, vec_id, x, arg_min(c, (d, c)) AS cluster, min(d) AS distance
      FROM (SELECT r, vec_id, v.x, c, list_sum(list_transform(list_zip(v.x, m.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, {m} m)
      GROUP BY r, vec_id, x"""
    steps = []
    for i in range(rounds):
        steps.append(f"""
    a{i} AS MATERIALIZED ({nearest_to.format(m=f"c{i}")}),
    s{i} AS (
      SELECT cluster, i, (s - ((s % n) + n) % n) // n AS mean FROM (
        SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {size} + 1) t(i) GROUP BY cluster, i)),
    c{i + 1} AS MATERIALIZED (
      SELECT c, coalesce(y, x) AS x FROM c{i} LEFT JOIN (SELECT cluster, list(mean::BIGINT ORDER BY i) AS y FROM s{i} GROUP BY cluster) ON c = cluster)""")
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS x FROM embeddings
      WHERE len(embedding) = {size} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
      FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {k})),
    {",".join(steps)},
    last AS MATERIALIZED ({nearest_to.format(m=f"c{rounds}")})
    SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
      (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
    FROM last JOIN c{rounds} m ON m.c = cluster
    """


@query("op12_centroid_clusters", _clusters_sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


@query(
    "op13_filter_audit",
    r"""
    WITH w AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    l AS (
      SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
    f AS (
      SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(w) < 200 AS a,
        100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) AS c,
        regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
      FROM w LEFT JOIN l USING (doc_id)),
    p AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
    names(k) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    orders AS (
      SELECT v.k || w.k || x.k || y.k || z.k AS o FROM names v, names w, names x, names y, names z
      WHERE v.k NOT IN (w.k, x.k, y.k, z.k) AND w.k NOT IN (x.k, y.k, z.k) AND x.k NOT IN (y.k, z.k) AND y.k <> z.k),
    steps AS (
      SELECT p.*, o, step, o[step] AS letter, a::INT + b::INT + c::INT + d::INT + e::INT AS fails, [a, b, c, d, e][ascii(o[step]) - 64] AS failed,
        least(if(a, strpos(o, 'A'), 6), if(b, strpos(o, 'B'), 6), if(c, strpos(o, 'C'), 6), if(d, strpos(o, 'D'), 6), if(e, strpos(o, 'E'), 6)) AS gone
      FROM p, orders, range(1, 6) t(step)),
    counts AS (
      SELECT part, o AS filter_order, step::INTEGER AS step, letter,
        coalesce(sum(n) FILTER (gone > step), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (gone = step), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (failed AND gone < step), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (failed AND fails = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(g) FILTER (gone = step), 0)::BIGINT AS good_lost,
        coalesce(sum(x) FILTER (gone = step), 0)::BIGINT AS toxic_lost
      FROM steps GROUP BY ALL)
    SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counts
    """,
)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
