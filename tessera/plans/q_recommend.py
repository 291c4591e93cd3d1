"""Recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import recommend as R
from tessera.operators.ordered import side_by_side
from tessera.operators.quality import clean_ratings
from tessera.plans.registry import query
from tessera.session import written
from tessera.sources.fixtures import RATING_ORDER, view
from tessera.sources.tables import table_bytes, tasks_for

# The stand-in ratings (14-49 per item at sf0.01) need a floor of 30, above the library's 20, so
# that both branches of the hybrid occur; train and test are split in time.
HYBRID_MIN = 30
SPLIT_CUTOFF = "1998-01-01"

# DuckDB text shared by several oracles: the cleaned ratings (keep the latest
# rating per (user, item), ratings 1..5) and the item metadata.
CLEAN_SQL = """
clean AS (
  SELECT user_id, item_id, rating, rated_at, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
        ORDER BY rated_at DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
                 l_extendedprice DESC, rating DESC) AS rn
    FROM ratings) t
  WHERE rn = 1 AND rating BETWEEN 1 AND 5)"""

META_SQL = CLEAN_SQL + """,
stats AS (SELECT item_id, count(*) AS rating_count, avg(rating) AS rating_mean FROM clean GROUP BY item_id),
meta AS (
  SELECT i.item_id, i.title,
         CASE WHEN regexp_matches(trim(i.title), '\\((\\d{4})\\)')
              THEN trim(regexp_extract(trim(i.title), '^(.*)\\(\\d{4}\\)', 1)) ELSE trim(i.title) END AS clean_title,
         CAST(list_last(regexp_extract_all(trim(i.title), '\\((\\d{4})\\)', 1)) AS INT) AS release_year,
         list_distinct(list_filter(string_split(i.genres, '|'), lambda g: g <> '')) AS genres,
         coalesce(s.rating_count, 0) AS rating_count, coalesce(s.rating_mean, 0.0) AS rating_mean
  FROM items i LEFT JOIN stats s ON i.item_id = s.item_id),
mc AS (SELECT (SELECT quantile_cont(rating_count, 0.6) FROM meta) AS m,
              (SELECT avg(rating_mean) FROM meta WHERE rating_count > 0) AS c),
scored AS (
  SELECT meta.*, CAST(rating_count AS DOUBLE) / (rating_count + m) * rating_mean
                 + m / (rating_count + m) * c AS popularity_score
  FROM meta, mc)"""


def _parts(spark, sf) -> int:
    return tasks_for(spark, table_bytes(spark, sf, "lineitem"))


def _meta(spark, sf):
    return R.item_metadata(view(spark, sf, "items"), _clean(spark, sf))


def popularity_bayes(spark, sf):
    scored = R.bayes_popularity(_meta(spark, sf))
    top = R.top_k(scored, 10, [F.col("popularity_score").desc(), F.col("item_id")])
    ranked = R.with_rank(top, [F.col("popularity_score").desc(), F.col("item_id")])
    return ranked.select("rank", "item_id", "title", "rating_count",
                         F.round("rating_mean", 6).alias("rating_mean"),
                         F.round("popularity_score", 6).alias("popularity_score"))


query("popularity_bayes", f"""
WITH {META_SQL}
SELECT CAST(row_number() OVER (ORDER BY popularity_score DESC, item_id) AS INT) AS rank,
       item_id, title, rating_count, round(rating_mean, 6) AS rating_mean,
       round(popularity_score, 6) AS popularity_score
FROM scored ORDER BY popularity_score DESC, item_id LIMIT 10
""")(popularity_bayes)


# ---------------------------------------------------------------- shared oracle pieces
GENRES_SQL = """ig0 AS (SELECT item_id, list_filter(string_split(genres, '|'), lambda g: g <> '') AS gl0 FROM items),
ig AS (SELECT item_id, list_filter(gl0, lambda x, i: list_position(gl0, x) = i) AS genres FROM ig0),
g2 AS (SELECT item_id, unnest(genres) AS genre FROM ig),
ng AS (SELECT item_id, len(genres) AS ng FROM ig),
inter AS (SELECT a.item_id AS i, b.item_id AS j, count(*) AS k
          FROM g2 a JOIN g2 b ON a.genre = b.genre AND a.item_id <> b.item_id GROUP BY 1, 2),
csim AS (SELECT x.item_id AS i, y.item_id AS j,
                CASE WHEN x.ng * y.ng > 0 THEN coalesce(k, 0) / sqrt(x.ng * y.ng) ELSE 0 END AS score
         FROM ng x JOIN ng y ON x.item_id <> y.item_id
         LEFT JOIN inter ON inter.i = x.item_id AND inter.j = y.item_id)"""

CF_SQL = CLEAN_SQL + """,
elig AS (SELECT item_id FROM clean GROUP BY item_id HAVING count(*) >= 30),
er AS (SELECT user_id, item_id, rating FROM clean WHERE item_id IN (SELECT item_id FROM elig)),
um AS (SELECT user_id, avg(rating) AS m FROM er GROUP BY user_id),
cr AS (SELECT er.user_id, item_id, rating - m AS c FROM er JOIN um ON er.user_id = um.user_id),
nrm AS (SELECT item_id, sqrt(sum(c * c)) AS n FROM cr GROUP BY item_id),
dots AS (SELECT a.item_id AS i, b.item_id AS j, sum(a.c * b.c) AS dot
         FROM cr a JOIN cr b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2),
sim AS (SELECT i AS item_i, j AS item_j, coalesce(dot / nullif(ni.n * nj.n, 0), 0) AS similarity
        FROM dots JOIN nrm ni ON ni.item_id = i JOIN nrm nj ON nj.item_id = j),
simm AS (SELECT item_i AS i, item_j AS j, similarity FROM sim UNION ALL SELECT item_j, item_i, similarity FROM sim),
cfdense AS (SELECT a.item_id AS i, b.item_id AS j, coalesce(simm.similarity, 0) AS score
            FROM elig a JOIN elig b ON a.item_id <> b.item_id LEFT JOIN simm ON simm.i = a.item_id AND simm.j = b.item_id)"""


def _topn_sql(src: str, n: int = 10, where: str = "") -> str:
    return f"""SELECT i AS item_id, CAST(rnk AS INT) AS rank, j AS similar_item_id, round(score, 6) AS score FROM (
  SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rnk FROM {src} {where}) t
WHERE rnk <= {n}"""


def _topn_out(df):
    return df.select("item_id", F.col("rank").cast("int"), "similar_item_id", F.round("score", 6).alias("score"))


def _clean(spark, sf):
    return clean_ratings(view(spark, sf, "ratings"), RATING_ORDER, _parts(spark, sf))


def _rated(spark, sf):
    """The cleaned ratings in the columns that lists are made of, written: several branches read them."""
    return written(_clean(spark, sf).select("user_id", "item_id", "rating"), "clean")


# ---------------------------------------------------------------- R1-R11
@query("item_metadata", f"""
WITH {META_SQL}
SELECT item_id, title, clean_title, release_year, rating_count, round(rating_mean, 6) AS rating_mean,
       list_sort(genres) AS genres_sorted FROM meta""")
def item_metadata(spark, sf):
    m = _meta(spark, sf)
    return m.select("item_id", "title", "clean_title", "release_year", "rating_count",
                    F.round("rating_mean", 6).alias("rating_mean"), F.array_sort("genres").alias("genres_sorted"))


@query("content_similar", f"WITH {GENRES_SQL}\n{_topn_sql('csim')}")
def content_similar(spark, sf):
    return _topn_out(R.content_topn(_meta(spark, sf), 10))


@query("content_similar_min_count", f"""
WITH {META_SQL}, {GENRES_SQL}
{_topn_sql('csim', 10, 'WHERE j IN (SELECT item_id FROM meta WHERE rating_count >= 10)')}""")
def content_similar_min_count(spark, sf):
    return _topn_out(R.content_topn(_meta(spark, sf), 10, min_candidate_ratings=R.CONTENT_MIN_RATINGS))


@query("item_cf_similarity", f"""
WITH {CF_SQL.replace('HAVING count(*) >= 30', f'HAVING count(*) >= {R.CF_MIN_RATINGS}')}
SELECT item_i, item_j, round(similarity, 6) AS similarity FROM sim""")
def item_cf_similarity(spark, sf):
    """All pairs above the reference's floor of 20 ratings."""
    s = R.item_cf_similarity(_clean(spark, sf), R.CF_MIN_RATINGS)
    return s.select("item_i", "item_j", F.round("similarity", 6).alias("similarity"))


@query("item_cf_topn", f"WITH {CF_SQL}\n{_topn_sql('cfdense')}")
def item_cf_topn(spark, sf):
    clean = _rated(spark, sf)  # read by eligibility and by the centred ratings
    return _topn_out(R.item_cf_topn(clean, 10, HYBRID_MIN))


HYBRID_SQL = f"""WITH {META_SQL}, {GENRES_SQL}, {CF_SQL.replace(CLEAN_SQL + ',', '')},
recs AS (
  SELECT i, j, score, rnk, 'item_based_cf' AS algorithm FROM (
    SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rnk FROM cfdense) t WHERE rnk <= 10
  UNION ALL
  SELECT i, j, score, rnk, 'content_based' FROM (
    SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rnk FROM csim
    WHERE i NOT IN (SELECT item_id FROM elig)) t WHERE rnk <= 10),
shared AS (
  SELECT recs.*, cg.genres AS cgen, list_filter(cg.genres, lambda g: list_contains(bg.genres, g)) AS common
  FROM recs JOIN ig bg ON bg.item_id = recs.i JOIN ig cg ON cg.item_id = recs.j)
SELECT shared.i AS item_id, algorithm, CAST(rnk AS INT) AS rank, j AS similar_item_id, m.title AS similar_title,
       m.release_year, cgen AS genres, round(score, 4) AS similarity_score, round(m.rating_mean, 2) AS average_rating, m.rating_count,
       common AS common_genres,
       CASE WHEN algorithm = 'item_based_cf' THEN
              CASE WHEN len(common) > 0 THEN 'Users who liked this item also rated these highly (shared genres: '
                                             || array_to_string(common, ', ') || ')'
                   ELSE 'Users who liked this item also rated these highly' END
            ELSE CASE WHEN len(common) > 0 THEN 'Shares the genres ' || array_to_string(common, ', ') || ' with the chosen item'
                      ELSE 'Has a similar genre mix to the chosen item' END END AS recommendation_reason
FROM shared JOIN meta m ON m.item_id = shared.j"""


@query("recommend_hybrid", HYBRID_SQL)
def recommend_hybrid(spark, sf):
    clean = _rated(spark, sf)  # read by metadata, eligibility and CF
    meta = R.item_metadata(view(spark, sf, "items"), clean)
    return R.recommend_hybrid(meta, clean, 10, HYBRID_MIN)


@query("recommend_basic", HYBRID_SQL.replace("round(score, 4)", "round(score, 3)"))
def recommend_basic(spark, sf):
    """The basic service's row: scores with three digits."""
    clean = _rated(spark, sf)
    return R.recommend_hybrid(R.item_metadata(view(spark, sf, "items"), clean), clean, 10, HYBRID_MIN, R.BASIC_SCORE_DIGITS)


@query("catalog_popular", f"""
WITH {META_SQL}
SELECT item_id, title, rating_count, round(popularity_score, 6) AS popularity_score FROM scored
ORDER BY popularity_score DESC, item_id LIMIT 20""")
def catalog_popular(spark, sf):
    """The catalogue list without a search: most popular first."""
    top = R.search_catalogue(R.bayes_popularity(_meta(spark, sf)), None)
    return top.select("item_id", "title", "rating_count", F.round("popularity_score", 6).alias("popularity_score"))


@query("common_genres", f"""
WITH {GENRES_SQL},
top AS (SELECT i, j FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rnk FROM csim) t
        WHERE rnk <= 10)
SELECT top.i AS item_id, top.j AS similar_item_id,
       list_filter(cg.genres, lambda g: list_contains(bg.genres, g)) AS common_in_candidate_order,
       list_sort(list_filter(cg.genres, lambda g: list_contains(bg.genres, g))) AS common_sorted
FROM top JOIN ig bg ON bg.item_id = top.i JOIN ig cg ON cg.item_id = top.j""")
def common_genres_q(spark, sf):
    meta = _meta(spark, sf)
    top = R.content_topn(meta, 10)
    base = meta.select("item_id", F.col("genres").alias("base_genres"))
    cand = meta.select(F.col("item_id").alias("similar_item_id"), F.col("genres").alias("cand_genres"))
    j = top.join(base, "item_id").join(cand, "similar_item_id")
    shared = R.common_genres()
    return j.select("item_id", "similar_item_id", shared.alias("common_in_candidate_order"),
                    F.array_sort(shared).alias("common_sorted"))


@query("popular_qualified", f"""
WITH {META_SQL}
SELECT item_id, title, rating_count, round(rating_mean, 6) AS rating_mean FROM meta WHERE rating_count >= 30
ORDER BY rating_mean DESC, rating_count DESC, item_id LIMIT 10""")
def popular_qualified(spark, sf):
    m = _meta(spark, sf).where(F.col("rating_count") >= R.POPULAR_MIN_RATINGS)
    top = R.top_k(m, 10, [F.col("rating_mean").desc(), F.col("rating_count").desc(), F.col("item_id")])
    return top.select("item_id", "title", "rating_count", F.round("rating_mean", 6).alias("rating_mean"))


@query("topk_popular", f"""
WITH {META_SQL}
SELECT item_id, title, rating_count FROM meta ORDER BY rating_count DESC, item_id LIMIT 10""")
def topk_popular(spark, sf):
    return R.top_k(_meta(spark, sf), 10, [F.col("rating_count").desc(), F.col("item_id")]).select(
        "item_id", "title", "rating_count")


@query("topk_two_keys", f"""
WITH {META_SQL}
SELECT item_id, round(rating_mean, 6) AS rating_mean, rating_count FROM meta
ORDER BY rating_mean DESC, rating_count DESC, item_id LIMIT 20""")
def topk_two_keys(spark, sf):
    t = R.top_k(_meta(spark, sf), 20, [F.col("rating_mean").desc(), F.col("rating_count").desc(), F.col("item_id")])
    return t.select("item_id", F.round("rating_mean", 6).alias("rating_mean"), "rating_count")


@query("popular_unseen", f"""
WITH {META_SQL},
seen AS (SELECT DISTINCT user_id, item_id FROM clean),
users_r AS (SELECT DISTINCT user_id FROM clean),
cand AS (SELECT u.user_id, s.item_id, s.popularity_score,
                row_number() OVER (PARTITION BY u.user_id ORDER BY s.popularity_score DESC, s.item_id) AS rnk
         FROM users_r u CROSS JOIN scored s
         WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_id = u.user_id AND seen.item_id = s.item_id))
SELECT user_id, CAST(rnk AS INT) AS rank, item_id, round(popularity_score, 6) AS popularity_score FROM cand WHERE rnk <= 10""")
def popular_unseen(spark, sf):
    clean = written(_clean(spark, sf).select("user_id", "item_id", "rating"), "clean")  # read by popularity, seen items and users
    scored = R.bayes_popularity(R.item_metadata(view(spark, sf, "items"), clean))
    out = R.popular_unseen(scored, clean, clean.select("user_id"), 10, _parts(spark, sf))
    return out.select("user_id", F.col("rank").cast("int"), "item_id", F.round("popularity_score", 6).alias("popularity_score"))


@query("recommend_unknown", """
WITH q AS (SELECT l_partkey AS item_id FROM lineitem UNION SELECT l_orderkey FROM lineitem)
SELECT q.item_id, CASE WHEN q.item_id NOT IN (SELECT p_partkey FROM part) THEN 'unknown'
                       WHEN (SELECT count(*) FROM part) < 2 THEN 'no_result' ELSE 'ok' END AS status
FROM q""")
def recommend_unknown(spark, sf):
    """Status of requests by the hybrid's lists: items below the CF floor fall back to content; order keys serve as foreign ids."""
    from tessera.sources.tables import table
    clean = _rated(spark, sf)  # read by the metadata and the CF lists
    meta = R.item_metadata(view(spark, sf, "items"), clean)
    li = table(spark, sf, "lineitem")
    q = li.select(F.col("l_partkey").alias("item_id")).union(li.select("l_orderkey"))
    return R.recommend_status(meta, R.recommend_hybrid(meta, clean, 10, HYBRID_MIN), q)


@query("lookup_title", f"""
WITH {META_SQL},
req AS (SELECT DISTINCT upper(p_name) AS request FROM part)
SELECT request, item_id, CASE WHEN item_id IS NULL THEN 'no item with this title' ELSE 'found' END AS status
FROM req LEFT JOIN meta ON lower(req.request) = lower(meta.clean_title)""")
def lookup_title(spark, sf):
    from tessera.sources.tables import table
    req = table(spark, sf, "part").select(F.upper("p_name").alias("request")).distinct()
    return R.lookup_titles(_meta(spark, sf), req)


# ---------------------------------------------------------------- joins, windows, sets
@query("join_star_checked", """
SELECT (SELECT count(*) FROM ratings) AS n_facts,
       (SELECT count(*) FROM ratings r LEFT JOIN items i ON r.item_id = i.item_id
                                       LEFT JOIN users u ON r.user_id = u.user_id) AS n_joined,
       (SELECT count(*) = count(DISTINCT item_id) FROM items) AND (SELECT count(*) = count(DISTINCT user_id) FROM users)
         AS dim_keys_unique,
       (SELECT count(*) FROM ratings) = (SELECT count(*) FROM ratings r LEFT JOIN items i ON r.item_id = i.item_id
                                         LEFT JOIN users u ON r.user_id = u.user_id) AS row_count_unchanged""")
def join_star_checked(spark, sf):
    r, i, u = view(spark, sf, "ratings"), view(spark, sf, "items"), view(spark, sf, "users")
    return R.star_join_check(r, i, u)


@query("item_stats_inner", f"""
WITH {CLEAN_SQL}
SELECT i.item_id, i.title, count(*) AS rating_count, round(avg(rating), 6) AS rating_mean
FROM items i JOIN clean c ON i.item_id = c.item_id GROUP BY i.item_id, i.title""")
def item_stats_inner(spark, sf):
    s = R.item_stats(_clean(spark, sf))
    return (view(spark, sf, "items").join(s, "item_id")
            .select("item_id", "title", "rating_count", F.round("rating_mean", 6).alias("rating_mean")))


@query("join_items_ratings", """
SELECT i.item_id, r.user_id, r.rating FROM items i LEFT JOIN ratings r ON i.item_id = r.item_id""")
def join_items_ratings(spark, sf):
    r = view(spark, sf, "ratings").select("item_id", "user_id", "rating")
    return view(spark, sf, "items").select("item_id").join(r, "item_id", "left")


@query("semi_eligible", f"""
WITH {CLEAN_SQL}
SELECT user_id, item_id, rating FROM clean
WHERE item_id IN (SELECT item_id FROM clean GROUP BY item_id HAVING count(*) >= 30)""")
def semi_eligible(spark, sf):
    c = _clean(spark, sf)
    return c.select("user_id", "item_id", "rating").join(R.eligible_items(c, HYBRID_MIN), "item_id", "left_semi")


@query("anti_seen", f"""
WITH {CLEAN_SQL}
SELECT user_id, item_id, rating FROM clean t
WHERE rated_at >= TIMESTAMP '{SPLIT_CUTOFF}'
  AND NOT EXISTS (SELECT 1 FROM clean s WHERE s.rated_at < TIMESTAMP '{SPLIT_CUTOFF}'
                  AND s.user_id = t.user_id AND s.item_id = t.item_id)""")
def anti_seen(spark, sf):
    train, test = R.temporal_split(_clean(spark, sf), SPLIT_CUTOFF)
    return test.select("user_id", "item_id", "rating").join(train.select("user_id", "item_id"),
                                                            ["user_id", "item_id"], "left_anti")


@query("seed_item_per_user", f"""
WITH {CLEAN_SQL}
SELECT user_id, item_id AS seed_item_id, rating AS seed_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, rated_at DESC, item_id) AS rn
  FROM clean WHERE rating >= 4) t WHERE rn = 1""")
def seed_item_per_user(spark, sf):
    return R.seed_per_user(_clean(spark, sf))


@query("center_ratings", f"""
WITH {CLEAN_SQL}
SELECT user_id, item_id, rating, round(rating - avg(rating) OVER (PARTITION BY user_id), 6) AS centered FROM clean""")
def center_ratings(spark, sf):
    c = R.center_ratings(_clean(spark, sf).select("user_id", "item_id", "rating"))
    return c.select("user_id", "item_id", "rating", F.round("centered", 6).alias("centered"))


@query("set_union", """
SELECT txn_order, txn_line, type, 'transfer' AS part FROM txn WHERE type = 'TRANSFER'
UNION ALL SELECT txn_order, txn_line, type, 'cash_out' FROM txn WHERE type = 'CASH_OUT'""")
def set_union(spark, sf):
    t = view(spark, sf, "txn").select("txn_order", "txn_line", "type")
    t = written(t.where(F.col("type").isin("TRANSFER", "CASH_OUT")), "txn-parts")  # both branches read it: joined once
    a = t.where(F.col("type") == "TRANSFER").withColumn("part", F.lit("transfer"))
    b = t.where(F.col("type") == "CASH_OUT").withColumn("part", F.lit("cash_out"))
    return a.unionByName(b)


@query("set_intersect", f"""
SELECT user_id, item_id FROM ratings WHERE rated_at < TIMESTAMP '{SPLIT_CUTOFF}'
INTERSECT
SELECT user_id, item_id FROM ratings WHERE rated_at >= TIMESTAMP '{SPLIT_CUTOFF}'""")
def set_intersect(spark, sf):
    train, test = R.temporal_split(view(spark, sf, "ratings"), SPLIT_CUTOFF)
    return train.select("user_id", "item_id").intersect(test.select("user_id", "item_id"))


@query("multi_hot", """
SELECT item_id, genre, 1 AS flag FROM (SELECT DISTINCT item_id, unnest(string_split(genres, '|')) AS genre FROM items) g
WHERE genre <> ''""")
def multi_hot(spark, sf):
    it = view(spark, sf, "items").select("item_id", F.explode(R.genre_array()).alias("genre"))
    return it.withColumn("flag", F.lit(1))


@query("concat_columns", """
WITH a AS (SELECT item_id, title, row_number() OVER (ORDER BY item_id) AS row FROM items),
b AS (SELECT user_id, age, row_number() OVER (ORDER BY user_id) AS row FROM users)
SELECT row, item_id, title, user_id, age FROM a FULL JOIN b USING (row)""")
def concat_columns(spark, sf):
    """Two tables side by side, row by row in the order of their keys."""
    a, b = view(spark, sf, "items").select("item_id", "title"), view(spark, sf, "users").select("user_id", "age")
    return side_by_side(a, b, [F.col("item_id")], [F.col("user_id")]).select("row", "item_id", "title", "user_id", "age")


@query("flags_to_array", """
SELECT hour, bike_count, list_filter([
    CASE WHEN hour IN (7, 8, 17, 18, 19, 20) THEN 'IsRushHour' END,
    CASE WHEN rainfall > 0 OR snowfall > 0 THEN 'IsPrecipitation' END,
    CASE WHEN hour IN (7, 8, 17, 18, 19, 20) AND holiday = 'No Holiday' THEN 'IsCommuteTime' END],
  lambda x: x IS NOT NULL) AS flags
FROM rides""")
def flags_to_array(spark, sf):
    from tessera.operators.features import ride_features
    f = ride_features(view(spark, sf, "rides"), severity=False)
    names = ["IsRushHour", "IsPrecipitation", "IsCommuteTime"]
    arr = F.filter(F.array(*[F.when(F.col(n) == 1, F.lit(n)) for n in names]), lambda x: x.isNotNull())
    return f.select("hour", "bike_count", arr.alias("flags"))


@query("run_metadata", f"""
WITH {META_SQL}
SELECT (SELECT count(DISTINCT user_id) FROM clean) AS n_users, (SELECT count(*) FROM meta) AS n_items,
       (SELECT count(*) FROM clean) AS n_ratings,
       (SELECT count(*) FROM meta WHERE rating_count >= 30) AS n_cf_items,
       round(m, 6) AS m, round(c, 6) AS C FROM mc""")
def run_metadata(spark, sf):
    clean = _clean(spark, sf)
    return R.run_metadata(_meta(spark, sf), clean, HYBRID_MIN)


# The evaluation keeps the reference's CF floor of 20 ratings on the training split.
EVAL_CF_MIN = 20
_CF_TRAIN = (CF_SQL[len(CLEAN_SQL) + 1:].replace("FROM clean", "FROM train")
             .replace("HAVING count(*) >= 30", f"HAVING count(*) >= {EVAL_CF_MIN}"))


@query("eval_topk", f"""
WITH {CLEAN_SQL},
train AS (SELECT * FROM clean WHERE rated_at < TIMESTAMP '{SPLIT_CUTOFF}'),
test AS (SELECT * FROM clean WHERE rated_at >= TIMESTAMP '{SPLIT_CUTOFF}'),
{_CF_TRAIN}, {GENRES_SQL},
seeds AS (SELECT user_id, item_id AS seed FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, rated_at DESC, item_id) AS rn
            FROM train WHERE rating >= 4) t WHERE rn = 1),
rel AS (SELECT DISTINCT user_id, item_id FROM test WHERE rating >= 4),
nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id),
ev AS (SELECT s.user_id, seed, n_rel FROM seeds s JOIN nrel ON s.user_id = nrel.user_id),
seen AS (SELECT DISTINCT user_id, item_id FROM train),
tstats AS (SELECT item_id, count(*) AS rc, avg(rating) AS rm FROM train GROUP BY item_id),
tmeta AS (SELECT i.item_id, coalesce(rc, 0) AS rc, coalesce(rm, 0.0) AS rm FROM items i LEFT JOIN tstats t ON i.item_id = t.item_id),
tmc AS (SELECT (SELECT quantile_cont(rc, 0.6) FROM tmeta) AS m, (SELECT avg(rm) FROM tmeta WHERE rc > 0) AS c),
tpop AS (SELECT item_id, CAST(rc AS DOUBLE) / (rc + m) * rm + m / (rc + m) * c AS ps FROM tmeta, tmc),
poprec AS (SELECT user_id, item_id FROM (
             SELECT ev.user_id, p.item_id, row_number() OVER (PARTITION BY ev.user_id ORDER BY p.ps DESC, p.item_id) AS rn
             FROM ev CROSS JOIN tpop p
             WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_id = ev.user_id AND seen.item_id = p.item_id)) t
           WHERE rn <= 10),
conrec AS (SELECT user_id, j AS item_id FROM (
             SELECT ev.user_id, csim.j, row_number() OVER (PARTITION BY ev.user_id ORDER BY csim.score DESC, csim.j) AS rn
             FROM ev JOIN csim ON csim.i = ev.seed
             WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_id = ev.user_id AND seen.item_id = csim.j)) t
           WHERE rn <= 10),
cfrec AS (SELECT user_id, j AS item_id FROM (
            SELECT ev.user_id, cfdense.j, row_number() OVER (PARTITION BY ev.user_id ORDER BY cfdense.score DESC, cfdense.j) AS rn
            FROM ev JOIN cfdense ON cfdense.i = ev.seed
            WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_id = ev.user_id AND seen.item_id = cfdense.j)) t
          WHERE rn <= 10),
allrec AS (SELECT 'popularity' AS algorithm, user_id, item_id FROM poprec
           UNION ALL SELECT 'content_based', user_id, item_id FROM conrec
           UNION ALL SELECT 'item_based_cf', user_id, item_id FROM cfrec),
ua AS (SELECT 'popularity' AS algorithm, user_id, n_rel FROM ev
       UNION ALL SELECT 'content_based', user_id, n_rel FROM ev
       UNION ALL SELECT 'item_based_cf', user_id, n_rel FROM ev WHERE seed IN (SELECT item_id FROM elig)),
hits AS (SELECT a.algorithm, a.user_id, count(*) AS h FROM allrec a
         JOIN rel ON rel.user_id = a.user_id AND rel.item_id = a.item_id GROUP BY 1, 2)
SELECT ua.algorithm, count(*) AS evaluated_users, round(avg(coalesce(h, 0) / 10.0), 6) AS precision_at_k,
       round(avg(coalesce(h, 0) / n_rel), 6) AS recall_at_k
FROM ua LEFT JOIN hits ON hits.algorithm = ua.algorithm AND hits.user_id = ua.user_id GROUP BY ua.algorithm""")
def eval_topk(spark, sf):
    clean = written(_clean(spark, sf).select("user_id", "item_id", "rating", "rated_at"), "clean")  # both splits feed several branches
    e = R.eval_topk(view(spark, sf, "items"), clean, 10, min_ratings=EVAL_CF_MIN, cutoff=SPLIT_CUTOFF, parts=_parts(spark, sf))
    return e.select("algorithm", "evaluated_users", F.round("precision_at_k", 6).alias("precision_at_k"),
                    F.round("recall_at_k", 6).alias("recall_at_k"))


@query("run_metadata_json", f"""
WITH {META_SQL}
SELECT (SELECT count(DISTINCT user_id) FROM clean) AS n_users, (SELECT count(*) FROM meta) AS n_items,
       (SELECT count(*) FROM clean) AS n_ratings,
       (SELECT count(*) FROM meta WHERE rating_count >= 30) AS n_cf_items,
       round(m, 6) AS m, round(c, 6) AS C FROM mc""")
def run_metadata_json(spark, sf):
    """Run metadata as a nested one-row document written as JSON and read back."""
    from tessera.session import scratch_dir
    from tessera.sources import files as FS
    flat = R.run_metadata(_meta(spark, sf), _clean(spark, sf), HYBRID_MIN)
    doc = flat.select(F.struct("n_users", "n_items", "n_ratings", "n_cf_items").alias("counts"),
                      F.struct(F.lit(R.POPULARITY_QUANTILE).alias("quantile"), "m", "C").alias("popularity"),
                      F.struct(F.lit(HYBRID_MIN).alias("cf_min_ratings"),
                               F.lit(R.DEFAULT_TOP_N).alias("top_n")).alias("parameters"))
    path = FS.write_json(doc.coalesce(1), scratch_dir(spark, "run-metadata"))
    back = spark.read.schema(doc.schema).json(path)
    return back.select("counts.*", "popularity.m", "popularity.C")
