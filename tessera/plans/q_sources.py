"""Sources and sinks (S1-S4, S8, S10, S12): every key writes its input with Spark
into the shared scratch folder and reads it back with an explicit schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators import recommend as R
from tessera.plans.q_recommend import CF_SQL, CLEAN_SQL, META_SQL
from tessera.plans.registry import query
from tessera.session import scratch_dir
from tessera.sources import files as FS
from tessera.sources.fixtures import RATING_ORDER, view
from tessera.sources.tables import table

CHURN_SCHEMA = ("customer_id long, age int, offer string, contract string, monthly_charge double, "
                "country string, tenure long, churn_label string")


@query("src_typed_scan", """
SELECT l_orderkey, CAST(l_linenumber AS TINYINT) AS l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def src_typed_scan(spark, sf):
    """Column pruning plus narrow types on read (S1); the parquet scan reads 4 columns."""
    from pyspark.sql import types as T
    from tessera.sources.tables import typed_scan
    li = table(spark, sf, "lineitem")
    return typed_scan(li, {"l_orderkey": T.LongType(), "l_linenumber": T.ByteType(),
                           "l_quantity": T.DoubleType(), "l_returnflag": T.StringType()})


@query("src_csv_roundtrip", "SELECT * FROM churn")
def src_csv_roundtrip(spark, sf):
    path = FS.write_csv(view(spark, sf, "churn"), scratch_dir(spark, "churn-csv"))
    return FS.read_csv(spark, path, CHURN_SCHEMA)


@query("src_null_tokens", """
SELECT customer_id, coalesce(offer, 'None') AS offer_exported, offer AS offer_roundtrip FROM churn""")
def src_null_tokens(spark, sf):
    """Export nulls as the text ``None`` and read that token back as null."""
    c = view(spark, sf, "churn")
    exported = c.na.fill("None", subset=["offer"])
    path = FS.write_csv(exported, scratch_dir(spark, "churn-none"))
    back = FS.read_csv(spark, path, CHURN_SCHEMA, null_value="None")
    return exported.select("customer_id", F.col("offer").alias("offer_exported")).join(
        back.select("customer_id", F.col("offer").alias("offer_roundtrip")), "customer_id")


RIDE_NAMES = ["date", "bike_count", "hour", "temperature", "humidity", "wind_speed", "visibility", "dew_point",
              "rainfall", "snowfall", "season", "holiday", "functioning_day"]
# Korean header of the source file, renamed by position on read (fixed text).
RIDE_HEADER_KO = ["날짜", "대여수", "시간", "기온", "습도", "풍속", "가시거리", "이슬점온도",
                  "강수량", "적설량", "계절", "공휴일", "운영여부"]
RIDE_SCHEMA_KO = ", ".join(f"`{k}` {t}" for k, t in zip(RIDE_HEADER_KO, [
    "string", "int", "int", "double", "int", "double", "int", "double", "double", "double", "string", "string", "string"]))


@query("src_rename_positional", "SELECT * FROM rides")
def src_rename_positional(spark, sf):
    """Legacy-charset CSV with a Korean header, columns renamed by position (S3)."""
    rides = view(spark, sf, "rides").toDF(*RIDE_HEADER_KO)
    spark.conf.set(FS.LEGACY_CHARSETS, "true")
    path = FS.write_csv(rides, scratch_dir(spark, "rides-cp949"), encoding="x-windows-949")
    back = FS.read_csv(spark, path, RIDE_SCHEMA_KO, encoding="x-windows-949")
    return FS.rename_positional(back, RIDE_NAMES)


@query("src_delimited", """
SELECT r.user_id, r.item_id, r.rating, i.title FROM ratings r JOIN items i ON r.item_id = i.item_id""")
def src_delimited(spark, sf):
    """Headerless tab-separated ratings and pipe-separated Latin-1 items."""
    r = view(spark, sf, "ratings").select("user_id", "item_id", "rating")
    i = view(spark, sf, "items").select("item_id", "title", "genres")
    rp = FS.write_csv(r, scratch_dir(spark, "ratings-tsv"), header=False, sep="\t")
    ip = FS.write_csv(i, scratch_dir(spark, "items-pipe"), header=False, sep="|", encoding="ISO-8859-1")
    rb = FS.read_csv(spark, rp, "user_id long, item_id long, rating int", header=False, sep="\t")
    ib = FS.read_csv(spark, ip, "item_id long, title string, genres string", header=False, sep="|",
                     encoding="ISO-8859-1")
    return rb.join(ib.select("item_id", "title"), "item_id").select("user_id", "item_id", "rating", "title")


@query("scenario_json", """
SELECT scenario, count(*) AS n_rows, sum(bike_count) AS total_count FROM (
  SELECT 'summer_evening' AS scenario, bike_count FROM rides WHERE season = 'Summer' AND hour = 18 AND rainfall = 0
  UNION ALL SELECT 'winter_morning', bike_count FROM rides WHERE season = 'Winter' AND hour = 8
  UNION ALL SELECT 'rainy', bike_count FROM rides WHERE rainfall > 0
  UNION ALL SELECT 'snowy', bike_count FROM rides WHERE snowfall > 0
  UNION ALL SELECT 'holiday_afternoon', bike_count FROM rides WHERE holiday = 'Holiday' AND hour = 14
  UNION ALL SELECT 'closed_day', bike_count FROM rides WHERE functioning_day = 'No' AND season = 'Spring' AND rainfall > 5
) s GROUP BY scenario""")
def scenario_json(spark, sf):
    """Scenario inputs and their answers written as JSON, read back."""
    from tessera.operators.sampling import scenario_filter
    s = scenario_filter(view(spark, sf, "rides"))
    inputs = FS.write_json(s.drop("bike_count"), scratch_dir(spark, "scenario-inputs"))
    answers = FS.write_json(s.select("scenario", "bike_count"), scratch_dir(spark, "scenario-answers"))
    a = spark.read.schema("scenario string, bike_count int").json(answers)
    n_in = spark.read.json(inputs).groupBy("scenario").agg(F.count(F.lit(1)).alias("n_rows"))
    tot = a.groupBy("scenario").agg(F.sum("bike_count").alias("total_count"))
    return n_in.join(tot, "scenario")


@query("sim_table_roundtrip", f"""
WITH {CF_SQL}
SELECT item_i, item_j, round(similarity, 6) AS similarity FROM sim""")
def sim_table_roundtrip(spark, sf):
    """Item similarity saved as Parquet partitioned by a hash of item_i, loaded back."""
    sims = R.item_cf_similarity(Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER), 30)
    path = FS.write_parquet_partitioned(sims, scratch_dir(spark, "item-sim"), "item_i")
    back = spark.read.parquet(path)
    return back.select("item_i", "item_j", F.round("similarity", 6).alias("similarity"))


@query("metadata_roundtrip", f"""
WITH {META_SQL}
SELECT item_id, title, clean_title, release_year, rating_count, round(rating_mean, 6) AS rating_mean,
       list_sort(genres) AS genres_sorted FROM meta""")
def metadata_roundtrip(spark, sf):
    """Item metadata saved as Parquet and loaded back."""
    meta = R.item_metadata(view(spark, sf, "items"), Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER))
    path = scratch_dir(spark, "item-metadata")
    meta.write.parquet(path)
    m = spark.read.schema(meta.schema).parquet(path)
    return m.select("item_id", "title", "clean_title", "release_year", "rating_count", F.round("rating_mean", 6).alias("rating_mean"),
                    F.array_sort("genres").alias("genres_sorted"))


@query("features_roundtrip", """
SELECT date, hour, bike_count, CAST(hour IN (7, 8, 17, 18, 19, 20) AS INT) AS IsRushHour,
       CAST(coalesce(rainfall > 0, false) OR coalesce(snowfall > 0, false) AS INT) AS IsPrecipitation FROM rides""")
def features_roundtrip(spark, sf):
    """Ride features saved as Parquet and loaded back."""
    from tessera.operators.features import ride_features
    feats = ride_features(view(spark, sf, "rides"), severity=False)
    path = scratch_dir(spark, "ride-features")
    feats.write.parquet(path)
    return spark.read.schema(feats.schema).parquet(path).select("date", "hour", "bike_count", "IsRushHour", "IsPrecipitation")


@query("bucketed_co_ratings", f"""
WITH {CLEAN_SQL},
c AS (SELECT user_id, item_id, rating - avg(rating) OVER (PARTITION BY user_id) AS centered FROM clean)
SELECT a.item_id AS item_i, b.item_id AS item_j, count(*) AS n_users, round(sum(a.centered * b.centered), 6) AS dot
FROM c a JOIN c b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2""")
def bucketed_co_ratings(spark, sf):
    """Centred co-rating products from ratings saved once by user: centring and self join without a shuffle."""
    clean = Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER).select("user_id", "item_id", "rating")
    path = scratch_dir(spark, "ratings-by-user")
    saved = FS.write_bucketed(clean, f"ratings_by_user_{path[-12:]}", path, "user_id", 16)
    return R.bucketed_dots(saved).select("item_i", "item_j", "n_users", F.round("dot", 6).alias("dot"))
