"""Item recommender: metadata, Bayesian popularity, content and item-CF similarity,
hybrid fallback, catalogue search, and offline precision / recall at K.

R1-R11, J2-J9, W1, W2, W5, E10.

Similarity top-N needs no item x item matrix.  Content: items with equal genre sets
form one class, classes meet through an inverted index on genres, and a class takes
only the first few items of each neighbour.  Item CF: the pairs with a common user are the
candidates.  Lists that stay short are filled with zero-similarity items in id order,
as in a dense matrix, from the first ids of the catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import split_title_year_cols
from tessera.operators.ordered import global_rank, quantile_row
from tessera.operators.quality import clean_ratings  # noqa: F401  (re-export)
from tessera.session import cut_lineage, written
from tessera.sources.tables import dealt

# Fixed values of the reference recommender.
POPULARITY_QUANTILE = 0.6
DEFAULT_TOP_N = 10
TOP_N_MAX = 30
CATALOGUE_LIMIT_DEFAULT = 20
CATALOGUE_LIMIT_MAX = 200
LIKED_RATING = 4
CONTENT_MIN_RATINGS = 10
POPULAR_MIN_RATINGS = 30
CF_MIN_RATINGS = 20
SCORE_DIGITS, BASIC_SCORE_DIGITS = 4, 3
# Ranks handed out at a time when a user's candidates are expanded.
RANK_CHUNK = 1024


def check_limit(n: int, lo: int = 1, hi: int = CATALOGUE_LIMIT_MAX) -> int:
    """Bounded limit argument (K3)."""
    if not isinstance(n, int) or n < lo or n > hi:
        raise ValueError(f"limit must be an integer in [{lo}, {hi}], got {n!r}")
    return n


def genre_array(col: str = "genres") -> F.Column:
    """Delimited ``A|B|C`` text to an array of distinct genres."""
    return F.array_distinct(F.filter(F.split(F.col(col), r"\|"), lambda g: g != ""))


def item_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("rating_count"),
                                          F.avg("rating").alias("rating_mean"))


def item_metadata(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Catalogue + title/year split + genre list + rating stats, 0 for unrated."""
    stats = item_stats(ratings)
    clean_title, year = split_title_year_cols("title")
    return (items.join(stats, "item_id", "left")
            .select("item_id", "title", clean_title.alias("clean_title"), year.alias("release_year"),
                    F.lower(clean_title).alias("search_title"), genre_array().alias("genres"),
                    F.coalesce("rating_count", F.lit(0)).alias("rating_count"),
                    F.coalesce("rating_mean", F.lit(0.0)).alias("rating_mean")))


def popularity_params(meta: DataFrame, quantile: float = POPULARITY_QUANTILE) -> DataFrame:
    """One row (m, C): m = quantile of counts over all items, C = mean of item means over rated items."""
    m = quantile_row(meta, "rating_count", [quantile], ["m"])
    c = meta.where("rating_count > 0").agg(F.avg("rating_mean").alias("C"))
    return m.crossJoin(c)


def bayes_popularity(meta: DataFrame, quantile: float = POPULARITY_QUANTILE) -> DataFrame:
    """v/(v+m)*R + m/(v+m)*C as ``popularity_score`` (R1); (m, C) is one broadcast row."""
    # catalogue-sized: materialise once so the ratings are aggregated once,
    # not once per branch (quantile, mean of means, scoring)
    meta = cut_lineage(meta)
    mc = popularity_params(meta, quantile)
    v = F.col("rating_count").cast("double")
    return (meta.crossJoin(F.broadcast(mc))
            .withColumn("popularity_score",
                        v / (v + F.col("m")) * F.col("rating_mean") + F.col("m") / (v + F.col("m")) * F.col("C"))
            .drop("m", "C"))


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """Global top-k (K1): ``orderBy().limit()`` plans as TakeOrderedAndProject,
    i.e. a per-partition top-k followed by one merge of k rows per partition."""
    return df.orderBy(*order).limit(k)


def with_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Rank of a small, already limited result (the window sees k rows)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


# --------------------------------------------------------------------------
# Content similarity
# --------------------------------------------------------------------------

GENRE_BLOCK = 1000  # classes of one genre that meet in one join key
SLACK = 1e-12


def _ranked_genres(keyed: DataFrame) -> DataFrame:
    """(gk, gs, size): the genre sets, each ordered from its rarest genre among the sets to its commonest."""
    sets = keyed.select("gk", "gs").distinct()
    flat = sets.select("gk", F.explode("gs").alias("g"))
    held = flat.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    order = F.transform(F.array_sort(F.collect_list(F.struct("n", "g"))), lambda x: x["g"])
    return flat.join(held, "g").groupBy("gk").agg(order.alias("gs")).withColumn("size", F.size("gs"))


def _overlap_score(q: str, c: str) -> F.Column:
    return F.size(F.array_intersect(q, c)) / F.sqrt((F.size(q) * F.size(c)).cast("double"))


def _meet(asking: DataFrame, offered: DataFrame) -> DataFrame:
    """Join on ``g``; the offered classes of a genre are dealt over blocks, and an asking class goes to each block."""
    sizes = offered.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / GENRE_BLOCK).cast("int").alias("blocks"))
    offered = offered.join(sizes, "g").withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")).drop("blocks")
    sent = asking.join(sizes, "g").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return sent.join(offered, ["g", "block"])


def genre_matches(classes: DataFrame) -> DataFrame:
    """(q, m, c, score): for each asking class, the offered classes that can enter a list of ``m`` items.

    ``classes``: gk, gs (rarest genre first), size, m (null: does not ask), held (its candidates; null: offers none).
    A class first meets those that share its rarest genre, which gives a lower bound of its m-th best score.  A
    class of ``nc`` genres reaches the bound t only with ceil(t sqrt(nq nc)) common genres, of which the first lies among
    the nq - that + 1 rarest of the one and the nc - that + 1 rarest of the other.  So a class asks by its rare genres
    only, for each size that may reach the bound, and common genres are keys for the classes that have no rarer ones.
    """
    asking = classes.where("m is not null").select(F.col("gk").alias("q"), "m", F.col("gs").alias("qs"), F.col("size").alias("nq"))
    offered = classes.where("held is not null").select(F.col("gk").alias("c"), "held", F.col("gs").alias("cs"), F.col("size").alias("nc"))
    by_genre = offered.select("c", "held", "cs", "nc", F.posexplode("cs").alias("pc", "g"))
    first = _meet(asking.where("nq > 0").withColumn("g", F.get("qs", F.lit(0))), by_genre).select("q", "m", "c", "held", _overlap_score("qs", "cs").alias("score"))
    # the score at which the candidates of the better classes reach m; sums of a class's scores, not its rows
    tallied = first.groupBy("q", "m", "score").agg(F.sum("held").alias("held"))
    upto = F.sum("held").over(Window.partitionBy("q").orderBy(F.desc("score")))  # one row per possible score
    bound = tallied.withColumn("upto", upto).where("upto >= m").groupBy("q").agg(F.max("score").alias("t"))
    asked = asking.join(bound, "q", "left").withColumn("t", F.coalesce("t", F.lit(0.0)) * (1 - SLACK))
    sizes = offered.agg(F.collect_set("nc").alias("sizes"))  # the few sizes that sets have
    need = F.greatest(F.ceil(F.col("t") * F.sqrt((F.col("nq") * F.col("want")).cast("double")) - SLACK), F.lit(1))
    sent = (asked.crossJoin(F.broadcast(sizes)).withColumn("want", F.explode("sizes")).withColumn("need", need.cast("int"))
            .where("need <= nq and need <= want").select("q", "m", "qs", "want", "need", F.posexplode(F.expr("slice(qs, 1, nq - need + 1)")).alias("pq", "g")))
    # one row per genre asked for, with the sizes asked of it
    wants = sent.groupBy("q", "m", "qs", "g").agg(F.map_from_entries(F.collect_list(F.struct("want", "need"))).alias("wants"))
    met = _meet(wants, by_genre.drop("held")).where(F.col("pc") <= F.col("nc") - F.try_element_at("wants", F.col("nc")))
    return met.select("q", "m", "c", _overlap_score("qs", "cs").alias("score")).distinct()


def content_lists(items: DataFrame, need: DataFrame) -> DataFrame:
    """Genre-cosine neighbours: item_id, similar_item_id, score, rank, self excluded.

    ``items``: item_id, genres, is_candidate.  ``need``: item_id, n (its list length).
    Ties go to the smaller id; zero scores fill a list up.
    """
    sets = F.array_sort(F.coalesce("genres", F.array().cast("array<string>")))
    keyed = cut_lineage(items.select("item_id", sets.alias("gs"), "is_candidate").withColumn("gk", F.array_join("gs", "\x01")))
    want = cut_lineage(need.join(keyed.select("item_id", "gk"), "item_id"))
    need_class = want.groupBy("gk").agg((F.max("n") + 1).cast("long").alias("m"))  # one more for the item itself
    most = need_class.agg(F.max("m")).first()[0] or 0
    in_class = F.row_number().over(Window.partitionBy("gk").orderBy("item_id"))
    members = cut_lineage(keyed.where("is_candidate").select("gk", "item_id", in_class.alias("pos")).where(F.col("pos") <= most))

    size_of = members.groupBy("gk").agg(F.count(F.lit(1)).alias("held"))  # at most `most`, which no list exceeds
    classes = written(_ranked_genres(keyed).join(need_class, "gk", "left").join(size_of, "gk", "left"), "genre-classes")
    scored = genre_matches(classes)
    rows = scored.join(members.select(F.col("gk").alias("c"), F.col("item_id").alias("similar_item_id"), "pos"), "c").where("pos <= m")
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "similar_item_id"))
    ranked = cut_lineage(rows.withColumn("rank", best).where((F.col("rank") <= most) & (F.col("rank") <= F.col("m")))
                         .select("q", "similar_item_id", "score", "rank"))

    # of the first m ids at most `found` have a score, so they hold the zeros that are missing
    found = ranked.groupBy("q").agg(F.count(F.lit(1)).alias("found"))
    short = (need_class.withColumnRenamed("gk", "q").join(found, "q", "left").fillna(0, ["found"]).where("found < m")
             .select("q", "m", "found", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("pos")))
    by_id = global_rank(keyed.where("is_candidate").select(F.col("item_id").alias("similar_item_id")), [F.col("similar_item_id")], "pos")
    zeros = short.join(by_id, "pos").join(ranked.select("q", "similar_item_id"), ["q", "similar_item_id"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("q").orderBy("similar_item_id"))
    zeros = zeros.select("q", "similar_item_id", F.lit(0.0).alias("score"), (F.col("found") + nth).cast("int").alias("rank"), "m").where("rank <= m").drop("m")

    lists = cut_lineage(ranked.unionByName(zeros)).withColumnRenamed("q", "gk")
    own = (want.select("item_id", "gk").join(lists.select("gk", F.col("similar_item_id").alias("item_id"), F.col("rank").alias("own")), ["gk", "item_id"])
           .select("item_id", "own"))
    place = F.col("rank") - F.coalesce((F.col("own") < F.col("rank")).cast("int"), F.lit(0))
    return (want.join(own, "item_id", "left").join(lists, "gk").where("similar_item_id <> item_id").withColumn("rank", place)
            .where("rank <= n").select("item_id", "similar_item_id", "score", "rank"))


def content_topn(meta: DataFrame, n: int = DEFAULT_TOP_N, min_candidate_ratings: int = 0) -> DataFrame:
    """Genre-cosine top-n for every item, self excluded (R2 / J8; R9 with a floor)."""
    check_limit(n, hi=TOP_N_MAX)
    items = meta.select("item_id", "genres", (F.col("rating_count") >= min_candidate_ratings).alias("is_candidate"))
    return content_lists(items, meta.select("item_id", F.lit(n).alias("n")))


# --------------------------------------------------------------------------
# Item-based collaborative filtering
# --------------------------------------------------------------------------

def eligible_items(ratings: DataFrame, min_ratings: int = CF_MIN_RATINGS, materialise: bool = False) -> DataFrame:
    """Items with at least ``min_ratings`` ratings (catalogue-sized)."""
    e = (ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("rating_count"))
         .where(F.col("rating_count") >= min_ratings).select("item_id"))
    return cut_lineage(e) if materialise else e


def center_ratings(ratings: DataFrame) -> DataFrame:
    """rating - user mean (W5).  The mean is a map-side-combined aggregate joined
    back, not a window, so a user with a third of all rows is not one task."""
    um = ratings.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))
    return ratings.join(um, "user_id").withColumn("centered", F.col("rating") - F.col("user_mean"))


# A user with more eligible ratings than this has their co-rating pairs split
# over several join keys (checked per user from the ratings themselves).
CF_PAIRS_USER_LIMIT = 2000
# Lists of an item up to which one task may take them all, and pairs of a partition.
HOT_ITEM = 10_000
PAIRS_PER_TASK = 2_000_000
# Partitions of pairs whose shuffle is on disk at a time, where only heads of lists are kept.
PARTS_AT_ONCE = 100
ROUNDED = 1e-6


def _dot() -> F.Column:
    return F.sum(F.col("ca") * F.col("cb")).alias("dot")


def _pair_parts(sizes: DataFrame) -> int:
    """Partitions for the pairs of users with these numbers of ratings (column ``d``), ``PAIRS_PER_TASK`` of them in each."""
    pairs = sizes.agg(F.sum(F.col("d").cast("double") * F.col("d"))).first()[0] or 0
    return max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs / PAIRS_PER_TASK) + 1)


def _narrowed(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with whole numbers in the narrowest type that holds them all: they are shuffled once a pair."""
    whole = [c for c in cols if isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType, T.ShortType))]
    ends = df.agg(*[x for c in whole for x in (F.min(c), F.max(c))]).first() if whole else ()
    for i, c in enumerate(whole):
        low, high = ends[2 * i], ends[2 * i + 1]
        bits = next((b for b in (8, 32) if low is not None and -1 << (b - 1) <= low and high < 1 << (b - 1)), 64)
        if bits < {T.LongType: 64, T.IntegerType: 32, T.ShortType: 16}[type(df.schema[c].dataType)]:
            df = df.withColumn(c, F.col(c).cast({8: "byte", 32: "int"}[bits]))
    return df


def user_lists(rows: DataFrame, user_limit: int, extra: list[str]) -> tuple[DataFrame, int]:
    """(mean, own, other) and the number of partitions: each user's mean, and ratings as lists of (item_id, rating, ``extra``...).

    A user of d ratings has ceil(d / user_limit) blocks of items (1 for almost everyone), and each ordered pair of their blocks is a row.
    """
    sizes = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("d"))
    parts = _pair_parts(sizes)
    blocks = F.ceil(F.col("d") / user_limit).cast("int")
    dealt = rows.join(sizes.select("user_id", blocks.alias("blocks")), "user_id").withColumn("blk", F.pmod(F.xxhash64("item_id"), F.col("blocks")).cast("int"))
    own = F.collect_list(F.struct("item_id", "rating", *extra)).alias("own")
    lists = dealt.groupBy("user_id", "blk", "blocks").agg(own, F.first("user_mean").alias("mean"))
    if sizes.where(F.col("d") > user_limit).isEmpty():
        return lists.select("mean", "own", F.col("own").alias("other")).repartition(parts), parts
    lists = written(lists, "user-lists")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = lists.select("user_id", F.col("blk").alias("ba"), "mean", "own", every.alias("bb")).repartition(parts, "user_id", "ba", "bb")
    right = lists.select("user_id", F.col("blk").alias("bb"), F.col("own").alias("other"), every.alias("ba")).repartition(parts, "user_id", "ba", "bb")
    return left.hint("shuffle_hash").join(right, ["user_id", "ba", "bb"]).select("mean", "own", "other"), parts


def list_dots(lists: DataFrame, parts: int, asking: list[str], offered: list[str], upper: bool, aggregates: list[F.Column]) -> DataFrame:
    """(a, salt, b, aggregates...) of all co-rated pairs, ``a < b`` only if ``upper``.

    What is shuffled is the list of a user's other ratings, once to each of their items ``a``: a few bytes a pair, where a row of a pair takes
    some tens.  Ratings are centred, and the products made and summed, behind the shuffle, where all lists of ``a`` are together.  An item
    with ``salts`` > 1 (an entry's field) is dealt by the other item's hash.  ``asking`` and ``offered`` are the fields of
    ``a`` (as given) and of ``b`` (with ``_b`` behind) that the aggregates read; a null ``n`` in ``asking`` does not ask.
    """
    rows = lists.select(F.explode("own").alias("x"), "mean", "other")
    rows = rows.select(F.col("x.item_id").alias("a"), F.col("x.rating").alias("ra"), "mean", *[F.col(f"x.{f}").alias(f) for f in asking],
                       F.col("x.salts").alias("salts"), "other")
    if "n" in asking:
        rows = rows.where("n is not null")
    rows = rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    wanted = lambda o: (o["item_id"] > F.col("a") if upper else o["item_id"] != F.col("a")) & (
        (F.col("salts") == 1) | (F.pmod(F.xxhash64(o["item_id"]), F.col("salts")) == F.col("salt")))
    rows = rows.withColumn("other", F.filter("other", wanted)).where(F.size("other") > 0)
    fields = ["item_id", "rating", *offered]
    names = ["b", "rb", *[f"{f}_b" for f in offered]]
    sent = rows.select("a", "salt", "ra", "mean", *asking, *[F.col(f"other.{f}").alias(name) for f, name in zip(fields, names, strict=True)])
    pairs = sent.repartition(parts, "a", "salt").select("a", "salt", (F.col("ra") - F.col("mean")).alias("ca"), "mean", *asking, F.inline(F.arrays_zip(*names)))
    return pairs.withColumn("cb", F.col("rb") - F.col("mean")).groupBy("a", "salt", "b").agg(*aggregates)


def bucketed_dots(saved: DataFrame) -> DataFrame:
    """(item_i, item_j, n_users, dot) of all co-rated pairs, for ratings saved in buckets by user.

    Means, centring and the users' lists use the saved partitioning and order; only what the products are made of is shuffled, by item.
    """
    item_type, saved = saved.schema["item_id"].dataType, _narrowed(saved, "item_id", "rating")
    means = saved.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))
    hot = saved.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 10 * HOT_ITEM).collect()  # at most one for so many ratings
    salts = F.lit(1)
    if hot:
        salts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for r in hot for x in (r["item_id"], r["n"] // HOT_ITEM + 1)]), F.col("item_id")), F.lit(1))
    rated = saved.join(means.hint("merge"), "user_id").select("user_id", "user_mean", "item_id", "rating", salts.cast("int").alias("salts"))
    own = F.collect_list(F.struct("item_id", "rating", "salts")).alias("own")
    lists = rated.groupBy("user_id").agg(own, F.first("user_mean").alias("mean")).select("mean", "own", F.col("own").alias("other"))
    parts = _pair_parts(saved.groupBy("user_id").agg(F.count(F.lit(1)).alias("d")))
    dots = list_dots(lists, parts, [], [], True, [F.count(F.lit(1)).alias("n_users"), _dot()])
    return dots.select(F.col("a").cast(item_type).alias("item_i"), F.col("b").cast(item_type).alias("item_j"), "n_users", "dot")


def item_cf_similarity(ratings: DataFrame, min_ratings: int = CF_MIN_RATINGS,
                       user_limit: int = CF_PAIRS_USER_LIMIT,
                       elig: DataFrame | None = None) -> DataFrame:
    """Cosine similarity of user-centred rating vectors for co-rated eligible items,
    one row per pair with ``item_i < item_j`` (R3, J5, W5, J7).

    Pairs are made behind the shuffle, from the users' lists (:func:`list_dots`).  A user with d ratings gets
    ceil(d / user_limit) item blocks, so a user holding a third of all ratings is split over many rows while ordinary users are not
    copied at all, and a hot item is dealt over salts.
    """
    if elig is None:
        elig = eligible_items(ratings, min_ratings)
    r = ratings.select("user_id", "item_id", "rating").join(elig, "item_id", "left_semi")
    # narrow columns, read by the norms and by the lists: written once instead of re-deriving the cleaned ratings per branch
    item_type = r.schema["item_id"].dataType
    c = _narrowed(written(center_ratings(r).select("user_id", "item_id", "rating", "user_mean"), "cf-ratings"), "item_id", "rating")
    centred = F.col("rating") - F.col("user_mean")
    items = c.groupBy("item_id").agg(F.sqrt(F.sum(centred * centred)).alias("norm"),
                                     F.ceil(F.count(F.lit(1)) / HOT_ITEM).cast("int").alias("salts"))
    lists, parts = user_lists(c.join(items, "item_id"), user_limit, ["norm", "salts"])
    dots = list_dots(lists, parts, ["norm"], ["norm"], True, [_dot(), F.max("norm").alias("ni"), F.max("norm_b").alias("nj")])
    sim = F.coalesce(F.try_divide(F.col("dot"), F.col("ni") * F.col("nj")), F.lit(0.0))
    return dots.select(F.col("a").cast(item_type).alias("item_i"), F.col("b").cast(item_type).alias("item_j"), sim.alias("similarity"))


def _heads(rows: DataFrame, norms: DataFrame, need: DataFrame, user_limit: int) -> DataFrame:
    """(item_id, similar_item_id, score, n) of the first n pairs of each item, and of all pairs of an item without n positive scores.

    Lists carry items by their place in id order and norms in single precision.  That gives scores to 1.2e-7, by which all but
    the pairs within ``ROUNDED`` of the n-th best are dropped where they are made; the others get their exact norms and scores.
    Pairs are made in lots of about ``PARTS_AT_ONCE`` partitions, whatever their number.
    """
    places = written(global_rank(norms, [F.col("item_id")], "place").withColumn("place", F.col("place").cast("int")), "cf-places")
    wanted = places.join(need, "item_id", "left").withColumn("near", F.col("norm").cast("float"))
    placed = rows.join(wanted, "item_id").drop("item_id").withColumnRenamed("place", "item_id")
    lists, parts = user_lists(placed, user_limit, ["near", "n", "salts"])
    lots = -(-parts // PARTS_AT_ONCE)
    if lots == 1:
        return _heads_of(lists, parts, places)
    lists, out = written(lists, "cf-lists"), None
    for lot in range(lots):  # each with the items of its share of the hashes; its shuffle goes before the next
        own = F.filter("own", lambda x: F.pmod(F.xxhash64(x["item_id"]), F.lit(lots)) == lot)  # noqa: B023
        heads = written(_heads_of(lists.withColumn("own", own), -(-parts // lots), places), "cf-heads")
        out = heads if out is None else out.unionByName(heads)
    return out


def _heads_of(lists: DataFrame, parts: int, places: DataFrame) -> DataFrame:
    """The heads of the items that ask in ``lists``."""
    pairs = list_dots(lists, parts, ["near", "n"], ["near"], False, [_dot(), F.max("n").alias("n"), F.max("near").alias("near"), F.max("near_b").alias("near_b")])
    own = Window.partitionBy("a", "salt")
    about = F.col("dot") / (F.col("near").cast("double") * F.col("near_b"))
    pairs = pairs.where("dot <> 0").withColumn("about", about).withColumn("nth", F.row_number().over(own.orderBy(F.desc("about"))))
    pairs = pairs.withColumn("last", F.max(F.when(F.col("nth") == F.col("n"), F.col("about"))).over(own))
    kept = pairs.where(F.col("last").isNull() | (F.col("last") <= 0) | (F.col("about") >= F.col("last") * (1 - ROUNDED))).select("a", "b", "dot", "n")
    of = lambda place, item, x: places.select(F.col("place").alias(place), F.col("item_id").alias(item), F.col("norm").alias(x))
    whole = kept.join(of("a", "item_id", "ni"), "a").join(of("b", "similar_item_id", "nj"), "b")
    return whole.select("item_id", "similar_item_id", (F.col("dot") / (F.col("ni") * F.col("nj"))).alias("score"), "n")


def cf_candidates(ratings: DataFrame, need: DataFrame, elig: DataFrame, user_limit: int = CF_PAIRS_USER_LIMIT) -> DataFrame:
    """(item_id, similar_item_id, score, n): every co-rated pair that can enter the list of ``item_id`` (R4, W2); of an item with fewer than n
    positive scores all pairs whose score is not 0.

    ``need``: item_id, n (its list length).  Users with at most ``user_limit`` eligible ratings give partial dot
    products.  What the few users above add to a pair is at most S_i S_j, the norms of the two items over those users.
    So the n-th best of (partial - S_i S_j) is a lower bound of an item's n-th best score, and a pair
    whose (partial + S_i S_j) stays below it is dropped before the heavy users' products are made.  An item meets all
    items of its heavy users only if S_i max(S) reaches its bound, or if its bound is not above 0: then zeros and
    negative scores can enter its list, and all its pairs are made.
    """
    r = ratings.select("user_id", "item_id", "rating").join(elig, "item_id", "left_semi")
    rows = center_ratings(r).select("user_id", "item_id", "rating", "user_mean")
    deg = r.groupBy("user_id").agg((F.count(F.lit(1)) > user_limit).alias("heavy"))
    c = _narrowed(written(rows.join(deg, "user_id"), "cf-ratings"), "rating").withColumn("centered", F.col("rating") - F.col("user_mean"))
    norms = c.groupBy("item_id").agg(F.sqrt(F.sum(F.col("centered") * F.col("centered"))).alias("norm"),
                                     F.sqrt(F.sum(F.when(F.col("heavy"), F.col("centered") * F.col("centered")).otherwise(0.0))).alias("hnorm"),
                                     F.ceil(F.count(F.lit(1)) / HOT_ITEM).cast("int").alias("salts"))
    norms = written(norms.where("norm > 0"), "cf-norms")
    light, heavy = c.where("not heavy").drop("heavy"), c.where("heavy").drop("heavy")
    side = lambda df, item, w: df.select("user_id", F.col("item_id").alias(item), F.col("centered").alias(w))
    norm_of = lambda item, x: norms.select(F.col("item_id").alias(item), F.col("norm").alias(f"n{x}"), F.col("hnorm").alias(f"h{x}"))
    mine, theirs = need.join(norm_of("item_id", "i"), "item_id"), norm_of("similar_item_id", "j")
    score = F.col("dot") / (F.col("ni") * F.col("nj"))
    if heavy.isEmpty():
        return written(_heads(light, norms, need, user_limit), "cf-candidates")
    lists, parts = user_lists(light.join(norms.join(need, "item_id", "left"), "item_id"), user_limit, ["norm", "hnorm", "n", "salts"])
    same = [F.max("n").alias("n"), F.max("norm").alias("ni"), F.max("hnorm").alias("hi"), F.max("norm_b").alias("nj"), F.max("hnorm_b").alias("hj")]
    scored = list_dots(lists, parts, ["norm", "hnorm", "n"], ["norm", "hnorm"], False, [_dot(), *same])
    scored = scored.withColumnsRenamed({"a": "item_id", "b": "similar_item_id"})

    spread = F.col("hi") * F.col("hj") / (F.col("ni") * F.col("nj")) + SLACK
    low = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("low")))
    most = need.agg(F.max("n")).first()[0] or 0
    bound = (scored.withColumn("low", score - spread).withColumn("nth", low).where((F.col("nth") <= most) & (F.col("nth") == F.col("n")) & (F.col("low") > 0))
             .select("item_id", F.col("low").alias("t")))
    reach = norms.agg(F.max(F.col("hnorm") / F.col("norm")).alias("far"))
    items = mine.join(bound, "item_id", "left").crossJoin(F.broadcast(reach))  # one row
    items = written(items.withColumn("open", F.col("t").isNull() | (F.col("hi") / F.col("ni") * F.col("far") + SLACK >= F.col("t"))).drop("far"), "cf-bounds")
    near = scored.join(items.select("item_id", "t", "open"), "item_id").where(F.col("open") | (score + spread >= F.col("t")))
    near = written(near.select("item_id", "similar_item_id", "dot", "open"), "cf-near")

    # heavy products of the open items: with every item of their users, which are dealt over blocks of items
    blocks = heavy.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / user_limit).cast("int").alias("blocks"))
    dealt = side(heavy, "b", "cb").join(blocks, "user_id").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")).drop("blocks")
    asked = side(heavy, "a", "ca").join(items.where("open").select(F.col("item_id").alias("a")), "a", "left_semi").join(blocks, "user_id")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    product = F.sum(F.col("ca") * F.col("cb")).alias("more")
    wide = asked.join(dealt, ["user_id", "block"]).where("a <> b").groupBy("a", "b").agg(product)
    # of the others: only with the items that are left
    left = near.where("not open").select(F.col("item_id").alias("a"), F.col("similar_item_id").alias("b"))
    narrow = left.join(side(heavy, "a", "ca"), "a").join(side(heavy, "b", "cb"), ["user_id", "b"]).groupBy("a", "b").agg(product)
    more = wide.unionByName(narrow).select(F.col("a").alias("item_id"), F.col("b").alias("similar_item_id"), "more")
    whole = near.select("item_id", "similar_item_id", "dot").join(more, ["item_id", "similar_item_id"], "full")
    whole = whole.withColumn("dot", F.coalesce("dot", F.lit(0.0)) + F.coalesce("more", F.lit(0.0)))
    return written(whole.join(mine, "item_id").join(theirs, "similar_item_id").select("item_id", "similar_item_id", score.alias("score"), "n"), "cf-candidates")


def cf_lists(elig: DataFrame, both: DataFrame, need: DataFrame) -> DataFrame:
    """CF neighbours over all eligible items: item_id, similar_item_id, score, rank.

    ``both``: item_id, similar_item_id, score, n, as of :func:`cf_candidates`; ``need``: item_id, n (its list
    length).  Pairs without a common user score 0 and rank,
    in id order, above negative pairs.  The work is linear in the pairs and the lists.
    """
    both = both.where("score <> 0")
    most = need.agg(F.max("n")).first()[0] or 0
    have = both.groupBy("item_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum((F.col("score") > 0).cast("long")).alias("above"))
    short = written(need.join(have, "item_id", "left").fillna(0, ["pairs", "above"]).where("above < n"), "cf-short")
    # of the first n + pairs + 1 ids at most `pairs` have a score and one is the item itself
    tries = _chunked_ranks(short, "item_id", F.col("n") + F.col("pairs") + 1, ["n"])
    by_id = global_rank(elig.select(F.col("item_id").alias("similar_item_id")), [F.col("similar_item_id")])
    taken = both.join(short.select("item_id"), "item_id", "left_semi").select("item_id", "similar_item_id")
    zeros = (tries.join(by_id, "rank").where("similar_item_id <> item_id")
             .join(taken, ["item_id", "similar_item_id"], "left_anti")
             .withColumn("nth", F.row_number().over(Window.partitionBy("item_id").orderBy("similar_item_id")))
             .where((F.col("nth") <= most) & (F.col("nth") <= F.col("n"))).select("item_id", "similar_item_id", F.lit(0.0).alias("score"), "n"))
    best = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), "similar_item_id"))
    rows = both.select("item_id", "similar_item_id", "score", "n").unionByName(zeros).withColumn("rank", best)
    return rows.where((F.col("rank") <= most) & (F.col("rank") <= F.col("n"))).drop("n")


def item_cf_topn(ratings: DataFrame, n: int = DEFAULT_TOP_N, min_ratings: int = CF_MIN_RATINGS, elig: DataFrame | None = None,
                 user_limit: int = CF_PAIRS_USER_LIMIT) -> DataFrame:
    """Top-n CF neighbours of every eligible item over all eligible items."""
    check_limit(n, hi=TOP_N_MAX)
    if elig is None:
        elig = eligible_items(ratings, min_ratings, materialise=True)  # read twice below
    need = elig.select("item_id", F.lit(n).alias("n"))
    return cf_lists(elig, cf_candidates(ratings, need, elig, user_limit), need)


def common_genres(cand: str = "cand_genres", base: str = "base_genres") -> F.Column:
    """Genres the candidate shares with the query item, in candidate order."""
    return F.array_intersect(F.col(cand), F.col(base))


def recommendation_reason(algorithm: F.Column, shared: F.Column) -> F.Column:
    """Text reason from the algorithm and the shared genres."""
    joined = F.array_join(shared, ", ")
    has = F.size(shared) > 0
    return (F.when(algorithm == "item_based_cf",
                   F.when(has, F.concat(F.lit("Users who liked this item also rated these highly (shared genres: "),
                                        joined, F.lit(")")))
                    .otherwise(F.lit("Users who liked this item also rated these highly")))
            .otherwise(F.when(has, F.concat(F.lit("Shares the genres "), joined, F.lit(" with the chosen item")))
                       .otherwise(F.lit("Has a similar genre mix to the chosen item"))))


def recommend_hybrid(meta: DataFrame, ratings: DataFrame, n: int = DEFAULT_TOP_N,
                     min_ratings: int = CF_MIN_RATINGS, digits: int = SCORE_DIGITS) -> DataFrame:
    """For every catalogue item: CF neighbours if the item is CF-eligible, else
    content neighbours over the whole catalogue (R5, R7)."""
    check_limit(n, hi=TOP_N_MAX)
    elig = eligible_items(ratings, min_ratings, materialise=True)
    cf = item_cf_topn(ratings, n, min_ratings, elig).withColumn("algorithm", F.lit("item_based_cf"))
    rest = meta.select("item_id", F.lit(n).alias("n")).join(elig, "item_id", "left_anti")
    items = meta.select("item_id", "genres", F.lit(True).alias("is_candidate"))
    content = content_lists(items, rest).withColumn("algorithm", F.lit("content_based"))
    recs = cf.unionByName(content)
    base = meta.select("item_id", F.col("genres").alias("base_genres"))
    cand = meta.select(F.col("item_id").alias("similar_item_id"), F.col("title").alias("similar_title"),
                       F.col("release_year"), F.col("genres").alias("cand_genres"),
                       "rating_mean", "rating_count")
    shared = common_genres()
    return (recs.join(base, "item_id").join(cand, "similar_item_id")
            .select("item_id", "algorithm", "rank", "similar_item_id", "similar_title", "release_year",
                    F.col("cand_genres").alias("genres"), F.round("score", digits).alias("similarity_score"),
                    F.round("rating_mean", 2).alias("average_rating"), "rating_count",
                    shared.alias("common_genres"),
                    recommendation_reason(F.col("algorithm"), shared).alias("recommendation_reason")))


def search_catalogue(meta: DataFrame, query: str | None, limit: int = CATALOGUE_LIMIT_DEFAULT) -> DataFrame:
    """Literal lower-case substring search sorted by rating count, or the most
    popular items when there is no query (R6, X17, K3)."""
    check_limit(limit)
    q = (query or "").strip().lower()
    if q:
        hits = meta.where(F.col("search_title").contains(F.lit(q)))
        return top_k(hits, limit, [F.col("rating_count").desc(), F.col("item_id")])
    return top_k(meta, limit, [F.col("popularity_score").desc(), F.col("item_id")])


# --------------------------------------------------------------------------
# Per-user selections
# --------------------------------------------------------------------------

def _chunked_ranks(df: DataFrame, key: str, upto, keep: list[str]) -> DataFrame:
    """(key, keep..., rank) for rank = 1..upto, expanded ``RANK_CHUNK`` ranks at a time so no row holds a long array."""
    chunks = df.select(key, *keep, upto.cast("long").alias("_upto")).where("_upto > 0").withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_upto") - 1) / RANK_CHUNK))))
    first = F.col("_c") * RANK_CHUNK + 1
    return chunks.select(key, *keep, F.explode(F.sequence(first, F.least(F.col("_upto"), first + RANK_CHUNK - 1))).alias("rank"))


def temporal_split(ratings: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Train = rated before ``cutoff``, test = on or after (the evaluation split)."""
    # a wall-clock cutoff: compared without any session time zone when the
    # column is a local timestamp (TIMESTAMP_NTZ), as the test data's is
    lit = F.to_timestamp_ntz(F.lit(cutoff))
    col = F.col("rated_at")
    ts = col < (lit if isinstance(ratings.schema["rated_at"].dataType, T.TimestampNTZType) else lit.cast("timestamp"))
    return ratings.where(ts), ratings.where(~ts)


def seed_per_user(ratings: DataFrame, liked: int = LIKED_RATING) -> DataFrame:
    """Each user's best liked item: rating desc, then latest, then smallest id.

    ``max_by`` is a partial aggregate, so a very active user is reduced map-side.
    """
    liked_r = ratings.where(F.col("rating") >= liked)
    key = F.struct(F.col("rating"), F.col("rated_at"), -F.col("item_id"))
    return liked_r.groupBy("user_id").agg(F.max_by(F.struct("item_id", "rating"), key).alias("_s")).select(
        "user_id", F.col("_s.item_id").alias("seed_item_id"), F.col("_s.rating").alias("seed_rating"))


def popular_unseen(scored: DataFrame, ratings: DataFrame, users: DataFrame, k: int = DEFAULT_TOP_N, parts: int = 0) -> DataFrame:
    """For every user, the k most popular items the user has not rated.

    The answer lies within the first k + seen(u) items of the popularity list, so each
    user expands only that many ranks (linear in the ratings).  All users need the head of
    the list: its ``RANK_CHUNK`` rows are broadcast.  The few ranks beyond it are joined.
    ``parts``: as in ``clean_ratings``; seen items and candidates then meet in that many partitions.
    """
    seen = dealt(ratings.select("user_id", "item_id"), parts, "user_id", "item_id").distinct()
    deg = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    u = users.select("user_id").distinct().join(deg, "user_id", "left").fillna(0, ["n_seen"])
    pop = cut_lineage(global_rank(scored.select("item_id", "popularity_score"), [F.col("popularity_score").desc(), F.col("item_id")]))
    ranks = _chunked_ranks(u, "user_id", F.col("n_seen") + k, [])
    head = ranks.where(F.col("rank") <= RANK_CHUNK).join(F.broadcast(pop.where(F.col("rank") <= RANK_CHUNK)), "rank")
    tail = ranks.where(F.col("rank") > RANK_CHUNK).join(pop.where(F.col("rank") > RANK_CHUNK), "rank")
    cands = dealt(head.unionByName(tail), parts, "user_id", "item_id")
    return first_k_unexcluded(cands, seen, k).select("user_id", "rank", "item_id", "popularity_score")


def first_k_unexcluded(cands: DataFrame, excluded: DataFrame, k: int) -> DataFrame:
    """Per user, the first ``k`` candidates by ``rank`` whose item is not excluded, ranked anew.

    ``cands``: (user_id, rank, item_id, ...).  The limit on the window's rank is applied in
    every task before the shuffle, so a user with a huge history sends k rows from each.
    """
    left = cands.join(excluded.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("rank"))
    return left.withColumn("_nth", nth).where(F.col("_nth") <= k).drop("rank").withColumnRenamed("_nth", "rank")


def lookup_titles(meta: DataFrame, requests: DataFrame, col: str = "request") -> DataFrame:
    """Case-insensitive title lookup; unmatched requests get a message."""
    m = meta.select("item_id", F.lower("clean_title").alias("_key"))
    r = requests.select(col, F.lower(F.col(col)).alias("_key"))
    j = r.join(m, "_key", "left")
    return j.select(col, "item_id", F.when(F.col("item_id").isNull(), F.lit("no item with this title"))
                    .otherwise(F.lit("found")).alias("status"))


def recommend_status(meta: DataFrame, recs: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query item: unknown (not in catalogue), no_result, or ok."""
    known = meta.select("item_id", F.lit(True).alias("_known"))
    has = recs.select("item_id").distinct().withColumn("_has", F.lit(True))
    q = queries.select("item_id").distinct()
    return (q.join(known, "item_id", "left").join(has, "item_id", "left")
            .select("item_id", F.when(F.col("_known").isNull(), "unknown")
                    .when(F.col("_has").isNull(), "no_result").otherwise("ok").alias("status")))


def star_join_check(facts: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Left-join facts to both dimensions and check the row count is unchanged and
    the dimension keys are unique (J1)."""
    joined = facts.join(items, "item_id", "left").join(users, "user_id", "left")
    n_f = facts.agg(F.count(F.lit(1)).alias("n_facts"))
    n_j = joined.agg(F.count(F.lit(1)).alias("n_joined"))
    ui = items.agg((F.count(F.lit(1)) == F.count_distinct("item_id")).alias("_ui"))
    uu = users.agg((F.count(F.lit(1)) == F.count_distinct("user_id")).alias("_uu"))
    return (n_f.crossJoin(n_j).crossJoin(ui).crossJoin(uu)
            .select("n_facts", "n_joined", (F.col("_ui") & F.col("_uu")).alias("dim_keys_unique"),
                    (F.col("n_facts") == F.col("n_joined")).alias("row_count_unchanged")))


def run_metadata(meta: DataFrame, ratings: DataFrame, min_ratings: int = CF_MIN_RATINGS) -> DataFrame:
    """Counts and popularity parameters of a build, one row."""
    meta = cut_lineage(meta)  # catalogue-sized; read by three aggregates
    mc = popularity_params(meta)
    counts = meta.agg(F.count(F.lit(1)).alias("n_items"),
                      F.count(F.when(F.col("rating_count") >= min_ratings, 1)).alias("n_cf_items"))
    r = ratings.agg(F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_ratings"))
    return r.crossJoin(counts).crossJoin(mc).select(
        "n_users", "n_items", "n_ratings", "n_cf_items", F.round("m", 6).alias("m"), F.round("C", 6).alias("C"))


# --------------------------------------------------------------------------
# Offline evaluation
# --------------------------------------------------------------------------

def _per_user_topk(users: DataFrame, lists: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """Each user's seed list minus the user's seen items, first k by list rank.

    A user takes only as much of the list as their own history can exclude.
    """
    cands = (users.select("user_id", F.col("seed_item_id").alias("item_id"), "n_seen").join(lists, "item_id")
             .where(F.col("rank") <= F.col("n_seen") + k)
             .select("user_id", "rank", F.col("similar_item_id").alias("item_id")))
    return first_k_unexcluded(cands, seen, k).select("user_id", "item_id")


def eval_topk(items: DataFrame, ratings: DataFrame, k: int = DEFAULT_TOP_N, liked: int = LIKED_RATING,
              min_ratings: int = CF_MIN_RATINGS, *, cutoff: str, parts: int = 0) -> DataFrame:
    """Precision@k and recall@k of popularity, content and item-CF recommenders.

    Train / test is a temporal split.  Each evaluated user (a liked training
    item to seed from and at least one liked test item) gets k items that are
    not in the training ratings: popularity from the training split, or the
    neighbours of the seed.  Every seed's list is long enough to survive the
    removal of its users' seen items, and a user reads only as much of it as needed.
    CF scores only users whose seed is CF-eligible on the training split.
    """
    train, test = temporal_split(ratings, cutoff)
    seeds = seed_per_user(train, liked)
    rel = test.where(F.col("rating") >= liked).select("user_id", "item_id").distinct()
    n_rel = rel.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rel"))
    seen = train.select("user_id", "item_id").distinct()
    n_seen = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    users = cut_lineage(seeds.join(n_rel, "user_id").join(n_seen, "user_id"))  # read by every branch

    meta = item_metadata(items, train)
    pop = popular_unseen(bayes_popularity(meta), train, users, k, parts).select("user_id", "item_id")

    need = users.groupBy(F.col("seed_item_id").alias("item_id")).agg((F.max("n_seen") + k).alias("n"))
    everything = meta.select("item_id", "genres", F.lit(True).alias("is_candidate"))
    content = _per_user_topk(users, content_lists(everything, need), seen, k)

    elig = eligible_items(train, min_ratings, materialise=True)
    cf_users = users.join(elig.select(F.col("item_id").alias("seed_item_id")), "seed_item_id", "left_semi")
    cf_need = need.join(elig, "item_id", "left_semi")
    cf = _per_user_topk(cf_users, cf_lists(elig, cf_candidates(train, cf_need, elig), cf_need), seen, k)

    recs = (pop.withColumn("algorithm", F.lit("popularity"))
            .unionByName(content.withColumn("algorithm", F.lit("content_based")))
            .unionByName(cf.withColumn("algorithm", F.lit("item_based_cf"))))
    hits = recs.join(rel, ["user_id", "item_id"]).groupBy("algorithm", "user_id").agg(F.count(F.lit(1)).alias("hits"))
    evaluated = (users.select("user_id", "n_rel").withColumn("algorithm", F.lit("popularity"))
                 .unionByName(users.select("user_id", "n_rel").withColumn("algorithm", F.lit("content_based")))
                 .unionByName(cf_users.select("user_id", "n_rel").withColumn("algorithm", F.lit("item_based_cf"))))
    j = evaluated.join(hits, ["algorithm", "user_id"], "left").fillna(0, ["hits"])
    return j.groupBy("algorithm").agg(F.count(F.lit(1)).alias("evaluated_users"),
                                      F.avg(F.col("hits") / k).alias("precision_at_k"),
                                      F.avg(F.col("hits") / F.col("n_rel")).alias("recall_at_k"))
