"""Song recommendations by implicit-feedback matrix factorization."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window, functions as F

from harkline.functions.draws import SEED, draw_bits
from harkline.operators.features import apply_index, frequency_index
from harkline.operators.frozen import freeze
from harkline.operators.joins import lookup_join
from harkline.operators.products import top_products
from harkline.session import scratch_dir

# Ratings that one block holds, on average.
BLOCK_RATINGS = 5_000_000


@dataclass(frozen=True)
class Recommender:
    """A factorization with the id indexes it was trained on."""

    model: ALSModel
    users: DataFrame
    songs: DataFrame
    regularization: float

    def index(self, triplets: DataFrame) -> DataFrame:
        """Adds ``user_int`` and ``song_int`` as training knows them; rows with unknown ids are dropped."""
        return apply_index(apply_index(triplets, self.users, "user_id"), self.songs, "song_id")

    def factors(self) -> DataFrame:
        """``(kind, name, features)`` of every user and song."""
        users = self.model.userFactors.join(self.users, F.col("id") == F.col("user_int"))
        songs = self.model.itemFactors.join(self.songs, F.col("id") == F.col("song_int"))
        return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("name"), "features").unionByName(
            songs.select(F.lit("song").alias("kind"), F.col("song_id").alias("name"), "features")
        )

    def recommend(self, k: int = 5, users: DataFrame | None = None) -> DataFrame:
        """``(user_id, position, song_id, rating)``: the ``k`` best songs of every user, or of those of ``users`` (``user_id``).

        Songs of equal rating are in order of their index.
        """
        wanted = self.users if users is None else lookup_join(self.users, users.select("user_id").distinct(), "user_id", "left_semi", stored=True, facts_stored=True)
        return self._named(self._best(wanted.select("user_int", F.lit(k).alias("want"))))

    def recommend_unplayed(self, played: DataFrame, k: int = 5) -> DataFrame:
        """As ``recommend``, without the songs that a user has in ``played``.

        A user with n such songs needs the k + n best to be left with k, and so many are sought for that user. Songs found and
        songs played meet by index; only the k left get their names.
        """
        pairs = freeze(self.index(played.select("user_id", "song_id")).select("user_int", "song_int").distinct())
        counts = pairs.groupBy("user_int").agg(F.count(F.lit(1)).alias("n"))
        wanted = self.users.join(counts, "user_int", "left").select("user_int", (F.coalesce("n", F.lit(0)) + k).alias("want"))
        fresh = self._best(wanted).join(pairs, ["user_int", "song_int"], "left_anti")
        place = F.row_number().over(Window.partitionBy("user_int").orderBy("position"))
        return self._named(fresh.withColumn("position", place).filter(F.col("position") <= k))

    def recommended_items(self, k: int = 5) -> DataFrame:
        """``(user_id, position, song_id)``: the list of each user without the ratings."""
        return self.recommend(k).select("user_id", "position", "song_id")

    def residuals(self, train: DataFrame) -> DataFrame:
        """``(user_id, n_songs, residual)``: how far each user's factors are from solving their normal equations, given the songs'.

        The last step of the fit solves for the users. With song factors y, c = |plays|, n songs of c > 0 and the regularization r, a user's
        x solves (sum of all y y' + sum of c y y' + r n) x = sum of (1 + c) y, sums with c over the user's songs. The residual
        is the length of the difference by the length of the right side. The sum over all songs is a matrix of rank by rank; users' sums are added up
        in each task before rows move.
        """
        r = float(self.regularization)
        songs = self.model.itemFactors.select(F.col("id").alias("song_int"), F.transform("features", lambda v: v.cast("double")).alias("y"))
        users = self.model.userFactors.select(F.col("id").alias("user_int"), F.transform("features", lambda v: v.cast("double")).alias("x"))
        squares = songs.select("y", F.posexplode("y").alias("i", "yi")).select("i", "yi", F.posexplode("y").alias("j", "yj"))
        gram = squares.groupBy("i", "j").agg(F.sum(F.col("yi") * F.col("yj")).alias("g"))
        rated = self.index(train).select("user_int", "song_int", F.abs(F.col("play_count").cast("double")).alias("c")).filter("c > 0")
        rows = lookup_join(lookup_join(rated, freeze(songs), "song_int", "inner", stored=True), freeze(users), "user_int", "inner", stored=True)
        dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        rows = rows.select("user_int", "c", dot.alias("s"), F.posexplode("y").alias("i", "yi"))
        sums = rows.groupBy("user_int", "i").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("c") * F.col("s") * F.col("yi")).alias("own"), F.sum((1 + F.col("c")) * F.col("yi")).alias("asked")
        )
        entries = users.select("user_int", F.posexplode("x").alias("i", "xi"))
        common = entries.withColumnRenamed("i", "j").join(F.broadcast(gram), "j").groupBy("user_int", "i").agg(F.sum(F.col("g") * F.col("xi")).alias("common"))
        parts = sums.join(entries, ["user_int", "i"]).join(common, ["user_int", "i"])
        off = F.col("common") + F.col("own") + r * F.col("n") * F.col("xi") - F.col("asked")
        told = parts.groupBy("user_int").agg(F.max("n").alias("n_songs"), (F.sqrt(F.sum(off * off)) / F.sqrt(F.sum(F.col("asked") * F.col("asked")))).alias("residual"))
        return lookup_join(told, self.users.select("user_int", "user_id"), "user_int", "inner", stored=True).select("user_id", "n_songs", "residual")

    def _best(self, wanted: DataFrame) -> DataFrame:
        """``(user_int, position, song_int, rating)``: the best songs of users, as many for each as ``wanted`` (``user_int``, ``want``) says."""
        users = self.model.userFactors.join(wanted, F.col("id") == F.col("user_int")).select("id", "features", "want")
        found = top_products(users, self.model.itemFactors, F.col("want"))
        return found.select(
            F.col("id").alias("user_int"), (F.col("at") + 1).alias("position"), F.col("item").alias("song_int"), F.col("product").alias("rating")
        )

    def score(self, triplets: DataFrame) -> DataFrame:
        """Adds ``prediction`` to the rows whose user and song are known."""
        return self.model.transform(self.index(triplets)).drop("user_int", "song_int")

    def sampled_user_scores(self, test: DataFrame, users: int = 10, seed: int = SEED) -> DataFrame:
        """Predicted scores of the test songs of some users drawn from those who have any."""
        tested = freeze(test.select("user_id").distinct())
        known = lookup_join(tested, self.users.select("user_id"), "user_id", "left_semi", stored=True, facts_stored=True)
        drawn = known.orderBy(draw_bits(["user_id"], "sample", seed), "user_id").limit(users)
        return self.score(lookup_join(test, drawn, "user_id", "left_semi"))

    def _named(self, rows: DataFrame) -> DataFrame:
        """``(user_id, position, song_id, rating)``: ids for indexes. The rows cost a search, so they are written down once."""
        songs = self.songs.select("song_int", "song_id")
        users = self.users.select("user_int", "user_id")
        named = lookup_join(freeze(rows), songs, "song_int", "inner", stored=True, facts_stored=True)
        return lookup_join(named, users, "user_int", "inner", stored=True).select("user_id", "position", "song_id", "rating")


def fit_recommender(
    train: DataFrame, rank: int = 10, iterations: int = 5, regularization: float = 0.01, seed: int = SEED
) -> Recommender:
    """Indexes users and songs of ``train`` and factorizes their play counts.

    ``train`` is read three times, so freeze it first if it is costly to compute. One block holds all ratings of a
    user or song, so the rows of the most played song must fit into one task; blocks grow in number with the ratings.
    """
    spark = train.sparkSession
    users = freeze(frequency_index(train, "user_id", "user_int"))
    songs = freeze(frequency_index(train, "song_id", "song_int"))
    indexed = apply_index(apply_index(train, users, "user_id"), songs, "song_id")
    scratch_dir(spark)  # names the folder in which the factorization cuts its lineage
    ratings = users.agg(F.sum("n_rows")).head()[0] or 0
    blocks = max(10, spark.sparkContext.defaultParallelism, -(-ratings // BLOCK_RATINGS))
    als = ALS(
        userCol="user_int",
        itemCol="song_int",
        ratingCol="play_count",
        implicitPrefs=True,
        rank=rank,
        maxIter=iterations,
        regParam=regularization,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=2,
    )
    return Recommender(als.fit(indexed.select("user_int", "song_int", "play_count")), users, songs, regularization)
