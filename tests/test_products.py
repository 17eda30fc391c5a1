"""Largest products and recommendations against plain ones, and how much work they take."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from harkline.operators import products
from harkline.operators.products import Items, best_products, top_products
from harkline.operators.recommend import fit_recommender
from harkline.operators.frozen import freeze
from harkline.operators import sampling
from harkline.plans import tables as t


def plain(rows, want, ids, vectors):
    scores = (rows.astype(float) @ vectors.astype(float).T).astype(np.float32)
    return [[(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s))[:w]] for s, w in zip(scores, want)]


def vectors_of(rng, n, width=6, decay=1.0):
    return (rng.normal(size=(n, width)) * np.exp(decay * rng.normal(size=(n, 1)))).astype(np.float32)


def frame(spark, ids, vectors, want=None):
    rows = [(int(i), v.tolist(), int(w)) for i, v, w in zip(ids, vectors, [0] * len(ids) if want is None else want)]
    return spark.createDataFrame(rows, "id int, features array<float>, want int")


@pytest.mark.parametrize("chunk_bytes", [64_000_000, 28 * 70])
def test_top_products_equal_plain_ones(spark, chunk_bytes):
    rng = np.random.default_rng(4)
    rows, items, ids = vectors_of(rng, 150), vectors_of(rng, 300), rng.permutation(5000)[:300]
    items[50:60] = items[49]  # ties, in order of id
    want = rng.integers(0, 12, 150)
    want[3], want[4] = 400, 300
    found = {}
    for r in top_products(frame(spark, range(150), rows, want), frame(spark, ids, items), F.col("want"), chunk_bytes).collect():
        found.setdefault(r["id"], []).append((r["at"], r["item"], r["product"]))
    for i, expected in enumerate(plain(rows, want, ids, items)):
        got = sorted(found.get(i, []))
        assert [g[0] for g in got] == list(range(len(expected)))
        assert [g[1] for g in got] == [e[0] for e in expected]
        assert [g[2] for g in got] == pytest.approx([e[1] for e in expected], rel=1e-6)


def test_pairs_are_far_fewer_than_all():
    rng = np.random.default_rng(6)
    rows, vectors = vectors_of(rng, 400).astype(float), vectors_of(rng, 60_000, decay=0.8)
    items, want = Items(np.arange(60_000), vectors), np.full(400, 5)
    none = [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * 400
    best, pairs = best_products(rows, want, items, none)
    assert [b[0].tolist() for b in best] == [[i for i, _ in p] for p in plain(rows, want, np.arange(60_000), vectors)]
    assert pairs < 400 * 60_000 / 10


def test_a_rows_work_depends_on_its_own_wish():
    rng = np.random.default_rng(8)
    rows, items = vectors_of(rng, 50).astype(float), Items(np.arange(30_000), vectors_of(rng, 30_000))
    none = [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * 50
    few = np.full(50, 5)
    one = few.copy()
    one[7] = 30_000
    less, more = best_products(rows, few, items, none)[1], best_products(rows, one, items, none)[1]
    assert more - less <= 30_000


@pytest.fixture(scope="module")
def plays(spark, sf):
    return sampling.training(freeze(sampling.random_split(t.clean_triplets(spark, sf), ["user_id", "song_id"])))


@pytest.fixture(scope="module")
def recommender(plays):
    return fit_recommender(plays, rank=5, iterations=3)


def test_same_lists_as_the_library(recommender):
    songs = {r["song_int"]: r["song_id"] for r in recommender.songs.collect()}
    users = {r["user_int"]: r["user_id"] for r in recommender.users.collect()}
    theirs = {users[r["user_int"]]: [(songs[x["song_int"]], x["rating"]) for x in r["recommendations"]] for r in recommender.model.recommendForAllUsers(6).collect()}
    ours = {}
    for r in recommender.recommend(6).orderBy("user_id", "position").collect():
        ours.setdefault(r["user_id"], []).append((r["song_id"], r["rating"]))
    assert ours.keys() == theirs.keys()
    for user, listed in ours.items():
        assert [x for _, x in listed] == pytest.approx([x for _, x in theirs[user]], abs=1e-5)
        # Lists agree but for the order of nearly equal ratings.
        last = theirs[user][-1][1]
        sure = {s for s, x in theirs[user] if x > last + 1e-5}
        assert sure <= {s for s, _ in listed}


def test_unplayed_songs_in_order(plays, recommender):
    played = {}
    for r in plays.select("user_id", "song_id").collect():
        played.setdefault(r["user_id"], set()).add(r["song_id"])
    everything = {}
    n = recommender.songs.count()
    for r in recommender.recommend(n).orderBy("user_id", "position").collect():
        everything.setdefault(r["user_id"], []).append(r["song_id"])
    got = {}
    for r in recommender.recommend_unplayed(plays, 4).orderBy("user_id", "position").collect():
        got.setdefault(r["user_id"], []).append((r["position"], r["song_id"]))
    for user, songs in everything.items():
        fresh = [s for s in songs if s not in played[user]][:4]
        assert got.get(user, []) == list(enumerate(fresh, 1))


def test_some_users_only(spark, recommender):
    some = recommender.users.select("user_id").orderBy("user_id").limit(3)
    rows = recommender.recommend(2, some.union(some)).collect()
    assert len(rows) == 6 and {r["user_id"] for r in rows} == {r["user_id"] for r in some.collect()}
    assert recommender.recommend(2, some.limit(0)).count() == 0


def test_no_items(spark):
    none = spark.createDataFrame([], "id int, features array<float>, want int")
    assert top_products(frame(spark, [1], np.ones((1, 2)), [3]), none, F.col("want")).count() == 0
    assert top_products(none, frame(spark, [1], np.ones((1, 2))), F.col("want")).count() == 0
    assert products.CHUNK_BYTES <= 64_000_000


def test_items_take_little_more_than_their_bytes():
    """Vectors stay as they came, in order of their norms; a widened copy of all would be twice their bytes."""
    import tracemalloc

    vectors = np.random.default_rng(3).normal(size=(200_000, 10)).astype(np.float32)
    items = Items(np.arange(200_000, dtype=np.int32), vectors)
    assert items.vectors.dtype == np.float32 and (np.diff(items.norms) <= 0).all()
    tracemalloc.start()
    best_products(vectors[:8].astype(float), np.full(8, 5), items, [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * 8)
    Items(items.ids, items.vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * vectors.nbytes
