import random

import numpy as np
import pytest

from basketry.operators import blend, content, dense, online, ranking

SIM = "product1 int, product2 int, score double"
RATED = "userId int, productId int, score double"


def test_scoring_rule(spark):
    sim = spark.createDataFrame(
        [
            (100, 1, 0.9), (100, 2, 0.7), (100, 3, 0.5), (100, 4, 0.8),
            (200, 1, 0.65), (200, 2, 0.3), (300, 1, 0.61), (400, 1, 0.45),
        ],
        SIM,
    )
    recents = spark.createDataFrame([(9, 1, 5.0), (9, 2, 2.0), (9, 3, 4.0), (9, 4, 5.0)], RATED)
    found = spark.createDataFrame([(9, c) for c in (100, 200, 300, 400)], "userId int, candidate int")
    scores = online.score_candidates(found, recents, sim).collect()
    assert {r["productId"]: pytest.approx(r["score"]) for r in scores} == {
        100: 4.3,
        200: 3.25,
        300: 3.05,
    }


def test_candidates_skip_rated_products(spark, rows):
    sim = spark.createDataFrame([(1, p, 1 - p / 100) for p in range(2, 40)], SIM)
    triggers = spark.createDataFrame([(9, 1), (8, 1), (7, 555)], "userId int, productId int")
    rated = spark.createDataFrame(
        [(9, 2), (9, 2), (9, 3), (9, 39), (8, 1), (6, 4)], "userId int, productId int"
    )
    found = rows(online.candidates(triggers, rated, sim, 20), "userId", "rank", "candidate")
    assert [c for u, _, c in found if u == 9] == list(range(4, 24))
    assert [c for u, _, c in found if u == 8] == list(range(2, 22))
    assert not [c for u, _, c in found if u == 7]


def test_a_user_who_rated_most_of_a_list_still_gets_the_rest(spark, rows):
    sim = spark.createDataFrame([(1, p, 1 - p / 1000) for p in range(2, 200)], SIM)
    triggers = spark.createDataFrame([(9, 1)], "userId int, productId int")
    rated = spark.createDataFrame([(9, p) for p in range(2, 190)], "userId int, productId int")
    found = rows(online.candidates(triggers, rated, sim, 5), "candidate")
    assert found == [(p,) for p in range(190, 195)]


def test_users_without_scores_get_an_empty_list(spark):
    sim = spark.createDataFrame([(1, 2, 0.5)], SIM)
    triggers = spark.createDataFrame([(9, 1)], "userId int, productId int")
    recents = spark.createDataFrame([(9, 1, 5.0)], RATED)
    recs = online.recommend(triggers, recents, triggers, sim).collect()
    assert [(r["userId"], r["recs"]) for r in recs] == [(9, [])]


def test_replace_keeps_other_users(spark, rows):
    schema = "userId int, recs array<struct<productId:int,score:double>>"
    old = spark.createDataFrame([(1, [(5, 1.0)]), (2, [(6, 1.0)])], schema)
    new = spark.createDataFrame([(2, [])], schema)
    found = {r["userId"]: len(r["recs"]) for r in online.replace_recs(old, new).collect()}
    assert found == {1: 1, 2: 0}


def test_blend_weights_normalised_scores(spark, rows):
    a = spark.createDataFrame([(1, 5, 10.0), (1, 6, 5.0)], RATED)
    b = spark.createDataFrame([(1, 6, 0.2), (1, 7, 0.1), (2, 7, 0.0)], RATED)
    found = rows(blend.blend({"a": (a, 0.5), "b": (b, 0.25)}))
    assert [(u, r, p, round(s, 6)) for u, r, p, s in found] == [
        (1, 1, 5, 0.5),
        (1, 2, 6, 0.5),
        (1, 3, 7, 0.125),
        (2, 1, 7, 0.0),
    ]


def test_merge_takes_the_higher_score(spark, rows):
    a = spark.createDataFrame([(1, 5, 1.0), (1, 6, 3.0)], RATED)
    b = spark.createDataFrame([(1, 5, 2.0)], RATED)
    assert rows(blend.merge_stream_recs(a, b)) == [(1, 1, 6, 3.0), (1, 2, 5, 2.0)]


def items(spark, n=60):
    rng = random.Random(11)
    words = [f"t{i}" for i in range(8)]
    vectors = [(i, [rng.gauss(0, 1) + 1.5 for _ in range(5)]) for i in range(n)]
    tags = [(i, [rng.choice(words) for _ in range(rng.randrange(1, 5))]) for i in range(n)]
    return (
        spark.createDataFrame(vectors, "id int, features array<double>"),
        spark.createDataFrame(tags, "productId int, words array<string>"),
    )


@pytest.mark.parametrize("kind", ["factors", "tags"])
def test_a_trigger_of_a_third_of_the_users_gives_what_whole_lists_give(spark, rows, kind):
    vectors, tags = items(spark)
    if kind == "factors":
        sim, whole = online.FactorVectors(vectors), dense.dense_similarity(vectors)
    else:
        sim, whole = online.TagProfiles(tags), content.similar_products(tags)
    rng = random.Random(12)
    triggers = spark.createDataFrame(
        [(u, 7 if u % 3 == 0 else rng.randrange(60)) for u in range(90)], "userId int, productId int"
    )
    rated = spark.createDataFrame(
        [(u, rng.randrange(60)) for u in range(90) for _ in range(u % 5)], "userId int, productId int"
    )
    recents = spark.createDataFrame(
        [(u, rng.randrange(60), float(rng.randrange(1, 6))) for u in range(90) for _ in range(4)], RATED
    )
    got, expected = (online.candidates(triggers, rated, s, 6) for s in (sim, whole))
    columns = ("userId", "rank", "candidate")
    assert rows(got, *columns) == rows(expected, *columns) != []

    def scored(s):
        found = online.score_candidates(expected, recents, s).collect()
        return {(r["userId"], r["productId"]): round(r["score"], 9) for r in found}

    assert scored(sim) == scored(whole) != {}


def test_best_matches_equal_brute_force_in_small_blocks(spark):
    rng = np.random.default_rng(3)
    users, products = rng.normal(size=(30, 4)), rng.normal(size=(50, 4))
    left, right = (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>")
        for m in (users, products)
    )
    found = dense.best_matches(left, right, 7, 0.0, cosine=False, block=8).collect()
    scores = np.round(users @ products.T, 9)
    expected = {
        (u, r + 1): p
        for u in range(30)
        for r, p in enumerate([p for p in np.lexsort((np.arange(50), -scores[u])) if scores[u, p] > 0][:7])
    }
    assert {(r["product1"], r["rank"]): r["product2"] for r in found} == expected


def test_pages_give_back_ranks_of_whole_lists(spark, rows):
    lists = spark.createDataFrame([(1, p, 1 - p / 100) for p in range(25)] + [(2, 5, 0.5)], SIM)
    pages = ranking.pack_pages(lists, "product1", "product2", page_size=10)
    found = ranking.unpack_pages(pages, "product1", 10)
    expected = [(1, p + 1, p) for p in range(25)] + [(2, 1, 5)]
    assert rows(found, "product1", "rank", "productId") == expected


def test_a_user_with_many_ratings_deepens_their_list_only(spark):
    """Lists are asked for by the depth that their own trigger needs."""
    asked = []

    class Lists(online.StoredLists):
        def neighbours(self, products, k):
            asked.append((sorted(r.productId for r in products.collect()), k))
            return super().neighbours(products, k)

    sim = spark.range(2000).selectExpr("cast(1 + id % 2 as int) AS product1", "id + 10 AS product2", "1 / (id + 1.0) AS score")
    triggers = spark.createDataFrame([(1, 1), (2, 2), (3, 9)], "userId int, productId int")
    rated = spark.range(900).selectExpr("1 AS userId", "2 * id + 10 AS productId").unionByName(
        spark.createDataFrame([(2, 11), (2, 13)], "userId int, productId bigint")
    )
    found = online.candidates(triggers, rated, Lists(sim), 5).collect()
    assert dict((tuple(p), k) for p, k in asked) == {(1,): 905, (2, 9): 7}
    by_user = {u: [r.candidate for r in sorted(found, key=lambda r: r.rank) if r.userId == u] for u in (1, 2, 3)}
    assert by_user == {1: [1810, 1812, 1814, 1816, 1818], 2: [15, 17, 19, 21, 23], 3: []}
