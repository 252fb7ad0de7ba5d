import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import IDF, HashingTF, Tokenizer

from basketry import settings
from basketry.operators import content


def products(spark, tags):
    return spark.createDataFrame(
        [(i, f"p{i}", t) for i, t in tags.items()], "productId int, name string, tags string"
    )


def brute_force(tags, min_sim):
    bags = {i: Counter(t.replace("|", " ").lower().split(" ")) for i, t in tags.items()}
    df = Counter(w for b in bags.values() for w in b)
    vectors = {
        i: {w: n * math.log((len(tags) + 1) / (df[w] + 1)) for w, n in b.items()}
        for i, b in bags.items()
    }
    norms = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vectors.items()}
    found = {}
    for i, v in vectors.items():
        for j, w in vectors.items():
            if i != j and norms[i] > 0 and norms[j] > 0:
                score = sum(x * w.get(t, 0.0) for t, x in v.items()) / (norms[i] * norms[j])
                if round(score, 9) > min_sim:
                    found[i, j] = round(score, 6)
    return found


def as_dict(df):
    return {(r["product1"], r["product2"]): round(r["score"], 6) for r in df.collect()}


def test_hand_computed(spark):
    words = content.tokens(products(spark, {1: "a|b", 2: "a|b|c", 3: "d"}))
    assert as_dict(content.similar_products(words)) == {(1, 2): 0.506197, (2, 1): 0.506197}


def test_a_tag_of_every_product_weighs_nothing(spark):
    tags = {1: "all|x", 2: "all|x", 3: "all|y", 4: "all"}
    assert as_dict(content.similar_products(content.tokens(products(spark, tags)))) == {
        (1, 2): 1.0,
        (2, 1): 1.0,
    }
    weights = content.tfidf_weights(content.tokens(products(spark, tags)))
    assert "all" not in {r["term"] for r in weights.collect()}


@pytest.fixture(scope="module")
def skewed():
    """A third of the products are copies, and one tag is on half of the rest."""
    rng = random.Random(5)
    tags = {i: "Copy|of one|Thing" for i in range(60)}
    for i in range(60, 180):
        words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.5:
            words.append("hot")
        tags[i] = "|".join(words)
    return tags


@pytest.mark.parametrize("min_sim", [0.1, 0.4, 0.8])
@pytest.mark.parametrize("block", [8, 1024])
def test_prefix_filter_finds_every_pair(spark, skewed, min_sim, block):
    profiles = content.Profiles(content.tokens(products(spark, skewed)))
    pairs = content.profile_similarity(profiles.weights, min_sim, block)
    rows = pairs.collect()
    assert len({(r["profile1"], r["profile2"]) for r in rows}) == len(rows)
    assert as_dict(content.expand(profiles, pairs)) == brute_force(skewed, min_sim)


def test_lists_of_requested_products_only(spark, skewed):
    words = content.tokens(products(spark, skewed))
    wanted = spark.createDataFrame([(0,), (100,), (9999,)], "productId int")
    expected = {k: v for k, v in brute_force(skewed, 0.4).items() if k[0] in (0, 100)}
    assert as_dict(content.similar_products(words, requests=wanted)) == expected


@pytest.mark.parametrize("k", [1, 3, 20])
def test_top_lists(spark, rows, skewed, k):
    lists = defaultdict(list)
    for (i, j), score in brute_force(skewed, 0.4).items():
        lists[i].append((-score, j))
    expected = sorted(
        (i, n + 1, j, -s) for i, entries in lists.items() for n, (s, j) in enumerate(sorted(entries)[:k])
    )
    top = content.top_similar(content.tokens(products(spark, skewed)), k)
    assert [(a, b, c, round(d, 6)) for a, b, c, d in rows(top)] == expected


def test_hashed_mode_equals_brute_force_on_ml_vectors(spark, skewed):
    items = products(spark, skewed)
    text = content.scalars.normalise_tags("tags").alias("text")
    words = Tokenizer(inputCol="text", outputCol="words").transform(items.select("productId", text))
    counts = HashingTF(inputCol="words", outputCol="tf", numFeatures=20).transform(words)
    vectors = IDF(inputCol="tf", outputCol="v").fit(counts).transform(counts)
    dense = {r["productId"]: r["v"].toArray() for r in vectors.collect()}
    expected = {}
    for i, v in dense.items():
        for j, w in dense.items():
            norm = math.sqrt((v @ v) * (w @ w))
            if i != j and norm > 0 and round(v @ w / norm, 9) > 0.4:
                expected[i, j] = round(float(v @ w / norm), 6)
    found = as_dict(content.similar_products(content.hashed_tokens(items, 20)))
    assert found.keys() == expected.keys()
    assert all(abs(found[key] - expected[key]) <= 1.1e-6 for key in found)


def test_vocabulary_slices(spark, skewed, monkeypatch):
    monkeypatch.setattr(content, "_VOCABULARY_CHUNK", 4)
    words = content.tokens(products(spark, skewed))
    assert as_dict(content.similar_products(words)) == brute_force(skewed, 0.4)


@pytest.mark.parametrize("page_size", [1, 4, 7, 1000])
def test_pages_are_those_of_all_pairs_ranked_once_a_profile(spark, skewed, monkeypatch, page_size):
    """Also ids of two rows, with equal and with other tags, and null ids."""
    rows = [(i, "p", t) for i, t in skewed.items()]
    rows += [(3, "p", skewed[3]), (100, "p", skewed[100]), (101, "p", skewed[0]), (None, "p", skewed[0]), (999, "p", "alone")]
    words = content.tokens(spark.createDataFrame(rows, "productId int, name string, tags string"))
    whole = content.ranking.pack_pages(content.similar_products(words), "product1", item="product2", page_size=page_size)
    ranked = []
    list_rank = content.ranking.list_rank

    def counted(df, *args, **kwargs):
        ranked.append(df.count())
        return list_rank(df, *args, **kwargs)

    monkeypatch.setattr(content.ranking, "list_rank", counted)
    paged = content.similar_pages(words, page_size)

    def lists(pages):
        return {(r.product1, r.page): [(e.productId, round(e.score, 9)) for e in r.recs] for r in pages.collect()}

    assert lists(paged) == lists(whole)
    assert ranked[0] < 0.5 * content.similar_products(words).count()


def test_members_of_a_profile_travel_in_chunks(spark, monkeypatch):
    """Whole lists of many copies, ids that are null or repeat, rounded scores; few ids to a row."""
    monkeypatch.setattr(settings, "MEMBERS", 3)
    bags = [["red", "ring"], ["red", "ring", "gold"], ["blue"], ["blue", "hat"]]
    given = [(i, bags[i * i % 4 if i < 20 else 3]) for i in range(30)] + [(None, bags[0]), (4, bags[0]), (5, bags[3])]
    words = spark.createDataFrame(given, "productId bigint, words array<string>")
    profiles = content.Profiles(words)
    score = {(r.profile1, r.profile2): r.score for r in content.profile_similarity(profiles.weights).collect()}
    score |= {(b, a): x for (a, b), x in score.items()} | {(m.profileId, m.profileId): 1.0 for m in profiles.members.collect()}
    members = [(m.productId, m.profileId) for m in profiles.members.collect() if m.productId is not None]
    expected = sorted(
        (a, b, round(score[p, q], 6)) for a, p in members for b, q in members if a != b and (p, q) in score
    )
    found = content.similar_products(words, decimals=6)
    assert sorted(tuple(r) for r in found.select("product1", "product2", "score").collect()) == expected
    assert max(len(r.products1) for r in content._chunks(profiles.members, "1").collect()) < len(members) / 3
    asked = spark.createDataFrame([(4,), (25,)], "productId bigint")
    some = content.similar_products(words, requests=asked, decimals=6).select("product1", "product2", "score")
    assert sorted(tuple(r) for r in some.collect()) == [x for x in expected if x[0] in (4, 25)]
