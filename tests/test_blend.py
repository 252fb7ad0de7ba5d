import random

import pytest

from basketry.operators import blend, ranking

SCHEMA = "{} int, productId int, score double"


@pytest.mark.parametrize("k", [1, 4, 30])
def test_lists_of_triggers_are_summed_once_and_cut(spark, monkeypatch, k):
    """As blending each user's copy of the lists; users without a trigger, a null user, unknown triggers."""
    rng = random.Random(2)
    triggers = [(u, u % 3) for u in range(30)] + [(31, 9), (32, None), (None, 1)]
    lists = {
        name: [(t, p, round(rng.uniform(-1, 1), 1)) for t in range(4) for p in rng.sample(range(60), n)]
        for name, n in (("offline", 10), ("content", 50))
    }
    lists["content"] += lists["content"][:3]
    own = [(u, p, rng.uniform(-1, 1)) for u in [*range(5, 35), 40] for p in rng.sample(range(60), 6)]
    asked = spark.createDataFrame(triggers, "userId int, trigger int")
    shared = {name: spark.createDataFrame(rows, SCHEMA.format("trigger")) for name, rows in lists.items()}
    stream = spark.createDataFrame(own, SCHEMA.format("userId"))
    weights = {"offline": 0.5, "content": 0.2}
    whole = {n: (asked.join(df, "trigger").select("userId", "productId", "score"), weights[n]) for n, df in shared.items()}
    expected = blend.blend({**whole, "stream": (stream, 0.3)}, k)
    cut = []
    rank_recs = ranking.rank_recs

    def counted(df, key, n, *args, **kwargs):
        cut.append((key, df.count(), n))
        return rank_recs(df, key, n, *args, **kwargs)

    monkeypatch.setattr(ranking, "rank_recs", counted)
    found = blend.blend_by_trigger(asked, {n: (df, weights[n]) for n, df in shared.items()}, {"stream": (stream, 0.3)}, k)

    def lists_of(df):
        return sorted((r.userId, r["rank"], r.productId, round(r.score, 9)) for r in df.collect())

    assert lists_of(found) == lists_of(expected) != []
    assert cut[0][0] == "trigger" and cut[0][1] <= 4 * 60 and cut[0][2] == k + 6
