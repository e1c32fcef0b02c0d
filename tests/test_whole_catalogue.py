"""Lists are held against every product of the catalogue."""

import numpy as np
from reviewmill.operators import factors
from reviewmill.plans import check_queries

SF_DIR = "/root/testdata/sf0.001"


def model_of(spark, users, items):
    def side(rows, name, index):
        table = [(f"{name}{n:03d}", n, [float(v) for v in row]) for n, row in enumerate(rows)]
        return spark.createDataFrame(table, f"{'reviewerID' if name == 'U' else 'asin'} string, {index} long, vec array<double>")

    return factors.Factors(side(users, "U", "user"), side(items, "I", "item"), users.shape[1])


def test_beaten_products_are_counted_as_by_all_pairs(spark):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(30, 4)), rng.normal(size=(170, 4))
    users[3] = items[5] = 0.0
    model = model_of(spark, users, items)
    assert factors.count_beaten(model, factors.recommend_all(model, 6)).first().beaten == 0
    some = factors.recommend_all(model_of(spark, users, items[:100]), 6)
    scores, want = users @ items.T, 0
    lists = {}
    for r in some.collect():
        lists.setdefault(int(r.reviewerID[1:]), []).append((int(r.asin[1:]), r.score))
    for user, listed in lists.items():
        floor = min(s for _, s in listed) + 1e-4
        want += sum(s > floor and n not in dict(listed) for n, s in enumerate(scores[user]))
    assert want > 30
    for user_block, item_block in ((1 << 17, 1 << 18), (7, 40)):
        got = factors.count_beaten(model, some, user_block=user_block, item_block=item_block).first().beaten
        assert got == want


def test_query_sees_a_list_that_lacks_a_later_product(spark, monkeypatch):
    whole = factors.recommend_for

    def cut(model, users, k):
        return whole(factors.Factors(model.users, model.items.filter("item < 100"), model.rank), users, k)

    monkeypatch.setattr(factors, "recommend_for", cut)
    assert check_queries.als_users_checks(spark, SF_DIR).first().best_of_all is False
