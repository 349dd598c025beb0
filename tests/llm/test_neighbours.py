import numpy as np

from batchgate.llm import neighbours as n


def exact(ids, rows, query, k=10):
    at = int(np.flatnonzero(ids == query)[0])
    score = np.sqrt(((rows - rows[at]) ** 2).sum(1))
    score[at] = np.inf
    best = np.lexsort((ids, score))[:min(k, len(ids) - 1)]
    return [(int(ids[i]), float(score[i])) for i in best]


def test_recall_and_scores(spark):
    r = np.random.default_rng(3)
    rows = (r.standard_normal((40, 24))[r.integers(0, 40, 6000)]
            + 0.7 * r.standard_normal((6000, 24))).astype(np.float32)
    ids = np.arange(6000)
    frame = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, rows)],
                                  "vec_id long, vector array<float>").repartition(6)
    found = n.search(frame, frame.where("vec_id % 100 = 0"), 10, list_rows=200).collect()
    by, hit = {}, 0
    for row in sorted(found, key=lambda x: (x.query_id, x.rank)):
        by.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert len(by) == 60 and all(len(v) == 10 for v in by.values())
    for query, got in by.items():
        want = exact(ids, rows.astype(float), query)
        hit += len({v for v, _ in want} & {v for v, _ in got})
        for vec, score in got:
            assert abs(score - np.linalg.norm(
                rows[vec].astype(float) - rows[query].astype(float))) < 1e-12
        assert got == sorted(got, key=lambda x: (x[1], x[0]))
    assert hit >= 0.9 * 600


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]),
            (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (200, [inf, 1.0]), (7, []),
            (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [0.0, 2.0]), (9, [0.0, 2.0]),
            (10, [0.5, 0.5]), (10, [0.0, 0.5])]
    frame = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<float>, vector string")
    got = n.op10_nearest_neighbours(frame, 3).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 6)))
    assert by == {0: [(1, 1, 0.0), (2, 2, 0.0), (3, 10, round(1.25 ** 0.5, 6))],
                  100: [(1, 10, 0.5), (2, 9, 1.0), (3, 0, round(2 ** 0.5, 6))]}


def test_few_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])],
                                  "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in n.op10_nearest_neighbours(frame).collect()
            ] == [(0, 1, 1)]
    assert n.op10_nearest_neighbours(frame.limit(0)).count() == 0
    assert n.op10_nearest_neighbours(frame.limit(1)).count() == 0


def test_abandoning_keeps_what_is_near():
    r = np.random.default_rng(1)
    turn = n.rotation(64)
    rows, query = r.standard_normal((500, 64)), r.standard_normal(64)
    rows[50:] *= 4
    far = n.distances(rows, query)
    bound = np.sort(far)[9]
    alive = n.scan(query, query @ turn, rows, rows @ turn, np.arange(500), bound)
    assert set(np.argsort(far)[:10]) <= set(alive.tolist()) and len(alive) < 100
