import numpy as np

from batchgate.llm import neighbours as n


def test_copies_survive_a_bound_of_nothing():
    for size in (32, 96, 384):
        turn = n.rotation(size)
        block = np.random.default_rng(size).standard_normal((200, size))
        for k in range(0, 200, 10):
            block[k:k + 5] = block[k]
        for k in range(0, 200, 10):
            query = block[k:k + 1]  # alone, as in a list with one query
            alive = n.scan(query[0], (query @ turn)[0], block, block @ turn, np.arange(200), 0.0)
            assert alive.tolist() == list(range(k, k + 5))
