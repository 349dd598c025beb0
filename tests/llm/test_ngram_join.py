import random
from collections import Counter, defaultdict

import pytest

from batchgate.llm import ngram_join as j
from batchgate.llm.components import components


def brute(texts, percent=75):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(k for g in s for k in holders[g])
        for g in s:
            holders[g].append(i)
        for k, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[k]) - n):
                a, b = sorted((find(i), find(k)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, groups=12, noise=40):
    """Groups of near copies, chains of them, exact copies, shared passages and short texts."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    passage = [word() for _ in range(40)]
    texts = [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four",
             "a b c d e", "A b c d e", "a b c d e f", "é b c d e", "É b c d e"]
    for _ in range(groups):
        base = [word() for _ in range(r.randrange(6, 120))]
        for _ in range(r.randrange(1, 14)):
            copy = list(base)
            for _ in range(r.randrange(0, 4)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            if r.random() < 0.5:
                base = copy  # a chain
    texts += [" ".join([word() for _ in range(r.randrange(10, 90))] + passage)
              for _ in range(noise)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,group_tokens,paired", [
    (1, j.GROUP_TOKENS, j.PAIRED), (2, 3, 2), (3, j.GROUP_TOKENS, 2)])
def test_components_against_brute_force(spark, seed, group_tokens, paired):
    texts = near_copies(seed)
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)],
                                  "doc_id long, text string, class string").repartition(5)
    rows = j.near_duplicate_groups(frame, group_tokens=group_tokens, paired=paired).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(
        enumerate(brute(texts)))


def test_repeated_and_null_ids(spark):
    same = "one two three four five six seven"
    frame = spark.createDataFrame([(7, same), (7, same), (None, same), (3, same), (None, "q"),
                                   (9, "q r"), (9, "s t")], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id)
                   for r in j.op9_ngram_jaccard_join(frame).collect()), key=str)
    assert rows == sorted([(7, 3, 3), (7, 3, 3), (None, 3, 3), (3, 3, 3), (None, 1, None),
                           (9, 1, 9), (9, 1, 9)], key=str)


def test_very_long_text(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    frame = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x" * 300_000)],
                                  "doc_id long, text string")
    rows = {r.doc_id: (r.n_shingles, r.component_id)
            for r in j.op9_ngram_jaccard_join(frame).collect()}
    assert rows == {1: (59_996, 1), 2: (59_997, 1), 3: (1, 3)}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert j.op9_ngram_jaccard_join(frame).count() == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(5)
    ids = r.sample(range(-10**12, 10**12), 300)
    links = [(ids[k], ids[k + 1]) for k in range(99)] + [(ids[100], ids[k])
                                                         for k in range(101, 200)]
    links += [(b, a) for a, b in links[:20]] + [(ids[250], ids[250])]
    r.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = defaultdict(set)
    for row in found:
        roots[row.root].add(row.node)
    assert sorted(map(sorted, roots.values())) == sorted([sorted(ids[:100]), sorted(ids[100:200])])
