from batchgate.llm import line_dedup as l

WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"]


def prose(seed, lines=6):
    """Lines of words that no two seeds share in a row."""
    return [" ".join(WORDS[(seed * 7919 + k * 131 + j * j * (seed + 3)) % len(WORDS)]
                     for j in range(12)) for k in range(lines)]


def cut(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.text for r in l.op5_line_dedup(frame.repartition(3)).collect()}


def test_a_passage_of_several_lines_recurs(spark):
    block = ["Published by the old harbour press", "No part may be copied", "Ask us first please"]
    own = [prose(k) for k in range(9)]
    got = cut(spark, ["\n".join([*p[:3], *block, *p[3:]]) for p in own])
    assert all(got[k] == "\n".join(p) for k, p in enumerate(own))


def test_near_copies_keep_what_they_share(spark):
    base = prose(99, 20)
    near = ["\n".join([*base[:k], f"Edited by {WORDS[k]} and {WORDS[k + 40]}", *base[k + 1:]])
            for k in range(20)]
    got = cut(spark, near)
    assert all(got[k] == text for k, text in enumerate(near))


def test_near_copies_of_one_text_do_not_save_a_line(spark):
    licence = "All rights reserved by the makers"
    own = [prose(k) for k in range(12)]
    base = prose(99, 20)
    near = ["\n".join([*base[:k % 19 + 1], f"{WORDS[k]} {WORDS[k + 70]} {WORDS[k + 140]}",
                       *base[k % 19 + 2:], licence, "The End."]) for k in range(60)]
    got = cut(spark, ["\n".join([*p[:3], licence, *p[3:]]) for p in own] + near)
    assert all(got[k] == "\n".join(p) for k, p in enumerate(own))
    assert all(got[12 + k] == text.replace(licence + "\n", "") for k, text in enumerate(near))


def test_frequent_names_are_variable_in_a_busy_leaf(spark):
    own = [prose(k) for k in range(36)]
    by = [f"Posted by the user {WORDS[k % 12]} from {WORDS[100 + (k + k // 12) % 12]}"
          for k in range(36)]
    got = cut(spark, ["\n".join([*p[:3], b, *p[3:]]) for p, b in zip(own, by)])
    assert all(got[k] == "\n".join(p) for k, p in enumerate(own))
