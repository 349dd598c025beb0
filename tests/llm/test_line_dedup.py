import math
from collections import Counter, defaultdict

import xxhash

from batchgate.llm import line_dedup as l


def key(text):
    """Spark's hash of a text, by which its texts are looked at in order."""
    n = xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (n >> 63 << 64)


def pieces(text):
    raw = "".join("0" if c.isascii() and c.isdigit() else c for c in text).encode().ljust(l.PIECE)
    return {raw[k:k + l.PIECE] for k in range(len(raw) - l.PIECE + 1)}


def related(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) >= l.RELATED * len(a | b)


def brute(texts, min_docs=3, diversity=0.3, agreement=0.6, min_tokens=3):
    """The masked lines to drop, found without tables, sketches or bit arrays."""
    where = defaultdict(list)
    for text in {t for t in texts if t is not None}:
        lines = [m for m in map(l.masked, text.split("\n")) if m]
        if len(lines) < 2:
            continue
        leaf = [("own", text), *((len(m), tuple(m[:3])) for m in lines), ("own", text)]
        for k, m in enumerate(lines):
            if len(m) >= min_tokens:
                where[tuple(m)].append((text, leaf[k], leaf[k + 2]))

    def recurs(places):
        n, before, behind = (len({p[k] for p in places}) for k in range(3))
        if n < min_docs:
            return False
        if min(before, behind) >= max(min_docs, diversity * n):
            return True
        left = sorted({p[0] for p in places}, key=key)
        for _ in range(min_docs - 1):
            left = [t for t in left if not related(t, left[0])]
            if not left:
                return False
        return True

    drop = {m for m, places in where.items() if recurs(places)}
    leaves = defaultdict(dict)
    for m, places in where.items():
        if m not in drop:
            leaves[len(m), m[:3]][m] = {p[0] for p in places}
    groups = defaultdict(set)
    for leaf, lines in leaves.items():
        if len(lines) > 1 and sum(map(len, lines.values())) >= min_docs:
            count = Counter((k, t) for m, own in lines.items() for k, t in enumerate(m)
                            for _ in own)
            level = {kt: int(math.log2(n / min_docs)) for kt, n in count.items() if n >= min_docs}
            for m in lines:
                for least in {level[kt] for kt in enumerate(m) if kt in level}:
                    fixed = tuple(kt for kt in enumerate(m) if level.get(kt, -1) >= least)
                    if agreement * len(m) <= len(fixed) < len(m):
                        groups[leaf, fixed].add(m)
    for lines in groups.values():
        if recurs([p for m in lines for p in where[m]]):
            drop |= lines
    return drop


def without(text, drop):
    lines = text.split("\n")
    if sum(bool(x.split()) for x in lines) < 2:
        return text, 0
    kept = [x for x in lines if len(l.masked(x)) < 3 or tuple(l.masked(x)) not in drop]
    out = "\n".join(kept)
    return (out if out.strip() else ""), len(lines) - len(kept)


NAMES = ["Ann", "Bob", "Cleo", "Dan", "Eve", "Finn"]


def texts():
    plain = [f"start {c} of its own\n{c * 3} and more here too\n{c * 2} last words in it"
             for c in "abcdefgh"]
    out = []
    for k, (p, name) in enumerate(zip(plain, NAMES * 2)):
        a, b, c = p.split("\n")
        out.append("\n".join([a, "All rights reserved by us", b,
                              f"Posted by user {name} on day {k} at home", c, "Of."]))
    copies = ["head one two three\nbody four five six\ntail seven eight nine\n" + x
              for x in ("p q r", "p q s", "p q t", "p q u")]
    return [*out, *copies, *copies, None, "", " \n ", "All rights reserved by us", "one\n\n\ntwo",
            "All rights reserved by us\nPosted by user Gil on day 9 at home", "x " * 50_000,
            "number 12 of 13\nOf.", "number 14 of 15\nOf."]


def test_against_brute_force(spark, tables):
    for some in (texts(), tables("documents").text.tolist()):
        frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(some)],
                                      "doc_id long, text string, doc string").repartition(3)
        got = {r.doc_id: r for r in l.without_templates(frame).collect()}
        drop = brute(some)
        assert drop and len(got) == len(some)
        for k, text in enumerate(some):
            want = (None, 0) if text is None else without(text, drop)
            assert (got[k].text, got[k].n_dropped) == want, k
            assert got[k].n_lines == (0 if text is None else text.count("\n") + 1)
            assert got[k].doc == "x"


def test_what_goes_and_what_stays(spark):
    some = texts()
    frame = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in l.op5_line_dedup(frame).collect()}
    assert not any("reserved" in got[k] or "Posted by" in got[k] for k in range(8))
    assert all(got[k] == some[k] for k in range(8, 16))  # copies keep what they share
    assert got[19] == "All rights reserved by us"  # a whole text is no line of others
    assert got[21] == ""  # nothing but templates


def test_a_line_without_spaces_recurs(spark):
    """A notice in unrelated Chinese and Thai texts goes; a shorter one stays."""
    notice, short = "版权所有未经许可不得转载本站内容", "目录"
    some = []
    for k in range(20):
        own = ["".join(chr(0x4e00 + (k * 997 + j * 131 + i * 31) % 9000) for i in range(40))
               for j in range(5)]
        some.append("\n".join([*own[:2], notice, short, *own[2:]]))
    for k in range(5):
        own = ["".join(chr(0x0e01 + (k * 7 + j * 13 + i * i) % 45) for i in range(40))
               for j in range(4)]
        some.append("\n".join([*own[:2], "สงวนลิขสิทธิ์ทั้งหมด", *own[2:]]))
    frame = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in l.op5_line_dedup(frame.repartition(3)).collect()}
    for k, text in enumerate(some):
        lines = text.split("\n")
        assert got[k] == "\n".join(x for x in lines if x != notice and not x.startswith("สง"))


def test_clashing_names_and_a_long_text_of_many_lines(spark):
    notice = "All rights reserved by us"
    long = "\n".join(f"{chr(97 + k % 26)} line of its own with word {'xy'[k % 2] * (k % 9973)}"[:300]
                     if k % 100 else notice for k in range(30_000))
    some = [*texts()[:8], long, None, long]
    frame = spark.createDataFrame([(k, t, 7, "x", 1, 2) for k, t in enumerate(some)],
                                  "doc_id long, text string, n_lines int, n_dropped string, "
                                  "leaf int, line int").repartition(3)
    got = {r.doc_id: r for r in l.without_templates(frame).collect()}
    for k, text in enumerate(some):
        assert (got[k].n_lines, got[k].n_dropped, got[k].leaf, got[k].line) == (7, "x", 1, 2)
        assert got[k]["_n_lines"] == (0 if text is None else text.count("\n") + 1)
    assert got[8].text == got[10].text and notice not in got[8].text
    assert got[8]["_n_dropped"] >= 300


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert l.op5_line_dedup(frame).count() == 0
