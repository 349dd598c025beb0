"""Personal data: fixed patterns, and a linear-chain conditional random field for other spellings.

The patterns find email and network addresses, card and phone numbers in their usual form; every
match that passes its test is a span.  The field adds spans of the same kinds written otherwise
(``ana at mail dot com``, ``(017) 555-7713`` behind ``tel``, dotted or 15-digit card numbers).  It
tags words O, or B and I of a kind.  Its features are the word's shape, its length, digits and
check digit, and the same of two neighbours on either side; its weights come from a small labelled
table (``labelled``: words, tags) by gradient steps on the conditional likelihood.

Only words within REACH of one that holds a digit or an at sign, or says ``dot``, may be tagged:
the others are O by definition, as no span is without such a word.  So a text is a number of short
chains; all chains of a batch are decoded together by Viterbi's algorithm in numpy.  Predicted
spans that touch a span of the patterns, or fail the kind's own test, are left out.

Cases: a null text is empty; an empty text has no spans; offsets are code points of the whole
text, whose length is bounded by its row only (the patterns are matched in linear time); rows that
repeat get the same result each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.llm.common import quoted, tidy
from batchgate.llm.packing import text_chunks

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
# Words on either side of a telling one that may belong to its span.
REACH = 4
SIDES = (-2, -1, 0, 1, 2)
STEPS, RATE, DECAY = 100, 0.2, 2e-3
# At most so many rows of the labelled table are learned from.
LABELLED_ROWS = 5_000
CHUNK = 1 << 20

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOT = re.compile(r"(?<![^\x00-\x20\[({<])(?:dot|DOT|Dot)(?![^\x00-\x20\])}>])")
_NOT_DIGIT = re.compile("[^0-9]+")


def passes_luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What a leftmost search finds, from at sign to at sign."""
    done, sign = 0, text.find("@")
    low = 0
    while sign >= 0:
        before = text[max(done, low):sign]
        begin = sign - (len(before) - len(before.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, sign + 1) if begin < sign else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        low = sign + 1
        sign = text.find("@", max(done, low))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches that pass, by kind and start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# Features

_SHAPE = {**{c: "x" for c in "abcdefghijklmnopqrstuvwxyz"},
          **{c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "d" for c in "0123456789"}}
_RUNS = re.compile(r"([xX])\1+")
# Words whose identity counts; all others are known by shape.
CUES = frozenset("""at dot com org net info email mail e-mail contact write reach phone tel
telephone call fax mobile cell whatsapp text sms card visa mastercard amex credit debit payment
number no ip address server host addr gateway ext extension order invoice isbn version page born
build id room ref code part token key""".split())


def stripped(word: str) -> tuple[int, int]:
    """Where a word is without the punctuation around it."""
    a, b = 0, len(word)
    while a < b and word[a] in "\"'<>,;:!?.=|*":
        a += 1
    while b > a and word[b - 1] in "\"'<>,;:!?.=|*#$%&":
        b -= 1
    return a, b


@lru_cache(maxsize=100_000)
def features(word: str) -> tuple[str, ...]:
    """Names of a word's features."""
    if not word:
        return ("edge",)
    a, b = stripped(word)
    core = word[a:b][:64]
    low = core.lower()
    bare = low.strip("[](){}<>")
    shape = "".join(_SHAPE.get(c, c if c < "\x80" else "x") for c in core)
    digits = shape.count("d")
    out = ["shape=" + _RUNS.sub(r"\1", shape) if digits <= 20 else "shape=long",
           f"digits={min(digits, 20)}"]
    if bare in CUES:
        out.append("cue=" + bare)
        if bare != low:
            out.append("bracketed=" + bare)
    elif not digits and shape.strip("xX-'") == "":
        out.append("plain")
    if digits:
        letters = shape.count("x") + shape.count("X")
        out.append("mixed" if letters else "number")
        marks = "".join(sorted(set(shape) - set("xXd")))
        out.append("marks=" + marks)
        out.append("form=" + re.sub("d+", lambda m: str(min(len(m.group()), 6)),
                                    _RUNS.sub(r"\1", shape))[:24])
        only = "".join(c for c in core if c in "0123456789")
        if 13 <= len(only) <= 19 and passes_luhn(only):
            out.append("checked")
        if digits >= 11 or letters > 8:
            out.append("big")
    if "@" in core:
        out.append("sign")
    if word[-1:] in ",;:!?.":
        out.append("ends")
    return tuple(out)


# The small labelled table

def labelled_rows(rows: int = 700, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """Words and tags of invented sentences: spans in many spellings, and what only looks alike."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    syllables = "an er on the in ing ti ha en ion ue le la es ar de que ich sch un ge ver os".split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))

    def checked(n: int) -> str:
        head = pick("3456") + digits(n - 2)
        return next(head + str(d) for d in range(10) if passes_luhn(head + str(d)))

    def unchecked(n: int) -> str:
        number = checked(n)
        return number[:-1] + str((int(number[-1]) + int(rng.integers(1, 10))) % 10)

    def email() -> list[str]:
        at, dot = pick([("at", "dot"), ("[at]", "[dot]"), ("(at)", "(dot)"), ("AT", "DOT"),
                        ("{at}", "{dot}"), ("<at>", "<dot>")])
        host = [word(), dot, pick(["com", "org", "net", "example", "de"])]
        if rng.random() < 0.4:
            host += [dot, pick(["com", "org", "net"])]
        name = [word()] if rng.random() < 0.7 else [word(), dot, word()]
        if rng.random() < 0.3:
            name[-1] += digits(2)
        return [*name, at, *host]

    def phone() -> list[str]:
        return pick([lambda: [f"({digits(3)})", f"{digits(3)}-{digits(4)}"],
                     lambda: [f"{digits(3)}-{digits(3)}-{digits(4)}"],
                     lambda: [f"{digits(3)}.{digits(3)}.{digits(4)}"],
                     lambda: [f"0{digits(3)}", digits(3), digits(4)],
                     lambda: [f"0{digits(3)}/{digits(7)}"],
                     lambda: [f"00{digits(2)}", digits(3), digits(7)],
                     lambda: [digits(3), f"{digits(3)}-{digits(4)}"]])()

    def card() -> list[str]:
        n = checked(16)
        a = checked(15)
        return pick([lambda: [".".join(n[k:k + 4] for k in (0, 4, 8, 12))],
                     lambda: ["/".join(n[k:k + 4] for k in (0, 4, 8, 12))],
                     lambda: ["_".join(n[k:k + 4] for k in (0, 4, 8, 12))],
                     lambda: [a], lambda: [a[:4], a[4:10], a[10:]]])()

    def address() -> list[str]:
        parts = [str(int(x)) for x in rng.integers(0, 256, 4)]
        return pick([lambda: [parts[0], *[x for p in parts[1:] for x in ("dot", p)]],
                     lambda: ["[.]".join(parts)], lambda: ["(.)".join(parts)],
                     lambda: ["-dot-".join(parts)]])()

    def other() -> list[str]:
        return pick([lambda: [unchecked(16)], lambda: [digits(int(rng.integers(1, 13)))],
                     lambda: [f"{digits(4)}-{digits(2)}-{digits(2)}"], lambda: [unchecked(15)],
                     lambda: [f"{digits(2)}:{digits(2)}"], lambda: [f"{digits(1)}.{digits(2)}"],
                     lambda: [f"v{digits(1)}.{digits(1)}.{digits(2)}"], lambda: [checked(16)],
                     lambda: [f"{word()}{digits(2)}@{word()}.example.com"],
                     lambda: [f"{digits(3)}.{digits(2)}.{digits(3)}.{digits(2)}"],
                     lambda: ["+1", f"({digits(3)})", f"{digits(3)}-{digits(4)}"],
                     lambda: ["#" + digits(5)], lambda: [f"{digits(3)}-{digits(10)}"],
                     lambda: [f"${digits(2)}.{digits(2)}"], lambda: ["dot"], lambda: ["the", "dot"],
                     lambda: ["at", "the", "dot"], lambda: [digits(2) + "%"], lambda: [word(), "at"],
                     lambda: ['"' + hashlib.sha1(digits(6).encode()).hexdigest() + '"'],
                     lambda: [digits(4), digits(4)], lambda: [word() + digits(2)],
                     lambda: [f"{digits(2)}/{digits(2)}/{digits(4)}"], lambda: [f"{digits(3)},"],
                     lambda: [f"({digits(4)})"], lambda: [f"{digits(1)}-{digits(1)}"],
                     lambda: [digits(3), digits(3), digits(3)], lambda: [digits(16) + "."],
                     lambda: [f"{digits(3)}-{digits(4)}"], lambda: [checked(15)],
                     lambda: [word(), "dot", word()]])()

    lead = {"email": ["email", "mail", "contact", "write", "reach", "e-mail"],
            "phone": ["phone", "tel", "call", "fax", "mobile", "telephone", "whatsapp"],
            "card": ["card", "visa", "mastercard", "amex", "credit card", "payment"],
            "ip": ["ip", "server", "host", "address", "gateway", "addr"]}
    distract = ["order", "invoice", "isbn", "version", "page", "room", "ref", "code", "token =",
                "number", "id", "part", "build"]
    make = {"email": email, "phone": phone, "card": card, "ip": address}
    out = []
    for _ in range(rows):
        words = [word() for _ in range(int(rng.integers(0, 6)))]
        tags = ["O"] * len(words)
        for _ in range(int(rng.integers(1, 3))):
            if rng.random() < 0.5:
                kind = pick(KINDS)
                # Spellings that tell by themselves need no word before them.
                cued = kind in ("phone", "card") or rng.random() < 0.6
                before = pick(lead[kind]).split() if cued else []
                if before and rng.random() < 0.3:
                    before[-1] += ":"
                span = make[kind]()
                words += [*before, *span]
                tags += ["O"] * len(before) + [f"B-{kind}"] + [f"I-{kind}"] * (len(span) - 1)
            else:
                before = pick(distract).split() if rng.random() < 0.4 else [word()]
                span = other()
                words += [*before, *span]
                tags += ["O"] * (len(before) + len(span))
            if rng.random() < 0.3:
                words[-1] += pick([".", ","])
            more = int(rng.integers(1, 6))
            words += [word() for _ in range(more)]
            tags += ["O"] * more
        out.append((words, tags))
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "words array<string>, tags array<string>")


# The field

class Field:
    """Weights by feature, side and tag; transitions between tags (the last row: the beginning)."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves
        self.known: dict[str, np.ndarray] = {}

    def shares(self, words: list[str]) -> np.ndarray:
        """What each word adds to the scores of its neighbours and itself: word, side, tag."""
        out = np.empty((len(words), len(SIDES), len(TAGS)))
        for k, word in enumerate(words):
            own = self.known.get(word)
            if own is None:
                at = [self.names[f] for f in features(word) if f in self.names]
                own = self.weights[at].sum(axis=0)
                if len(self.known) < 100_000:
                    self.known[word] = own
            out[k] = own
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores of the words' tags; beyond either end are edges."""
        wide = self.shares(["", "", *words, "", ""])
        n = len(words)
        return sum(wide[2 + side:2 + side + n, k] for k, side in enumerate(SIDES))


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of all chains (chain, word, tag) at once; chains begin and end at O words."""
    many, longest, tags = scores.shape
    best = scores[:, 0] + moves[tags] if longest else np.zeros((many, tags))
    back = np.zeros((many, longest, tags), np.int8)
    for t in range(1, longest):
        reach = best[:, :, None] + moves[None, :tags]
        back[:, t] = reach.argmax(axis=1)
        step = reach.max(axis=1) + scores[:, t]
        best = np.where((t < lengths)[:, None], step, best)
    out = np.zeros((many, longest), np.int8)
    # What follows a chain is O.
    tag = (best + moves[:tags, 0]).argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        here = t < lengths
        out[:, t] = np.where(here, tag, 0)
        tag = np.where(here & (t > 0), back[np.arange(many), t, tag], tag)
    return out


def _summed(index: np.ndarray, values: np.ndarray, many: int) -> np.ndarray:
    """Rows of values added up by index."""
    flat = values.reshape(len(index), -1)
    return np.stack([np.bincount(index, column, many) for column in flat.T], 1).reshape(
        many, *values.shape[1:])


def fit(rows: list[tuple[list[str], list[str]]], steps: int = STEPS, rate: float = RATE,
        decay: float = DECAY) -> Field:
    """Weights that make the labelled tags likely, by full-batch gradient steps (Adam)."""
    rows = sorted((r for r in rows if len(r[0])), key=lambda r: len(r[0]))
    number = {t: k for k, t in enumerate(TAGS)}
    distinct = {"": 0}
    for words, _ in rows:
        for w in words:
            distinct.setdefault(w, len(distinct))
    names: dict[str, int] = {}
    pairs = [(k, names.setdefault(f, len(names))) for w, k in distinct.items() for f in features(w)]
    of_word, of_feature = (np.array(x, np.int64) for x in zip(*pairs))
    n_tags, many = len(TAGS), len(rows)
    longest = max((len(w) for w, _ in rows), default=0)
    lengths = np.array([len(w) for w, _ in rows], np.int64)
    word_at = np.zeros((many, longest + 4), np.int64)
    tag_at = np.zeros((many, longest), np.int64)
    for k, (words, tags) in enumerate(rows):
        word_at[k, 2:2 + len(words)] = [distinct[w] for w in words]
        tag_at[k, :len(tags)] = [number[t] for t in tags]
    there = np.arange(longest) < lengths[:, None]
    weights = np.zeros((len(names), len(SIDES), n_tags))
    moves = np.zeros((n_tags + 1, n_tags))
    # I only follows B or I of its kind.
    never = np.zeros_like(moves)
    for k, tag in enumerate(TAGS):
        if tag[0] == "I":
            never[[j for j in range(n_tags + 1) if j not in (k, k - 1)], k] = -50.0
    first = [np.zeros_like(weights), np.zeros_like(moves)]
    second = [np.zeros_like(weights), np.zeros_like(moves)]
    truth = np.zeros((many, longest, n_tags))
    np.put_along_axis(truth, tag_at[:, :, None], 1.0, axis=2)
    truth[~there] = 0
    seen_moves = np.zeros_like(moves)
    if many:
        np.add.at(seen_moves, (np.full(many, n_tags), tag_at[:, 0]), 1)
        both = there[:, 1:]
        np.add.at(seen_moves, (tag_at[:, :-1][both], tag_at[:, 1:][both]), 1)
        np.add.at(seen_moves, (tag_at[np.arange(many), lengths - 1], np.zeros(many, int)), 1)
    for step in range(1, steps + 1 if many else 1):
        shares = _summed(of_word, weights[of_feature], len(distinct))
        scores = sum(shares[word_at[:, 2 + side:2 + side + longest], k]
                     for k, side in enumerate(SIDES))
        odds = np.exp(scores - scores.max(axis=2, keepdims=True))
        change = np.exp(moves + never)
        # Forward and backward sums, each scaled to a total of 1.
        ahead, behind = np.empty_like(odds), np.empty_like(odds)
        ahead[:, 0] = odds[:, 0] * change[n_tags]
        ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            new = ahead[:, t - 1] @ change[:n_tags] * odds[:, t]
            new /= new.sum(axis=1, keepdims=True)
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        behind[:, -1] = change[:n_tags, 0]
        expected = np.zeros_like(moves)
        for t in range(longest - 1, 0, -1):
            reach = odds[:, t] * behind[:, t]
            new = reach @ change[:n_tags].T
            total = (ahead[:, t - 1] * new).sum(axis=1, keepdims=True)
            inside = there[:, t, None] / total
            expected[:n_tags] += (ahead[:, t - 1] * inside).T @ reach * change[:n_tags]
            new /= new.sum(axis=1, keepdims=True)
            behind[:, t - 1] = np.where(there[:, t, None], new, behind[:, t])
        share = ahead * behind
        share /= share.sum(axis=2, keepdims=True)
        share[~there] = 0
        expected[n_tags] += share[:, 0].sum(axis=0)
        expected[:n_tags, 0] += share[np.arange(many), lengths - 1].sum(axis=0)
        rest = (truth - share).reshape(-1, n_tags)
        per_word = np.stack([_summed(word_at[:, 2 + side:2 + side + longest].ravel(), rest,
                                     len(distinct)) for side in SIDES], 1)
        slope = _summed(of_feature, per_word[of_word], len(names))
        slopes = [slope / many - decay * weights, (seen_moves - expected) / many - decay * moves]
        for held, one, two, g in zip((weights, moves), first, second, slopes):
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            held += rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-8)
    return Field(names, weights, moves + never)


# Decoding

_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TELLS = np.zeros(128, bool)
_TELLS[[*range(48, 58), 64]] = True


def chains(text: str) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Where the words begin and end, and ranges of words that may be tagged."""
    none = np.zeros(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = codes < 128
    small = np.where(plain, codes, 0)
    tells = np.flatnonzero(plain & _TELLS[small])
    dots = [m.start() for m in _DOT.finditer(text)] if "dot" in text or "DOT" in text or (
        "Dot" in text) else []
    if not len(tells) and not dots:
        return none, none, []
    space = plain & _SPACE[small]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1, append=1))
    first, behind = edge[::2], edge[1::2]
    at = np.unique(np.searchsorted(first, np.append(tells, dots).astype(np.int64), "right") - 1)
    low, high = np.maximum(at - REACH, 0), np.minimum(at + REACH + 1, len(first))
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
    ends = np.append(new[1:] - 1, len(at) - 1)
    return first, behind, list(zip(low[new].tolist(), high[ends].tolist()))


def accepted(kind: str, text: str) -> bool:
    """A kind's own test of what the field found."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        return re.search(r"@|(?i:\bat\b)", text) is not None and len(text) <= 320
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and passes_luhn(digits)
    return 7 <= len(digits) <= 15


def added_spans(field: Field, texts: list[str], base: list[list[tuple[str, int, int]]]
                ) -> list[list[tuple[str, int, int]]]:
    """What the field adds to each text's spans; all chains of the texts are decoded together."""
    places, scored = [], []
    for k, text in enumerate(texts):
        first, behind, ranges = chains(text)
        for a, b in ranges:
            wide = [text[first[j]:behind[j]] if 0 <= j < len(first) else ""
                    for j in range(a - 2, b + 2)]
            shares = field.shares(wide)
            scored.append(sum(shares[2 + side:2 + side + b - a, n]
                              for n, side in enumerate(SIDES)))
            places.append((k, first[a:b], behind[a:b]))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(scored)), key=lambda k: len(scored[k]))
    start = 0
    while start < len(order):
        # Neighbours in length share a batch; its size is bounded by the longest.
        batch = order[start:start + 512]
        while len(batch) > 1 and len(batch) * len(scored[batch[-1]]) > 1 << 16:
            batch = batch[:len(batch) // 2]
        start += len(batch)
        lengths = np.array([len(scored[k]) for k in batch])
        block = np.zeros((len(batch), int(lengths.max()), len(TAGS)))
        for row, k in enumerate(batch):
            block[row, :len(scored[k])] = scored[k]
        best = viterbi(block, lengths, field.moves)
        for row in np.flatnonzero((best > 0).any(axis=1)).tolist():
            k, first, behind = places[batch[row]]
            tags = best[row, :lengths[row]].tolist()
            for kind, a, b in tagged(tags):
                begin, end = int(first[a]), int(behind[b - 1])
                text = texts[k][begin:end]
                cut_a, cut_b = stripped(text)
                begin, end = begin + cut_a, begin + cut_b
                if begin < end and accepted(kind, texts[k][begin:end]) and not any(
                        x < end and begin < y for _, x, y in base[k]):
                    out[k].append((kind, begin, end))
    return out


def tagged(tags: list[int]) -> Iterator[tuple[str, int, int]]:
    """Kind, first word and word behind of each span in a chain's tags."""
    begin = None
    for t, tag in enumerate([*tags, 0]):
        name = TAGS[tag]
        if begin is not None and not name.startswith("I"):
            yield TAGS[tags[begin]][2:], begin, t
            begin = None
        if name.startswith("B"):
            begin = t


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
        spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The id, counts and digest of the patterns' spans, and all spans of every document."""
    spark = docs.sparkSession
    table = labelled if labelled is not None else labelled_table(spark)
    rows = [(list(r.words), list(r.tags)) for r in table.select("words", "tags").orderBy(
        F.xxhash64("words"), "words", "tags").limit(LABELLED_ROWS).collect()]
    field = fit(rows)
    held = spark.sparkContext.broadcast((field.names, field.weights, field.moves))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*held.value)
        for whole in batches:
            for batch in text_chunks(whole, "text", CHUNK):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(own, texts, base)
                counts = [[sum(k == kind for k, _, _ in b) for b in base] for kind in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base],
                              pa.string()),
                     pa.array([written(b + m) for b, m in zip(base, more)], pa.string())], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(quoted(id_col).alias("doc_id"),
                       quoted(text_col).cast("string").alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string")


def op13_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in every whole document."""
    return find(docs)
