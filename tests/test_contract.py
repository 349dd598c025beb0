"""The row contract against plain Python: decimal, strptime, str.strip, hmac."""

import hashlib
import hmac
import random
import unicodedata
from datetime import date, datetime
from decimal import Decimal, InvalidOperation

import pytest
from deliveries import DAY, sample_rows
from pyspark.sql import functions as F

from batchgate.functions.decimals import contract_decimal
from batchgate.functions.text import WHITESPACE, is_blank, strip
from batchgate.functions.tokens import (
    DEMO_KEY, hmac_sha256, key_id, register_token_function, token,
)
from batchgate.operators.contract import DEFAULT, canonical, classify, site_date, strict_shape

BATCH_DAY = date.fromisoformat(DAY)


def expected_decimal(text, factor):
    try:
        number = Decimal(text)
        if not number.is_finite() or not 0 <= number <= 10000:
            return None
        scaled = number * factor if factor != 1 else number
        return scaled.quantize(Decimal("0.0001")) + 0
    except InvalidOperation:
        return None


NUMBERS = [
    "0", "-0", "00090", "5.", ".5", "+5", "90.00005", "90.00015", "1_000", "_1", "1__0", "_", "1e3",
    "1E3", "1e-3", "1e5", "1e99999", "1e-99999", "0e99999", "-1e-99999", "1e99999999999999999999",
    "10000", "10000.0000", "10000.0001", "10000.0000000000000000001", "9999.99999999999999999999",
    "0.00014999999999999999999", "0.00005", "0.00015", "0.000050000000000000000000000001",
    "0.00005" + "0" * 40 + "1", "0.00005" + "0" * 60, "0.00004" + "9" * 60, "1" * 40, "0" * 50 + "5",
    "0" * 50 + "5.5", "NaN", "nan", "sNaN", "Infinity", "-inf", "-1", "-0.00001", "", ".", "e5", "5e",
    "5e+", "1.2.3", "1,000", "0x10", "１２.５", "٣", "1e٢", "½", "1 0", " 5", "5 ", "5e0002",
    "12345e-1", "123456789e-5", "0.0002777777777777777777777777777777777",
    "0.00000277777777777777777777777777777777777777", "5555.55555555555555555555555555555555",
    "0.055555555555555555555555555555555555555", "0.0555555555555555555555555555",
    "555.5555500000000000000000000000000000001", "2.5e-6", "0.0000027777", "99999", "100000",
    "1e4", "1e+4", "10000e0", "0.1e5", "0.10001e5", "-", "+", "+.5e1", "1e", "0.0", "-0.0",
]


def random_numbers(count):
    rng = random.Random(7)
    out = []
    for _ in range(count):
        whole = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 1, 2, 4, 5])))
        fraction = "".join(rng.choice("0005999" if rng.random() < 0.5 else "0123456789")
                           for _ in range(rng.choice([0, 1, 4, 5, 6, 18, 25, 34, 45])))
        text = whole + ("." + fraction if fraction or rng.random() < 0.2 else "")
        if rng.random() < 0.3:
            text += rng.choice("eE") + rng.choice(["", "+", "-"]) + str(rng.randint(0, 12))
        out.append(rng.choice(["", "", "", "+", "-"]) + text)
    return out


def test_decimals_match_python(spark):
    texts = sorted({*NUMBERS, *random_numbers(3000)})
    pairs = [(t, f) for t in texts for f in (1, 18)]
    rows = spark.createDataFrame(pairs, "text string, factor int").withColumn(
        "got", contract_decimal(F.col("text"), 0, 10000, F.col("factor"))
    ).collect()
    wrong = [(r.text, r.factor, r.got, expected_decimal(r.text, r.factor)) for r in rows
             # strip() comes first in the contract, so outer blanks never get here
             if r.text == r.text.strip() and r.got != expected_decimal(r.text, r.factor)]
    assert not wrong, wrong[:10]


def expected_date(text, site):
    separator = DEFAULT.date_separators[site]
    parts = text.split(separator)
    if [len(p) for p in parts] != [4, 2, 2] or not all(c.isdigit() for p in parts for c in p):
        return None
    try:
        return datetime.strptime(text, separator.join(["%Y", "%m", "%d"])).date()
    except ValueError:
        return None


def test_dates_match_python(spark):
    rng = random.Random(3)
    texts = ["2026-09-25", "2026-9-25", "2026-02-30", "2024-02-29", "2023-02-29", "0000-01-01",
             "0001-01-01", "9999-12-31", "2026-00-10", "2026-13-10", "2026-10-00", "2026-10-32",
             "09/25/2026", "２０２６-09-25", "2026-０9-25", "2026-09-2５", "2026-09-２5", "2026-09-25\n",
             "2026-09-0５", "2026-09-3１", "", "2026-09", "2026/09/25", "2026-09-25 "]
    texts += [f"{rng.randint(0, 3000):04d}-{rng.randint(0, 14):02d}-{rng.randint(0, 33):02d}"
              for _ in range(500)]
    rows = [(t if s == "A" else t.replace("-", "/"), s) for t in texts for s in "AB"]
    got = spark.createDataFrame(rows, "text string, hospital string").withColumn(
        "got", site_date(F.col("text"), F.col("hospital"), DEFAULT.date_separators)).collect()
    wrong = [tuple(r) for r in got if r.got != expected_date(r.text, r.hospital)]
    assert not wrong, wrong[:10]


def test_strip_matches_python(spark):
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}
    texts = [w + "x y" + w for w in WHITESPACE] + [w * 3 for w in WHITESPACE] + ["", "​x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", strip(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b")).collect()
    assert all(r.s == r.t.strip() and r.b == (not r.t.strip()) for r in rows)


def reason_of(spark, rows, day=BATCH_DAY):
    frame = spark.createDataFrame(
        [(i, s, *[r[c] for c in DEFAULT.columns]) for i, (s, r) in enumerate(rows)],
        "i int, hospital string, " + ", ".join(f"{c} string" for c in DEFAULT.columns))
    return [r.reason for r in classify(frame, day).orderBy("i").collect()]


def rule_cases():
    """(field, value, reason) on both sides of every rule, from the contract's own values."""
    prefixes = {n: r.prefix for n, r in DEFAULT.ids.items()}
    for name, prefix in prefixes.items():
        other = next(p for p in prefixes.values() if p != prefix)
        yield from [
            (name, None, "MISSING_FIELD"), (name, "\u2003\n", "MISSING_FIELD"),
            (name, other + "17", "ID_KIND"), (name, prefix, "NON_SYNTHETIC_ID"),
            (name, prefix.lower() + "17", "NON_SYNTHETIC_ID"),
            (name, prefix + "1 7", "NON_SYNTHETIC_ID"), (name, prefix + "٤", "NON_SYNTHETIC_ID"),
            (name, f"\u00a0{prefix}17\u2009", None), (name, prefix + "0" * 30, None)]
    year, month, day = BATCH_DAY.year, BATCH_DAY.month, BATCH_DAY.day
    for name in DEFAULT.dates:
        yield from [
            (name, f"{day}.{month}.{year}", "INVALID_DATE"), (name, f"{year}-13-01", "INVALID_DATE"),
            (name, f"{year - 1}-02-29", "INVALID_DATE"), (name, f"{year}-{month:02}", "INVALID_DATE"),
            (name, f"{year - 1}-{month:02}-{day:02}", "OUTSIDE_BATCH_DATE"),
            (name, f"{year}-{month:02}-{day - 1:02}", "OUTSIDE_BATCH_DATE")]
    first = DEFAULT.first_year
    for value, good in ((first - 1, 0), (first, 1), (year, 1), (year + 1, 0), ("19th", 0),
                        (f"{first}.", 0), ("٢٠٠٠", 1), ("", None)):
        yield DEFAULT.year_column, str(value), {
            1: None, 0: "INVALID_BIRTH_YEAR", None: "MISSING_FIELD"}[good]
    for value in ("12,75", "7%", "--3", "10000.01", "inf", "snan", "7e9999", "8 8", "250", "3.5e1",
                  "\u20091.5"):
        good = expected_decimal(value.strip(), 1) is not None
        yield DEFAULT.value_column, value, None if good else "INVALID_NUMERIC_VALUE"
    for code in DEFAULT.codes:
        yield DEFAULT.code_column, code.lower(), "UNKNOWN_TEST_CODE"
    for unit in DEFAULT.unit_factors:
        yield DEFAULT.unit_column, unit + "/h", "UNKNOWN_UNIT"
        yield DEFAULT.unit_column, unit.upper(), "UNKNOWN_UNIT"


def test_fixed_reasons(spark):
    row, cases = sample_rows("A", 1, dirty=False)[0], list(rule_cases())
    found = reason_of(spark, [("A", row | {field: value}) for field, value, _ in cases])
    assert [(f, v, r) for (f, v, _), r in zip(cases, found)] == cases


def test_first_failing_rule_names_the_reason(spark):
    good = sample_rows("A", 1, dirty=False)[0]
    steps = [("value", "x"), ("unit", "x"), ("test_code", "x"), ("birth_year", "x"),
             ("visit_date", "2026-09-24"), ("measurement_date", "x"), ("visit_id", "SYN-P-1"),
             ("patient_id", "x"), ("value", " ")]
    rows = []
    for field, value in steps:
        good = good | {field: value}
        rows.append(("A", good))
    assert reason_of(spark, rows) == [
        "INVALID_NUMERIC_VALUE", "UNKNOWN_UNIT", "UNKNOWN_TEST_CODE", "INVALID_BIRTH_YEAR",
        "OUTSIDE_BATCH_DATE", "INVALID_DATE", "ID_KIND", "NON_SYNTHETIC_ID", "MISSING_FIELD"]


def test_strict_shape_implies_acceptance(spark):
    values = ["90", "90.5", "10000", "10000.1", "5.", "1e3", "00090", "５", "-1"]
    rows = [("A", sample_rows("A", 1, False)[0] | {"value": v}) for v in values]
    rows += [("A", sample_rows("A", 1, False)[0] | {"birth_year": y}) for y in ("１９８０", "1899")]
    rows += [("B", sample_rows("B", 2, False)[1]), ("B", sample_rows("A", 1, False)[0])]
    frame = spark.createDataFrame(
        [(s, *[r[c] for c in DEFAULT.columns]) for s, r in rows],
        "hospital string, " + ", ".join(f"{c} string" for c in DEFAULT.columns))
    out = classify(frame.withColumn("strict", strict_shape(DEFAULT, BATCH_DAY)), BATCH_DAY)
    found = out.select("strict", F.col("reason").isNull().alias("ok")).collect()
    assert all(r.ok for r in found if r.strict)
    assert sum(r.strict for r in found) == 5 and sum(r.ok for r in found) == 9


def test_window_of_days(spark):
    rows = [sample_rows("A", 1, False, day)[0] for day in ("2026-09-24", "2026-09-25", "2026-09-27")]
    frame = spark.createDataFrame(
        [("A", *[r[c] for c in DEFAULT.columns]) for r in rows],
        "hospital string, " + ", ".join(f"{c} string" for c in DEFAULT.columns))
    out = canonical(classify(frame, date(2026, 9, 24), date(2026, 9, 25)), DEMO_KEY)
    assert sorted(str(r.batch_date) for r in out.collect()) == ["2026-09-24", "2026-09-25", "None"]


@pytest.mark.parametrize("key", [DEMO_KEY, b"k" * 16, b"long" * 40, bytes(range(64))])
def test_tokens_match_hmac(spark, key):
    ids = ["SYN-P-0", "SYN-P-123456789", "SYN-V-7"]
    frame = spark.createDataFrame([(s, i) for s in "AB" for i in ids], "h string, i string")
    register_token_function(spark, key, "try_token")
    rows = frame.select(
        "h", "i", token(key, F.col("h"), "person", F.col("i")).alias("t"),
        F.expr("try_token(h, 'person', i)").alias("s"), hmac_sha256(key, F.col("i")).alias("m"),
    ).collect()
    for r in rows:
        message = f'["{r.h}","person","{r.i}"]'.encode()
        assert r.t == r.s == hmac.new(key, message, hashlib.sha256).hexdigest()
        assert r.m == hmac.new(key, r.i.encode(), hashlib.sha256).hexdigest()
    assert len({r.t for r in rows}) == len(rows)
    assert key_id(key) != key_id(key + b"x")


def test_unicode_digit_table():
    from batchgate.functions import text

    assert all(unicodedata.digit(a) == int(b) for a, b in zip(text._WIDE, text._NARROW))
