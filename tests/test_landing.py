"""The file reader against Python's csv module, over many small splits."""

import csv
import random
from datetime import date

import pytest
from deliveries import DAY, Landing, sample_rows
from pyspark.sql import functions as F

from batchgate import BatchError, quarantine_rows, run_batch
from batchgate.functions.tokens import DEMO_KEY
from batchgate.operators.contract import DEFAULT
from batchgate.plans.stage import stage
from batchgate.sources import landing


@pytest.fixture
def small_splits(spark):
    """Splits of about 2 KiB, so records and quotes cross many split borders."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def expected_records(path):
    """Fields and last physical line of every record, header and blank lines skipped."""
    with open(path, encoding="utf-8", newline="") as stream:
        reader = csv.reader(stream)
        next(reader)
        return [(reader.line_num, row) for row in reader if row]


def spark_records(spark, path, scratch):
    """The same through the assembling reader; inner line ends come back as LF."""
    landing.read_lines(spark, [str(path)]).write.parquet(f"{scratch}/lines")
    numbered = landing.number_lines(spark.read.parquet(f"{scratch}/lines"))
    value = F.col("value")
    flagged = numbered.withColumns({"opens": landing.opens(value), "stays": landing.stays_open(value)})
    landing.quote_states(flagged).write.parquet(f"{scratch}/marked")
    records = landing.assemble_records(spark.read.parquet(f"{scratch}/marked"))
    rows = records.where("line > 1").withColumn("raw", landing.raw_fields(F.col("value"))).select(
        "line", F.transform("raw", landing.unquote).alias("fields")).orderBy("line").collect()
    return [(r.line, list(r.fields)) for r in rows]


def normal(records):
    return [(n, [f.replace("\r\n", "\n").replace("\r", "\n") for f in row]) for n, row in records]


PIECES = ["a", "", " ", "x y", '"q"', '"a,b"', '"a""b"', '"""', '""', '"a\nb"', '"\r\n"', '"x\n\n\ny"',
          '5" nail', 'a"b"c', '"ab"c', '"ab" "c"', '"ab"c"d', '"line\nend"tail', "é５", '"multi\r\n""q""\n,z"']


@pytest.mark.parametrize("seed", range(6))
def test_random_text_matches_csv_module(spark, small_splits, tmp_path, seed):
    rng = random.Random(seed)
    lines = [",".join(DEFAULT.columns)]
    for _ in range(1500):
        if rng.random() < 0.1:
            lines.append("")
        else:
            # '"""' alone opens a field that runs on; keep it rare
            pool = PIECES if rng.random() < 0.02 else [p for p in PIECES if p != '"""']
            lines.append(",".join(rng.choice(pool) for _ in range(rng.randint(1, 11))))
    path = tmp_path / "hospital_A.csv"
    end = rng.choice(["\n", "\r\n"])
    path.write_text(end.join(lines) + rng.choice(["", end]), encoding="utf-8", newline="")
    assert spark_records(spark, path, tmp_path / "scratch") == normal(expected_records(path))


def test_line_numbers_over_many_splits(spark, small_splits, tmp_path):
    path = tmp_path / "hospital_A.csv"
    text = "".join(f"{i}\r\n" for i in range(1, 20001))
    path.write_text(text, newline="")
    lines = landing.read_lines(spark, [str(path)])
    assert lines.rdd.getNumPartitions() > 8
    lines.write.parquet(str(tmp_path / "lines"))
    numbered = landing.number_lines(spark.read.parquet(str(tmp_path / "lines")))
    assert numbered.where(F.col("line") != F.col("value").cast("long")).isEmpty()
    assert numbered.count() == 20000


def test_fingerprint_ignores_splits_and_sees_every_change(spark, tmp_path):
    delivery = Landing(tmp_path / "landing").fill(400)
    whole = landing.input_fingerprint(spark, str(delivery), ["A", "B"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert landing.input_fingerprint(spark, str(delivery), ["A", "B"]) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    seen = {whole}
    text = delivery.file("A").read_bytes()
    changes = [text.replace(b"\r\n", b"\n"), text.replace(b"SYN-P-7,", b"SYN-P-8,", 1),
               text + b"\r\n", text[:-2]]
    lines = text.split(b"\r\n")
    lines[5], lines[300] = lines[300], lines[5]
    changes.append(b"\r\n".join(lines))
    for changed in changes:
        delivery.file("A").write_bytes(changed)
        seen.add(landing.input_fingerprint(spark, str(delivery), ["A", "B"]))
    delivery.file("A").write_bytes(text)
    delivery.control("A").write_text("0404\n")
    seen.add(landing.input_fingerprint(spark, str(delivery), ["A", "B"]))
    assert len(seen) == 2 + len(changes)


# Spellings of numbers; only the ninth is outside the contract.
SPELLINGS = ["\u00a07.25", "8\u2009", "٨", "2E+1", "-0.0", "61.", ".125", "33.33335", "12000", "2_5",
             "9999.9999", "007"]


def numbered(site, number, **changes):
    row = sample_rows(site, 1, False)[0]
    return row | {"visit_id": f"SYN-V-{number}", "measurement_id": f"SYN-M-{number}"} | changes


def odd_rows(site):
    """Rows with odd spellings; those at 8, 12 and 13 fail."""
    rows = [numbered(site, 4000 + i, value=v) for i, v in enumerate(SPELLINGS)]
    return rows + [
        numbered(site, 4100, unit="mg/DL "), numbered(site, 4101, measurement_date="25 Sep 2026"),
        numbered(site, 4102, birth_year="١٩٧٧", patient_id="SYN-P-4102"),
        numbered(site, 4103, visit_id="SYN-V-4103\u2003")]


def csv_line(number, **changes):
    return ",".join(numbered("A", number, **changes).values())


# Name: what follows the 44 usual rows, and how many rows it is.
EXTRA = {
    "empty_line": ("\n", 44),
    "one_field_more": (csv_line(4200) + ",y\r\n", 45),
    "comma_at_the_end": (csv_line(4201) + ",\n", 45),
    "line_end_in_a_field": (csv_line(4202, unit='"mg/\ndL"') + "\r\n", 45),
    "blanks_in_quotes": (csv_line(4203, value='"\r\n \r\n75"') + "\n", 45),
    "one_field": ("SYN-P-4204\n", 45),
    "decimal_comma": (csv_line(4205, value='"1,5"') + "\r\n", 45),
    "quotes_everywhere": (
        ",".join(f'"{v}"' for v in numbered("A", 4206).values()) + "\r\n", 45),
    "second_header": (",".join(DEFAULT.columns) + "\n", 45),
    "no_closing_quote": ('SYN-P-4207,1980,"SYN-V\r\n\r\nrest\r\n', 45),
}
OUTCOME = {
    "empty_line": (82, {}), "one_field_more": (82, {46: "COLUMN_COUNT"}),
    "comma_at_the_end": (82, {46: "COLUMN_COUNT"}),
    "line_end_in_a_field": (82, {47: "UNKNOWN_UNIT"}), "blanks_in_quotes": (83, {}),
    "one_field": (82, {46: "MISSING_FIELD"}), "decimal_comma": (82, {46: "INVALID_NUMERIC_VALUE"}),
    "quotes_everywhere": (83, {}), "second_header": (82, {46: "NON_SYNTHETIC_ID"}),
    "no_closing_quote": (82, {48: "MISSING_FIELD"}),
}


@pytest.mark.parametrize("case", EXTRA)
def test_malformed_shapes(spark, delivery, store, case):
    text, rows = EXTRA[case]
    delivery.append("A", text, rows)
    report = run_batch(spark, str(delivery), store, DAY, max_reject_ratio=0.2)
    accepted, rejects = OUTCOME[case]
    assert report["accepted_rows"] + report["duplicate_rows"] == accepted
    found = {r.line: r.reason for r in quarantine_rows(spark, store, report["run_id"])
             .where("hospital = 'A'").collect()}
    assert found == {43: "MISSING_FIELD", 44: "INVALID_DATE", 45: "UNKNOWN_UNIT"} | rejects
    spans = case in ("line_end_in_a_field", "blanks_in_quotes", "no_closing_quote")
    assert report["engine"] == {"A": "records" if spans else "lines", "B": "lines"}


def test_odd_spellings(spark, delivery, store):
    for site in "AB":
        delivery.write(site, sample_rows(site) + odd_rows(site))
    report = run_batch(spark, str(delivery), store, DAY, max_reject_ratio=0.2)
    lines = {s: [(r.line, r.reason) for r in quarantine_rows(spark, store, report["run_id"])
                 .where(F.col("hospital") == s).collect()][3:] for s in "AB"}
    assert lines["A"] == [(54, "INVALID_NUMERIC_VALUE"), (58, "UNKNOWN_UNIT"), (59, "INVALID_DATE")]
    assert lines["B"] == lines["A"]
    assert report["accepted_rows"] == 80 + 26


def test_assembling_reader_agrees_with_the_direct_one(spark, small_splits, tmp_path):
    """The same rows read either way: equal rows, rejects, lines and counts."""
    delivery = Landing(tmp_path / "landing")
    for site in "AB":
        delivery.write(site, sample_rows(site, 300) + odd_rows(site))

    def staged(name):
        listed = landing.list_delivery(spark, str(delivery), ["A", "B"])
        return stage(spark, listed, str(delivery), date.fromisoformat(DAY), DEMO_KEY, DEFAULT,
                     str(tmp_path / name))

    direct = staged("one")
    assert direct.engine == {"A": "lines", "B": "lines"}
    for site in "AB":
        delivery.append(site, 'SYN-P-0,1980,"x\r\ny",x,x,x,x,x,x\r\n', 321)
    slow = staged("two")
    assert slow.engine == {"A": "records", "B": "records"}
    assert slow.accepted.exceptAll(direct.accepted).isEmpty()
    assert direct.accepted.exceptAll(slow.accepted).isEmpty()
    assert direct.rejected.exceptAll(slow.rejected).isEmpty()
    extra = slow.rejected.exceptAll(direct.rejected).collect()
    assert [(r.line, r.reason) for r in extra] == [(323, "NON_SYNTHETIC_ID")] * 2
    assert slow.input_rows == {"A": 321, "B": 321}


def test_record_without_end_is_refused_in_one_piece(spark, delivery, store, tmp_path):
    filler = ("x" * 999 + "\n") * 3000
    delivery.append("A", 'SYN-P-1,1980,"' + filler, 45)
    with pytest.raises(BatchError, match="INTERNAL_ERROR"):
        run_batch(spark, str(delivery), store, DAY)
    delivery.fill().append("A", 'SYN-P-1,1980,"' + filler[:200000] + '"\n', 45)
    with pytest.raises(BatchError, match="INTERNAL_ERROR"):
        run_batch(spark, str(delivery), store, DAY)


def test_long_record_of_legal_fields_is_one_reject(spark, delivery, store):
    """Longer than any record of nine fields within the limit, and yet no field is beyond it."""
    fields = ['"' + "x" * 60_000 + "\n" + "y" * 40_000 + '"'] * 25 + ["z"] * 8
    delivery.append("A", ",".join(fields) + "\r\n", 45)
    report = run_batch(spark, str(delivery), store, DAY, max_reject_ratio=0.2)
    assert report["reject_reasons"]["COLUMN_COUNT"] == 1
    found = {r.line: r.reason for r in quarantine_rows(spark, store, report["run_id"])
             .where("hospital = 'A' and line > 45").collect()}
    assert found == {71: "COLUMN_COUNT"}
    # One of its fields grows beyond the limit, in three pieces.
    fields[3] = '"' + "\n".join(["x" * 44_000] * 3) + '"'
    delivery.fill().append("A", ",".join(fields) + "\r\n", 45)
    with pytest.raises(BatchError, match="INTERNAL_ERROR"):
        run_batch(spark, str(delivery), store, DAY)


def test_only_quoted_lines_are_sorted(spark, small_splits, tmp_path):
    """Spanning lines come from a few events; they equal those of the walk over all lines."""
    rng = random.Random(8)
    lines = [",".join(DEFAULT.columns)]
    for k in range(3000):
        lines.append(rng.choice(PIECES) + ",x" if rng.random() < 0.05 else f"plain{k},x")
    path = tmp_path / "hospital_A.csv"
    path.write_text("\n".join(lines), encoding="utf-8", newline="")
    value = F.col("value")
    landing.read_lines(spark, [str(path)]).withColumns({
        "line_hash": landing.line_hash(value), "kind": landing.line_kind(value),
        "stays": landing.stays_open(value), "opens": landing.opens(value),
    }).write.parquet(str(tmp_path / "stage"))
    staged = spark.read.parquet(str(tmp_path / "stage"))
    blocks = landing.with_offsets(landing.line_counts(staged, ("hospital", "file", "block")))
    events = staged.where("opens or not stays").select(*landing.LINE_KEY, "opens", "stays")
    intervals = landing.spanning_intervals(events, blocks)
    sparse = landing.interval_lines(intervals).select(*landing.LINE_KEY, "record")
    dense = landing.spanning_lines(landing.quote_states(staged)).select(*sparse.columns)
    assert sorted(map(tuple, sparse.collect())) == sorted(map(tuple, dense.collect()))
    assert 0 < events.count() < 400 and dense.count() > 20
    plan = intervals._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan  # windows see what passes it


def test_a_quote_that_never_closes_is_one_interval(spark, small_splits, tmp_path):
    path = tmp_path / "hospital_A.csv"
    path.write_text("h\n" + "a,b\n" * 100 + '"open,b\n' + "c,d\n" * 20_000, newline="")
    value = F.col("value")
    landing.read_lines(spark, [str(path)]).withColumns({
        "line_hash": landing.line_hash(value), "stays": landing.stays_open(value),
        "opens": landing.opens(value)}).write.parquet(str(tmp_path / "stage"))
    staged = spark.read.parquet(str(tmp_path / "stage"))
    blocks = landing.with_offsets(landing.line_counts(staged, ("hospital", "file", "block")))
    intervals = landing.spanning_intervals(
        staged.where("opens or not stays").select(*landing.LINE_KEY, "opens", "stays"), blocks)
    assert intervals.select("record").distinct().count() == 1
    assert landing.interval_lines(intervals).distinct().count() == 20_001
