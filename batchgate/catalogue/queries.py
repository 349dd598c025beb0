"""One query per operator, each over whole tables.

Queries on published snapshots and delivered files first write those from the tables, to
the shared scratch area.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType, DecimalType, LongType, StringType, StructField, StructType,
)

from batchgate.catalogue.inputs import (
    BATCH_DAY, FIRST_DAY, LAST_DAY, SITES, classified, deliver_files, delivered, read,
)
from batchgate.errors import BatchError
from batchgate.functions.decimals import contract_decimal
from batchgate.functions.tokens import DEMO_KEY, token
from batchgate.operators import audit as expect
from batchgate.operators import gates
from batchgate.operators.compare import snapshot_diff
from batchgate.operators.contract import (
    CANONICAL, DEFAULT, canonical, classify, site_date, strict_shape, unit_factor,
)
from batchgate.operators.hashtree import tree_diff, write_tree
from batchgate.operators.median import medians
from batchgate.operators.digest import row_hash, tree_digest
from batchgate.plans import store as stores
from batchgate.plans.batch import entity_rows, run_batch
from batchgate.plans.daily import audit
from batchgate.plans.stage import stage, typed_rows
from batchgate.plans.tables import TABLES
from batchgate.session import scratch_folder
from batchgate.sources import files, landing
from batchgate.sources.jsonbatch import expand_json, pack_json, typed_entries
from batchgate.sources.normalise import land
from batchgate.sources.synthetic import dirty_rows, site_rows, write_control, write_site

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def row_count():
    return F.count(F.lit(1))


def written(table: DataFrame) -> DataFrame:
    """The table as files of the scratch area: what is behind it is evaluated once."""
    path = scratch_folder(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- row contract -------------------------------------------------------------------


@query
def reject_reasons(spark, sf_dir):
    return gates.reject_histogram(classified(spark, sf_dir))


@query
def quarantine_rows(spark, sf_dir):
    located = classified(spark, sf_dir).withColumn("line", F.col("event_id") + 2)
    return gates.quarantine(located)


@query
def accepted_rows(spark, sf_dir):
    rows = canonical(classified(spark, sf_dir), DEMO_KEY)
    return rows.where(F.col("reason").isNull()).drop("reason")


@query
def reject_ratio(spark, sf_dir):
    return gates.reject_ratio(classified(spark, sf_dir))


@query
def batch_summary(spark, sf_dir):
    """Accepted, duplicate and rejected rows per site of a batch that was sent twice."""
    # The copies are made of classified rows, and one grouping gives all counts.
    rows = canonical(classified(spark, sf_dir), DEMO_KEY).withColumn(
        "copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rejected = F.col("reason").isNotNull().alias("rejected")
    copies = rows.groupBy(*CANONICAL, rejected).agg(row_count().alias("n"))
    tallies = copies.groupBy("hospital").agg(
        F.sum("n").alias("input_rows"),
        F.sum(F.when(F.col("rejected"), F.col("n")).otherwise(0)).alias("rejected_rows"),
        F.count_if(~F.col("rejected")).alias("accepted_rows"))
    left = F.col("input_rows") - F.col("rejected_rows") - F.col("accepted_rows")
    return tallies.where("accepted_rows > 0").withColumn("duplicate_rows", left)


@query
def gate_report(spark, sf_dir):
    rows = written(canonical(classified(spark, sf_dir), DEMO_KEY))
    clean = written(rows.where(F.col("reason").isNull()).select(*CANONICAL).distinct())
    return gates.gate_report(rows, clean, SITES, 0.1)


@query
def strict_shape_rows(spark, sf_dir):
    """How many rows the plain-ASCII test covers, and that it never contradicts the contract."""
    rows = delivered(spark, sf_dir).withColumn(
        "strict", strict_shape(DEFAULT, FIRST_DAY, LAST_DAY))
    rows = classify(rows, FIRST_DAY, LAST_DAY)
    return rows.groupBy("hospital", "strict").agg(
        row_count().alias("rows"), F.count_if(F.col("reason").isNull()).alias("accepted"))


@query
def unit_conversion(spark, sf_dir):
    rows = delivered(spark, sf_dir)
    factor = unit_factor(F.col("unit"), DEFAULT.unit_factors)
    converted = contract_decimal(F.col("value"), *DEFAULT.value_range, factor)
    return rows.select("event_id", converted.alias("value"))


@query
def date_by_site_format(spark, sf_dir):
    """Order dates written in each site's format, every 13th in the other's, parsed back."""
    orders = read(spark, sf_dir, "orders")
    is_a = F.col("o_orderkey") % 2 == 0
    slashed = (F.col("o_orderkey") % 13 == 0) == is_a
    text = F.when(slashed, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = orders.select(
        "o_orderkey", F.when(is_a, "A").otherwise("B").alias("hospital"), text.alias("text"))
    parsed = site_date(F.col("text"), F.col("hospital"), DEFAULT.date_separators)
    return rows.select("o_orderkey", "hospital", parsed.alias("day"))


@query
def tokens(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    source = F.concat(F.lit("SYN-P-"), F.col("c_custkey").cast("string"))
    site = F.when(F.col("c_custkey") % 2 == 0, "A").otherwise("B")
    return customers.select("c_custkey", token(DEMO_KEY, site, "person", source).alias("person_id"))


@query
def token_namespaces(spark, sf_dir):
    """The same identifier under each site and kind: how many separate tokens there are."""
    users = read(spark, sf_dir, "events").select("user_id").distinct()
    source = F.concat(F.lit("SYN-P-"), F.col("user_id").cast("string"))
    kinds = [r.kind for r in DEFAULT.ids.values()]
    each = F.array(*[
        F.struct(F.lit(k).alias("kind"), token(DEMO_KEY, F.lit(s), k, source).alias("t"))
        for s in SITES for k in kinds])
    rows = users.select(F.inline(each))
    return rows.groupBy("kind").agg(F.count_distinct("t").alias("tokens"))


# --- duplicates, conflicts, references ------------------------------------------------


@query
def dedupe(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query
def duplicate_count(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    copies = rows.groupBy("l_orderkey", "l_linenumber").agg(row_count().alias("n"))
    return copies.agg(
        F.sum("n").alias("input_rows"), row_count().alias("distinct_rows"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"))


@query
def conflicting_keys(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").distinct()
    return gates.conflicting_keys(rows, ["l_orderkey", "l_linenumber"])


@query
def conflicting_attribute(spark, sf_dir):
    return gates.conflicting_values(read(spark, sf_dir, "lineitem"), ["l_partkey"], "l_suppkey")


@query
def conflicting_parent(spark, sf_dir):
    return gates.conflicting_values(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus")


def _children(spark, sf_dir):
    """Line items as measurements, finished orders as visits, solvent customers as patients.

    Every line item names the customer of its order, except that those returned name the
    supplier's number instead, which makes it another person's visit.
    """
    orders = read(spark, sf_dir, "orders").select(
        F.lit("A").alias("hospital"), F.col("o_orderkey").alias("visit_id"),
        F.col("o_custkey").alias("person_id"), "o_orderstatus")
    items = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("visit_id"), "l_suppkey", "l_linenumber", "l_partkey",
        "l_returnflag")
    person = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).otherwise(F.col("person_id"))
    measurements = items.join(orders.drop("o_orderstatus"), "visit_id").select(
        "hospital", "visit_id", person.alias("person_id"), "l_linenumber", "l_partkey")
    visits = orders.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    patients = read(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.lit("A").alias("hospital"), F.col("c_custkey").alias("person_id"))
    return measurements, visits, patients, ["hospital"], "visit_id", "person_id"


@query
def referential_orphans(spark, sf_dir):
    return gates.orphan_count(*_children(spark, sf_dir))


@query
def orphan_rows(spark, sf_dir):
    return gates.orphans(*_children(spark, sf_dir))


@query
def orphans_anti(spark, sf_dir):
    """Orders without a solvent customer."""
    customers = read(spark, sf_dir, "customer").where("c_acctbal >= 0")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query
def control_count_mismatch(spark, sf_dir):
    """Events per day against a sender's counts that miss the errors of every fifth day."""
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    lost = (F.dayofmonth("day") % 5 == 0) & (F.col("event_type") == "error")
    counts = events.groupBy("day").agg(row_count().alias("rows"))
    controls = events.groupBy("day").agg(F.count_if(~lost).alias("control_rows"))
    return gates.control_mismatch(counts, controls, ["day"])


@query
def sites_without_rows(spark, sf_dir):
    """Nations expected to deliver that have no indebted supplier."""
    expected = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("hospital"))
    rows = read(spark, sf_dir, "supplier").where("s_acctbal < 0").select(
        F.col("s_nationkey").alias("hospital"))
    return gates.missing_sites(rows, expected)


@query
def distinct_persons(spark, sf_dir):
    rows = canonical(classified(spark, sf_dir), DEMO_KEY).where(F.col("reason").isNull())
    return rows.groupBy("hospital").agg(F.count_distinct("person_id").alias("persons"))


# --- entities and digests ---------------------------------------------------------------


def _entity(table: str) -> Query:
    def run(spark, sf_dir):
        rows = canonical(classified(spark, sf_dir), DEMO_KEY).where(F.col("reason").isNull())
        return entity_rows(rows, table)

    return run


for _table in TABLES:
    QUERIES[f"entity_{_table.removesuffix('_snapshot')}"] = _entity(_table)


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "price", "day", "o_orderpriority")


def _order_text(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"), "o_orderpriority")


@query
def row_digest(spark, sf_dir):
    return _order_text(spark, sf_dir).select(
        "o_orderkey", row_hash(_ORDER_COLUMNS).alias("row_sha256"))


@query
def snapshot_digest(spark, sf_dir):
    orders = _order_text(spark, sf_dir)
    return tree_digest(orders.select(row_hash(_ORDER_COLUMNS).alias("h")))


@query
def lineitem_digest(spark, sf_dir):
    """A table large enough to need more than one level; its rows repeat, digests allow that."""
    columns = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    rows = read(spark, sf_dir, "lineitem").select(*columns)
    return tree_digest(rows.select(row_hash(columns).alias("h")))


@query
def digest_per_day(spark, sf_dir):
    orders = _order_text(spark, sf_dir)
    return tree_digest(orders.select("day", row_hash(_ORDER_COLUMNS).alias("h")), by=["day"])


@query
def late_arrival_digest(spark, sf_dir):
    """Baseline, a delivery whose signups are late, and the full resend in other order."""
    # The contract is evaluated once per row; each scenario takes the row's hash or leaves it.
    late = read(spark, sf_dir, "events").where("event_type = 'signup'").select(
        "event_id", F.lit(True).alias("late"))
    rows = canonical(classified(spark, sf_dir), DEMO_KEY, keep=("event_id",)).where(
        F.col("reason").isNull()).select("event_id", row_hash(CANONICAL).alias("h"))
    scenarios = F.array(F.lit("baseline"), F.lit("resent"),
                        F.when(F.col("late").isNull(), F.lit("delayed")))
    hashed = rows.join(late, "event_id", "left").select(
        F.explode(F.array_compact(scenarios)).alias("scenario"), "h")
    return tree_digest(hashed, by=["scenario"])


@query
def snapshot_diff_rows(spark, sf_dir):
    """Orders against a copy in which the high-value ones changed state."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_totalprice") > 400000, "F").otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"))
    return snapshot_diff(orders, changed)


@query
def snapshot_diff_tree(spark, sf_dir):
    """The same comparison by stored hash trees, of which only differing leaves are read."""
    orders = read(spark, sf_dir, "orders")
    keys = ("o_orderkey", "o_custkey")
    changed = F.when(F.col("o_totalprice") > 400000, "F").otherwise(F.col("o_orderstatus"))
    sides = (orders.select(*keys, "o_orderstatus"),
             orders.select(*keys, changed.alias("o_orderstatus")))
    folders = [scratch_folder(spark) for _ in sides]
    for table, folder in zip(sides, folders):
        write_tree(table, folder)
    return tree_diff(spark, *folders, sides[0])


# --- ledger, JSON, measures ---------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    """The last purchase of every user, with events as ledger rows."""
    ledger = read(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("ts").alias("recorded_at"),
        F.when(F.col("event_type") == "purchase", "COMMITTED").otherwise("FAILED").alias("status"))
    return stores.latest_runs(ledger, ["user_id"]).select("user_id", "event_id")


@query
def status_counts(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status")
    return stores.status_counts(orders)


@query
def json_field(spark, sf_dir):
    field = F.get_json_object("props", "$.k").cast("long")
    return read(spark, sf_dir, "events").select("event_id", field.alias("k"))


_ROW_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("day", DateType()),
    StructField("event_type", StringType()), StructField("value", DecimalType(18, 4)),
])


@query
def json_batch_rows(spark, sf_dir):
    """Events packed to JSON arrays of about a thousand rows and strictly expanded again."""
    events = read(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 1000).alias("batch"), "event_id",
        F.to_date("ts").alias("day"), "event_type",
        F.col("value").cast("decimal(18,4)").alias("value"))
    return expand_json(pack_json(events, "batch"), _ROW_SCHEMA).drop("batch")


@query
def json_batch_reasons(spark, sf_dir):
    """Events as JSON arrays in which some entries are damaged: entries by what is wrong with them."""
    value = F.col("value").cast("decimal(18,4)")
    fields = [F.to_date("ts").alias("day"), "event_type"]
    text = lambda *more: F.to_json(F.struct(*fields, *more))
    turn, number = F.col("event_id") % 50, F.col("event_id")
    entry = (
        F.when(turn == 7, text(number, value.cast("string").alias("value")))
        .when(turn == 8, text(value.alias("value")))
        .when(turn == 9, text(number.cast("string").alias("event_id"), value.alias("value")))
        .when(turn == 10, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(text(number, value.alias("value"))))
    batches = read(spark, sf_dir, "events").groupBy(
        F.floor(number / 1000).alias("batch")).agg(F.concat(
            F.lit("["), F.array_join(F.collect_list(entry), ","), F.lit("]")).alias("payload"))
    strict = StructType([StructField(f.name, f.dataType, f.name != "event_id")
                         for f in _ROW_SCHEMA])
    outcome = F.coalesce("reason", F.lit("ACCEPTED")).alias("outcome")
    return typed_entries(batches, strict).groupBy(outcome).agg(
        row_count().alias("entries"), F.count("position").alias("positions"),
        F.count("event_id").alias("ids"), F.sum("value").alias("total"))


@query
def metrics_json(spark, sf_dir):
    """Report of each site as JSON text, read back through its fields."""
    report = gates.reject_histogram(classified(spark, sf_dir)).groupBy("hospital").agg(
        F.sum("rows").alias("rejected_rows"))
    text = F.to_json(F.struct("hospital", "rejected_rows"))
    rows = report.select("hospital", text.alias("metrics_json"))
    return rows.withColumn(
        "rejected_rows", F.get_json_object("metrics_json", "$.rejected_rows").cast("long"))


@query
def median_duration(spark, sf_dir):
    """Exact median per event type; equal values are counted before they meet."""
    return medians(read(spark, sf_dir, "events"), "event_type", "value").select(
        "event_type", F.round("median", 4).alias("median_value"))


@query
def throughput(spark, sf_dir):
    """Rows per second and day, from the first to the last event of the day."""
    day = F.to_date("ts")
    spans = read(spark, sf_dir, "events").groupBy(day.alias("day")).agg(
        row_count().alias("rows"),
        (F.unix_micros(F.max(F.col("ts").cast("timestamp")))
         - F.unix_micros(F.min(F.col("ts").cast("timestamp")))).alias("micros"))
    rate = F.round(F.col("rows") * 1000000 / F.nullif(F.col("micros"), F.lit(0)), 6)
    return spans.select("day", "rows", rate.alias("rows_per_second"))


# --- audit --------------------------------------------------------------------------------


@query
def audit_expectations(spark, sf_dir):
    """The two snapshot suites on tables made from the accepted events."""
    rows = written(canonical(classified(spark, sf_dir), DEMO_KEY).where(F.col("reason").isNull()))
    tables = {t: written(entity_rows(rows, t))
              for t in ("measurement_snapshot", "patient_snapshot")}
    suites = expect.snapshot_suites(tables["measurement_snapshot"].count(), LAST_DAY.year)
    return expect.audit_rows(tables, suites).drop("position")


@query
def audit_lineitem(spark, sf_dir):
    """A suite that the line items break in several ways."""
    items = read(spark, sf_dir, "lineitem")
    suite = [
        expect.row_count(0), expect.unique("l_orderkey", "l_linenumber"),
        expect.not_null("l_orderkey"), expect.in_set("l_returnflag", ["A", "R"]),
        expect.between("l_quantity", 5, 40), expect.matches("l_linestatus", "^[O]$"),
    ]
    return expect.evaluate(items, "lineitem", suite).drop("position")


# --- delivered files ------------------------------------------------------------------------


def _lines(spark, folder):
    return landing.read_lines(spark, [landing.data_path(folder, s) for s in SITES])


@query
def csv_roundtrip(spark, sf_dir):
    """Events delivered as CSV files (quotes and commas included), read and classified."""
    folder = deliver_files(spark, delivered(spark, sf_dir, one_day=True))
    lines = _lines(spark, folder).withColumn("kind", landing.line_kind(F.col("value")))
    rows = typed_rows(lines, BATCH_DAY, DEMO_KEY, DEFAULT, ("kind",))
    outcome = F.coalesce("reason", F.lit("ACCEPTED")).alias("outcome")
    return rows.where("kind = 'row' AND NOT is_header").groupBy("hospital", outcome).agg(
        row_count().alias("rows"))


@query
def line_locator(spark, sf_dir):
    """Line numbers over all delivered files: no gap, none twice."""
    folder, scratch = deliver_files(spark, delivered(spark, sf_dir)), scratch_folder(spark)
    _lines(spark, folder).drop("value").write.parquet(scratch)
    numbered = landing.number_lines(spark.read.parquet(scratch))
    per_file = numbered.groupBy("hospital", "file").agg(
        row_count().alias("n"), F.min("line").alias("low"), F.max("line").alias("high"),
        F.sum("line").alias("total"))
    gapless = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (
        F.col("total") * 2 == F.col("n") * (F.col("n") + 1))
    return per_file.groupBy("hospital").agg(
        F.sum(F.col("n") - 1).alias("rows"), F.bool_and(gapless).alias("gapless"))


@query
def spanning_records(spark, sf_dir):
    """Delivered files in which some units hold line ends and quotes; rejects by reason."""
    rows = delivered(spark, sf_dir, one_day=True)
    broken = F.when(F.col("event_id") % 23 == 0, F.concat("unit", F.lit('\n"x",\n'))).otherwise(
        F.col("unit"))
    folder = deliver_files(spark, rows.withColumn("unit", broken))
    found = stage(spark, landing.list_delivery(spark, folder, SITES), folder, BATCH_DAY, DEMO_KEY,
                  DEFAULT, scratch_folder(spark))
    return found.rejected.groupBy("hospital", "reason").agg(
        row_count().alias("rows"), F.count_distinct("file", "line").alias("locators"))


@query
def located_rejects(spark, sf_dir):
    """The rows that the rejects' locators point at, in files numbered by themselves."""
    folder = deliver_files(spark, delivered(spark, sf_dir, one_day=True))
    found = stage(spark, landing.list_delivery(spark, folder, SITES), folder, BATCH_DAY, DEMO_KEY,
                  DEFAULT, scratch_folder(spark))
    name = F.regexp_extract(F.col("_metadata.file_path"), r"(hospital_[^/]+\.csv/[^/]+)\z", 1)
    whole = spark.read.text([landing.data_path(folder, s) for s in SITES], wholetext=True)
    numbered = whole.select(name.alias("file"), F.posexplode(F.split("value", "\n", -1)).alias(
        "at", "text")).select("file", (F.col("at") + 1).cast("long").alias("line"), F.substr(
            F.get(F.split("text", ","), F.lit(2)), F.lit(7)).try_cast("long").alias("event_id"))
    return found.rejected.join(numbered, ["file", "line"], "left").select(
        "hospital", "event_id", "reason")


@query
def delivery_fingerprint(spark, sf_dir):
    """Lines per site from the fingerprint scan; copied files keep it, one other value does not."""
    rows = delivered(spark, sf_dir)
    folder, copy = deliver_files(spark, rows), scratch_folder(spark)
    files.copy(spark, folder, copy)
    first = landing.input_fingerprint(spark, folder, SITES)
    same = first == landing.input_fingerprint(spark, copy, SITES)
    last = rows.agg(F.max("event_id")).first()[0]
    other = F.when(F.col("event_id") == last, F.lit("0.25")).otherwise(F.col("value"))
    changed = deliver_files(spark, rows.withColumn("value", other))
    seen = first != landing.input_fingerprint(spark, changed, SITES)
    for gone in (copy, changed):
        files.delete_tree(spark, gone)
    blocks = landing.line_counts(_lines(spark, folder), ("hospital", "file", "block"))
    return blocks.groupBy("hospital", "file").agg(F.sum("lines").alias("lines")).groupBy(
        "hospital").agg(
        F.sum(F.col("lines") - 1).alias("rows"), F.lit(same).alias("unchanged"),
        F.lit(seen).alias("change_seen"))


@query
def control_files(spark, sf_dir):
    """Control files of the delivery against the rows in its data files; one site announces
    fewer."""
    rows = delivered(spark, sf_dir)
    folder = deliver_files(spark, rows)
    fewer = rows.where(F.col("hospital") == SITES[-1]).where("event_id % 7 <> 0").count()
    files.delete_tree(spark, landing.control_path(folder, SITES[-1]))
    write_control(spark, folder, SITES[-1], fewer)
    controls = landing.read_controls(spark, [landing.control_path(folder, s) for s in SITES])
    header = ",".join(DEFAULT.columns)
    counts = _lines(spark, folder).where(F.col("value") != header).groupBy("hospital").agg(
        row_count().alias("rows"))
    return counts.join(controls, "hospital").select(
        "hospital", "rows", F.col("control_rows").cast("long").alias("control_rows"))


@query
def landed_records(spark, sf_dir):
    """Records that pass the landing step, by site and unit."""
    folder, target = deliver_files(spark, delivered(spark, sf_dir)), scratch_folder(spark)
    land(spark, folder, target)
    lines = landing.with_fields(_lines(spark, target), DEFAULT.columns, ("hospital",))
    return lines.where(~F.col("is_header")).groupBy("hospital", "unit", "field_count").agg(
        row_count().alias("rows"))


@query
def generated_rows(spark, sf_dir):
    """Synthetic deliveries with one row per event and site, dirt included, classified."""
    numbers = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    rows = None
    for site in SITES:
        clean = site_rows(numbers, site, F.lit(BATCH_DAY))
        first = site_rows(numbers.agg(F.min("id").alias("id")), site, F.lit(BATCH_DAY))
        part = clean.unionByName(dirty_rows(first)).withColumn("hospital", F.lit(site))
        rows = part if rows is None else rows.unionByName(part)
    outcome = F.coalesce("reason", F.lit("ACCEPTED")).alias("outcome")
    return classify(rows, BATCH_DAY).groupBy("hospital", outcome).agg(
        row_count().alias("rows"), F.count_distinct("patient_id").alias("patients"))


# --- publishing -----------------------------------------------------------------------------


def _publish(spark, sf_dir, rows=None, store=None, times=1, **options):
    rows = delivered(spark, sf_dir, one_day=True) if rows is None else rows
    store = store or scratch_folder(spark)
    folder = deliver_files(spark, rows)
    try:
        for _ in range(times):
            report = run_batch(spark, folder, store, BATCH_DAY.isoformat(), max_reject_ratio=1.0,
                               **options)
    finally:
        files.delete_tree(spark, folder)
    return store, report


@query
def published_measurements(spark, sf_dir):
    store, _ = _publish(spark, sf_dir)
    return stores.snapshot(spark, store, "measurement_snapshot", BATCH_DAY.isoformat())


@query
def published_counts(spark, sf_dir):
    """Rows per published table of a delivery that was sent twice over."""
    rows = delivered(spark, sf_dir, one_day=True)
    store, _ = _publish(spark, sf_dir, rows.unionByName(rows))
    out = None
    for name in TABLES:
        row = stores.snapshot(spark, store, name).groupBy("batch_date", "hospital").agg(
            row_count().alias("rows")).withColumn("table", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query
def published_quarantine(spark, sf_dir):
    store, report = _publish(spark, sf_dir)
    rows = stores.quarantine_rows(spark, store, report["run_id"])
    return rows.groupBy("hospital", "reason").agg(
        row_count().alias("rows"), F.count_distinct("file", "line").alias("locators"))


@query
def publish_replay(spark, sf_dir):
    """The same delivery twice: the ledger shows two runs and one content digest."""
    store, _ = _publish(spark, sf_dir, times=2)
    ledger = stores.runs(spark, store)
    field = lambda f: F.get_json_object("metrics_json", f"$.{f}")
    return ledger.groupBy("status").agg(
        row_count().alias("runs"), F.count_distinct(field("snapshot_sha256")).alias("digests"),
        F.max(field("accepted_rows").cast("long")).alias("accepted_rows"),
        F.max(field("rejected_rows").cast("long")).alias("rejected_rows"))


@query
def publish_rollback(spark, sf_dir):
    """A run that fails after writing leaves the published rows as they were."""
    store, _ = _publish(spark, sf_dir)
    other = delivered(spark, sf_dir, one_day=True).withColumn("value", F.lit("6"))
    try:
        _publish(spark, sf_dir, other, store, fail_at="after_insert")
    except BatchError:
        pass
    failed = stores.runs(spark, store).where("status = 'FAILED'").count()
    rows = stores.snapshot(spark, store, "measurement_snapshot")
    return rows.groupBy("hospital").agg(
        row_count().alias("rows"), F.sum("value").alias("total"),
        F.lit(failed).cast("long").alias("failed_runs"))


@query
def gate_matrix(spark, sf_dir):
    """Broken deliveries of all events: the code that stops each, and what the ledger keeps."""
    rows = delivered(spark, sf_dir, one_day=True)
    whole = deliver_files(spark, rows)
    site = SITES[-1]
    many = rows.where(F.col("hospital") == site).count()
    data, control = (lambda f: landing.data_path(f, site)), (lambda f: landing.control_path(f, site))

    # Each case damages the one delivery in place, and its own files come back by renaming: no
    # copy of the rows goes through the driver.
    kept = lambda path: f"{path}.kept"

    def aside(path):
        files.replace_tree(spark, path, kept(path))

    def replaced(path, text):
        aside(path)
        files.write_new(spark, path, text)

    def header_only(folder):
        replaced(data(folder), ",".join(DEFAULT.columns) + "\n")
        aside(control(folder))
        write_control(spark, folder, site, 0)

    def one_short(folder):
        aside(control(folder))
        write_control(spark, folder, site, many - 1)

    def renamed(folder):
        mine = rows.where(F.col("hospital") == site).select(*DEFAULT.columns)
        aside(data(folder))
        write_site(spark, mine.withColumnRenamed("unit", "units"), folder, site)

    def undone(folder):
        for path in (data(folder), control(folder)):
            if files.exists(spark, kept(path)):
                files.replace_tree(spark, kept(path), path)

    cases = {
        "no data file": (lambda f: aside(data(f)), {}),
        "no control file": (lambda f: aside(control(f)), {}),
        "control in words": (lambda f: replaced(control(f), "many\n"), {}),
        "control one short": (one_short, {}),
        "other header": (renamed, {}),
        "header only": (header_only, {}),
        "too many rejects": (lambda f: None, {"max_reject_ratio": 0.01}),
        "other content": (lambda f: None, {"expected_fingerprint": "0" * 64}),
        "fails after writing": (lambda f: None, {"fail_at": "after_insert"}),
    }
    store, out = scratch_folder(spark), []
    for case, (damage, options) in cases.items():
        damage(whole)
        code = None
        try:
            run_batch(spark, whole, store, BATCH_DAY.isoformat(),
                      **({"max_reject_ratio": 1.0} | options))
        except BatchError as error:
            code = str(error)
        undone(whole)
        out.append((case, code))
    files.delete_tree(spark, whole)
    told = spark.createDataFrame(out, "case string, code string")
    ledger = stores.runs(spark, store).groupBy(F.col("error_code").alias("code")).agg(
        F.max("status").alias("status"), row_count().alias("runs"))
    seen = stores.snapshot(spark, store, "measurement_snapshot").count()
    return told.join(ledger, "code", "left").withColumn(
        "published_rows", F.lit(seen).cast("long"))


@query
def tampered_audit(spark, sf_dir):
    """The audit of a published day, and of the same day with a row gone and values out of range."""
    store, report = _publish(spark, sf_dir)
    day = BATCH_DAY.isoformat()
    before = audit(spark, store, day)
    run = [(report["run_id"], day)]
    table = stores.read_run(spark, store, "measurement_snapshot", run)
    first = table.agg(F.min("measurement_id")).first()[0]
    changed = written(table.where(F.col("measurement_id") != first).withColumn(
        "value", F.when(F.col("unit") == "mg/dL", F.lit(999999)).otherwise(F.col("value"))
        .cast("decimal(18,4)")).drop("batch_date"))
    changed.write.mode("overwrite").parquet(
        stores.run_path(store, "measurement_snapshot", report["run_id"], day))
    after = audit(spark, store, day)
    return spark.createDataFrame(
        [(state, found["success"], ",".join(sorted(found["failed"])))
         for state, found in (("published", before), ("tampered", after))],
        "state string, success boolean, failed string")
