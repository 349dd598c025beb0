"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns
of ``documents``.  A stage's result is written as Parquet and read again as the next one's docs.

1. Language identification: documents without a language go.
2. Line dedup: lines whose template recurs across documents go, and documents of nothing else.
3. N-gram Jaccard join: of each group of near copies the document with the smallest id stays.
4. Benchmark decontamination: words in benchmark windows go, and documents of nothing else.
5. Best-fit packing: what is left, as pieces of packed sequences.

``n_chars`` follows the text wherever a stage changes it.  Of a group of near copies rows with an
id come before rows without one; rows that repeat an id, or null, with its text are one document
from the third stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.llm.common import ARROW_ROWS, fresh, quoted, staged, table
from batchgate.llm.decontamination import decontaminate
from batchgate.llm.language import identify
from batchgate.llm.line_dedup import without_templates
from batchgate.llm.ngram_join import near_duplicate_groups
from batchgate.llm.packing import op1_best_fit_packing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found."""
    judged = identify(docs)
    rejected = judged.columns[-1]
    return judged.where(~quoted(rejected)).select(*map(quoted, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across documents."""
    cut = without_templates(docs)
    changed = quoted(cut.columns[-1]) > 0
    return cut.where(~changed | (F.col("text") != "")).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(
            F.col("n_chars"))).select(*map(quoted, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    names = [fresh(docs, n) for n in ("no_id", "id", "text_hash")]
    parts = dict(zip(names, (F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"))))
    # Rows without an id come last in a group, and texts tell them apart.
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, F.struct(*[c.alias(n) for n, c in parts.items()]))
    groups = staged(near_duplicate_groups(keyed, id_col=key))
    gone = groups.where("doc_id <> component_id").select("doc_id.*").distinct()
    same = [parts[n].eqNullSafe(gone[n]) for n in names]
    kept = docs.join(gone.hint("merge"), same, "left_anti")  # one plan at every size
    if groups.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that stand in benchmark windows."""
    length = fresh(docs, "length_before")
    before = docs.withColumn(length, F.length("text"))
    after = decontaminate(before, table(spark, sf_dir, "benchmark"))
    changed = F.coalesce(F.length("text") != F.col(length), F.lit(False))
    words = F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    return after.where(~changed | words).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(
            F.col("n_chars"))).select(*map(quoted, docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences."""
    return op1_best_fit_packing(docs)


def _small_batches(stage):
    """Rows with long texts travel to Python in small batches."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES = [(name, _small_batches(stage)) for name, stage in (
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
)]

# Trained and tokenising stages have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else staged(out)
    return docs
