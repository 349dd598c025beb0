"""URL filters: exact rules, and gradient-boosted trees on lexical features for the rest.

A rule is a host and a path and fits that host and its subdomains where the path starts with the
rule's; the longest fitting rule decides.  Other URLs are judged by boosted trees over how the URL
is written: lengths, depth, ratios of digits and other characters, character entropy, numbers of
parameters, and the suffix's share of blocked URLs among the labelled ones, smoothed.  The trees
learn from shares that leave a URL's own fold out, so a share never tells them the URL's label.

The trees are trained from labelled URLs, of which at most TRAIN_ROWS of either label, those with
the smallest hashes, are used.  ``labelled_by_words`` makes labels from a short list of words
that name unwanted sites, as whole words of a host: between dots, hyphens, underscores, digits or
the host's ends, so that "ads" is no word of "downloads"; the trees see no words, only features, so they carry over to hosts
whose names the list does not hold.

Cases: a null URL and one without ``://`` have an empty host and path, fit no rule and are judged
by their features like others (null as empty); repeated rows get the same result each; with
labels of fewer than two kinds the only kind is the verdict, ``allow`` if there is none; an
empty table gives an empty result; other columns are carried along by ``judge``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import bounded_sample, fresh, quoted

# Fixed values of the task: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TRAIN_ROWS = 5_000
TREES, DEPTH, SEED = 20, 4, 7
# Suffix shares: folds of the labelled URLs, and URLs' worth of the overall share in each.
FOLDS, SMOOTHING = 5, 10
# Words of a host that label its URLs as unwanted.
UNWANTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, of_host, of_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(
            path, F.lit(of_path))
        rule = F.when(fits, of_host + of_path).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _share(text: Column, pattern: str) -> Column:
    kept = F.length(F.regexp_replace(text, pattern, ""))
    return F.when(F.length(text) > 0, 1 - kept / F.length(text)).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.filter(F.split(text, ""), lambda c: F.length(c) > 0)
    size = F.greatest(F.length(text), F.lit(1))
    terms = F.transform(F.array_distinct(letters), lambda c: (
        F.size(F.filter(letters, lambda x: x == c)) / size))
    return F.aggregate(terms, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def features(url: Column) -> dict[str, Column]:
    """Numbers that describe how a URL is written."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": F.length(F.regexp_replace(path, "[^/]", "")).cast("double"),
        "labels": (F.length(F.regexp_replace(host, "[^.]", "")) + 1).cast("double"),
        "hyphens": F.length(F.regexp_replace(host, "[^-]", "")).cast("double"),
        "host_digits": _share(host, "[0-9]"),
        "path_digits": _share(path, "[0-9]"),
        "vowels": _share(host, "[aeiou]"),
        "parameters": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(
            0).cast("double"),
        "query_length": F.length(query).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "entropy": _entropy(host),
    }


def suffix_of(url: Column) -> Column:
    """The host's last label."""
    return F.substring_index(host_of(F.coalesce(url, F.lit(""))), ".", -1)


def labelled_by_words(urls: DataFrame, url_col: str = "url",
                      words: tuple[str, ...] = UNWANTED_WORDS) -> DataFrame:
    """url and label (1: unwanted) of all distinct non-null URLs."""
    host = host_of(F.col("url"))
    named = F.rlike(host, F.lit(rf"(?:\A|[._0-9-])(?:{'|'.join(words)})(?:\z|[._0-9-])"))
    return urls.select(quoted(url_col).alias("url")).where("url is not null").distinct().select(
        "url", named.cast("int").alias("label"))


class UrlModel:
    """Trees and suffix shares fitted on a bounded sample of labelled URLs."""

    def __init__(self, labelled: DataFrame, rows: int = TRAIN_ROWS):
        """``labelled`` has columns url and label (0 or 1)."""
        chosen = [bounded_sample(labelled.where(F.col("label") == k).select("url", "label"),
                                 ["url"], rows) for k in (0, 1)]
        # At most 2 * rows short rows, held by the driver so that both uses see the same.
        kept = [(r.url, int(r.label)) for part in chosen for r in part.collect()]
        self.kinds = sorted({k for _, k in kept})
        self.suffixes: dict[str, float] = {}
        self.model = None
        if len(self.kinds) < 2:
            return
        spark = labelled.sparkSession
        sample = spark.createDataFrame(kept, "url string, label int").coalesce(1)
        prior = sum(k for _, k in kept) / len(kept)
        counted = sample.groupBy(suffix_of(F.col("url")).alias("s")).agg(
            F.count("*").alias("n"), F.sum("label").alias("k")).collect()
        self.suffixes = {r.s: self._smoothed(r.k, r.n, prior) for r in counted}
        self.prior = prior
        frame = self._assembled(self._folded(sample), "url", F.col("share"))
        self.model = GBTClassifier(
            featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
            maxMemoryInMB=64, cacheNodeIds=False).fit(frame)

    @staticmethod
    def _smoothed(unwanted, urls, prior):
        return (unwanted + SMOOTHING * prior) / (urls + SMOOTHING)

    def _folded(self, sample: DataFrame) -> DataFrame:
        """Labelled URLs with their suffix's share in the other folds."""
        suffix, fold = suffix_of(F.col("url")), F.pmod(F.xxhash64("url"), F.lit(FOLDS))
        whole, own = Window.partitionBy("s"), Window.partitionBy("s", "fold")
        rest = lambda c: F.sum(c).over(whole) - F.sum(c).over(own)
        share = self._smoothed(rest("label"), rest(F.lit(1)), F.lit(self.prior))
        return sample.withColumns({"s": suffix, "fold": fold}).select(
            "url", F.col("label").cast("double").alias("label"), share.alias("share"))

    def _assembled(self, frame: DataFrame, url_col: str, share: Column | None = None) -> DataFrame:
        """Add the features' vector; the suffix's share is that of all folds if none is given."""
        if share is None:
            share = F.lit(self.prior)
            pairs = [F.lit(x) for item in self.suffixes.items() for x in item]
            share = F.coalesce(F.try_element_at(
                F.create_map(*pairs), suffix_of(quoted(url_col))), share)
        columns = features(quoted(url_col)) | {"suffix_share": share}
        frame = frame.withColumn("f", F.struct(*[c.alias(n) for n, c in columns.items()]))
        frame = frame.select("*", "f.*").drop("f")
        return VectorAssembler(inputCols=list(columns), outputCol="x").transform(frame)

    def with_verdict(self, frame: DataFrame) -> DataFrame:
        """Add ``verdict`` by the column url."""
        if self.model is None:
            return frame.withColumn(
                "verdict", F.lit("block" if self.kinds == [1] else "allow"))
        scored = self.model.transform(self._assembled(frame, "url"))
        return scored.select(*frame.columns, F.when(
            F.col("prediction") > 0.5, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, model: UrlModel, rules=RULES, url_col: str = "url") -> DataFrame:
    """All columns, and host, path, rule and verdict; names that clash get underscores."""
    names = {n: fresh(pages, n) for n in ("host", "path", "rule", "verdict")}
    whole = F.struct(*[quoted(c) for c in pages.columns]).alias("r")
    held = pages.select(whole, quoted(url_col).alias("url"))
    judged = model.with_verdict(held)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    out = judged.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    out = out.select("r.*", F.col("host").alias(names["host"]), F.col("path").alias(names["path"]),
                     rule.alias(names["rule"]),
                     F.coalesce(verdict, F.col("verdict")).alias(names["verdict"]))
    return out


def op4_url_filters(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    rows = pages.select("page_id", "url")
    return judge(rows, UrlModel(labelled_by_words(rows))).select(
        "page_id", "host", "path", "rule", "verdict")
