"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for other URLs.

A rule is a host and the start of a path. It fits its host and all subdomains of it, and the longest rule
that fits decides. URLs that no rule fits are judged by trees that were trained on the URLs that rules
decide: length, depth, digit ratio, entropy, numbers of parameters and labels, and how often the URL's
top-level domain, registered domain and first path part were blocked among the labelled ones.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by the trees
like others. Without labelled URLs every other URL is allowed; with labels of one kind all get that one.
Repeated rows are judged alike. Other columns do not matter, whatever their names.

The domain statistics count all labelled rows; a row that the trees learn from gets its rates from the other ``FOLDS``
folds, so that its own label is not in them. (To leave out the one label alone would tell it.) The
trees alone are fitted on at most about ``sample_rows`` labelled rows, chosen by a hash. Statistics of up to
``BROADCAST_SUFFIXES`` suffixes are broadcast, more are joined with their hot ones apart. Rules are part of the configuration.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import col, join_groups
from tablewarden.session import materialize

SAMPLE_ROWS = 20_000
BROADCAST_SUFFIXES = 200_000
FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "query_length", "labels",
    "hyphens", "top_rate", "domain_rate", "section_rate",
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"), Rule("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased and the path; both empty for null and without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    known = F.instr(url, "://") > 0
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def decide(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def lexical(df: DataFrame) -> DataFrame:
    """Columns ``url host path`` to features. Entropy is of the characters, in bits."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    characters = F.filter(F.split(url, ""), lambda c: c != "")
    share = F.transform(F.array_distinct(characters), lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = -F.aggregate(share, F.lit(0.0), lambda total, p: total + p * F.log2(p))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(F.col("host"), r"\.")
    return df.withColumns({
        "length": n.cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.regexp_count(F.col("path"), F.lit("/")).cast("double"),
        "digit_ratio": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "parameters": F.regexp_count(query, F.lit("=")).cast("double"),
        "query_length": F.length(query).cast("double"),
        "labels": F.size(labels).cast("double"),
        "hyphens": F.regexp_count(F.col("host"), F.lit("-")).cast("double"),
        "top": F.element_at(labels, -1),
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
        "section": F.split_part("path", F.lit("/"), F.lit(2)),
    })


def fold() -> Column:
    """The fold of a labelled URL; equal URLs share one."""
    return F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")


class UrlModel:
    """Trees and suffix statistics; ``fit`` needs columns ``url host path label`` (1 is block).

    The statistics, (suffix, blocked, n) per top-level and registered domain and section, count all labelled rows, also by fold;
    only the trees are fitted on a sample.
    """

    def __init__(self, trees, prior: float, rates: dict[str, DataFrame], labelled: int):
        self.trees, self.prior, self.rates, self.labelled = trees, prior, rates, labelled

    @classmethod
    def fit(
        cls, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, rounds: int = 12, depth: int = 4, seed: int = 7
    ) -> UrlModel:
        by_fold = [f for k in range(FOLDS) for f in (
            F.coalesce(F.sum(F.when(fold() == k, F.col("label"))), F.lit(0)).alias(f"blocked_{k}"), F.count_if(fold() == k).alias(f"n_{k}"))]
        counts = [F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"), *by_fold]
        domains = materialize(lexical(labelled).groupBy("domain", "top").agg(*counts), "url-domain")
        n, blocked = domains.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("blocked")).first()
        if not n or blocked in (0, n):
            return cls(None, float(bool(blocked)), {}, n)
        names = [c for c in domains.columns if c not in ("domain", "top")]
        tops = materialize(domains.groupBy("top").agg(*[F.sum(c).alias(c) for c in names]), "url-top")
        sections = materialize(lexical(labelled).groupBy("section").agg(*counts), "url-section")
        model = cls(None, blocked / n, {"top": tops, "domain": domains.drop("top"), "section": sections}, n)
        rows = materialize(lexical(sample(labelled, sample_rows)), "url-sample")
        trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed)
        fitted = model.assembled(rows, counted=True)
        model.trees = trees.fit(fitted.select("features", F.col("label").cast("double").alias("label")).coalesce(4))
        return model

    def assembled(self, rows: DataFrame, counted: bool = False) -> DataFrame:
        """Feature vectors; the suffix rates of rows that were ``counted`` leave out their own fold."""
        for c, table in self.rates.items():
            folds = F.array(*[F.struct(F.col(f"blocked_{k}").alias("b"), F.col(f"n_{k}").alias("n")) for k in range(FOLDS)])
            table = table.select(c, F.col("blocked").alias("__blocked"), F.col("n").alias("__n"), folds.alias("__folds"))
            if table.count() <= BROADCAST_SUFFIXES:
                rows = rows.join(F.broadcast(table), c, "left")
            else:
                rows = join_groups(materialize(rows, "url-rows"), table, [c], "__n", self.labelled)
            own = F.get("__folds", fold())
            less, rest = (own["b"], own["n"]) if counted else (F.lit(0), F.lit(0))
            known = (F.col("__blocked") - less + 4 * self.prior) / (F.col("__n") - rest + 4)
            rows = rows.withColumn(f"{c}_rate", F.coalesce(known, F.lit(self.prior))).drop("__blocked", "__n", "__folds")
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)

    def block_probability(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with columns url, host, path) and ``blocked``, the probability of block."""
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(self.prior))
        scored = self.trees.transform(self.assembled(lexical(rows)))
        return scored.select(*rows.columns, vector_to_array("probability")[1].alias("blocked"))


def sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at most, the same in every run: those with the lowest hashes of all columns."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(1_000_000)) < int(1_000_000 * most / n))


def judge(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per row: page_id, url, host, path, rule, verdict and the trees' probability of block."""
    host, path = host_and_path(col(url))
    rows = df.select(col(key).alias("page_id"), col(url).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = decide(rules, F.col("host"), F.col("path"))
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    labelled = rows.where("rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("int"))
    model = UrlModel.fit(labelled.select("page_id", "url", "host", "path", "label"), sample_rows)
    by_trees = F.when(F.col("blocked") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return model.block_probability(rows).select(
        "page_id", "url", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "blocked")
