"""URL filter: host and path rules, and a logistic regression for the rest.

The regression reads hashed character n-grams of host and path and is trained
from a small labelled URL table; training and scoring are DataFrame operations.
Rules are expressions: a rule fits its host and all subdomains if the path
starts with the rule's, and the longest that fits decides.

Defined cases: a null url, or one without ``://``, has empty host and path, fits
no rule and is judged by the regression's constant term.  A url without any path
does not start with a rule's path.  Repeated rows are judged alike; other columns
are not read.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import lower_ascii
from jobtide.llm.labelled_urls import labelled_urls as labelled_rows

#: host and path of each rule, and what it says.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}

GRAMS = (3, 4)
BUCKETS = 1 << 14


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: str = "host", path: str = "path", rules: dict[str, str] | None = None) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules or RULES, key=len):
        name, start = rule.split("/", 1)
        fits = (F.col(host) == name) | F.col(host).endswith(f".{name}")
        found = F.when(fits & F.col(path).startswith(f"/{start}"), F.lit(rule)).otherwise(found)
    return found


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``name, host, path, label`` of the labelled table."""
    return spark.createDataFrame(labelled_rows(), "name string, host string, path string, label double")


def with_features(urls: DataFrame) -> DataFrame:
    """Adds ``features`` from ``host`` and ``path``: counts of hashed n-grams."""
    line = F.concat(F.lit("^"), F.col("host"), F.lower("path"), F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(line) - n + 1)
        found = F.transform(starts, lambda i: F.substring(line, i, F.lit(n)))
        return F.when(F.length(line) >= n, found).otherwise(F.array().cast("array<string>"))

    grams = [of_length(n) for n in GRAMS]
    hashed = HashingTF(numFeatures=BUCKETS, inputCol="grams", outputCol="features")
    return hashed.transform(urls.withColumn("grams", F.concat(*grams))).drop("grams")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """``labelled``: ``host, path, label`` (1: block)."""
    fitted = LogisticRegression(maxIter=100, regParam=0.0003, standardization=False, probabilityCol="probability")
    return fitted.fit(with_features(labelled).select("features", "label").coalesce(1))


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: dict[str, str] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict``."""
    rules = rules or RULES
    host, path = host_and_path()
    parts = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    scored = model.transform(with_features(parts))
    said = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair))
    by_model = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.withColumn("rule", rule_of(rules=rules)).select(
        "page_id", "host", "path", "rule", F.coalesce(said[F.col("rule")], by_model).alias("verdict")
    )
