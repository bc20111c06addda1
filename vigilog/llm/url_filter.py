"""Allow or block URLs: rules by host and path, boosted trees for the rest."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.text import lower_ascii
from vigilog.session import durable

# The rules, as host and path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
TRAINING_ROWS = 20_000
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "hyphens",
            "secure", "fragment", "suffix_rate", "suffix_known")


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule(host_name: Column, path_name: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct (verdict, rule), or null. A rule fits its host and its
    subdomains where the path starts with its own."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host_name == name) | host_name.endswith("." + name)) & path_name.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(text).alias("rule"))).otherwise(found)
    return found


def suffix(host_name: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host_name, ".", -1)


def entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text."""
    n = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: (n - F.length(F.replace(text, c))).cast("double") / n)
    return F.when(n > 0, -F.aggregate(shares, F.lit(0.0), lambda total, p: total + F.when(p > 0, p * F.log2(p)).otherwise(0.0))) \
        .otherwise(0.0)


def lexical(url: Column, host_name: Column, path_name: Column) -> dict[str, Column]:
    """Features of the URL's text. A null URL has those of an empty one."""
    url = F.coalesce(url, F.lit(""))
    n = F.length(url)
    return {
        "length": n, "host_length": F.length(host_name), "path_length": F.length(path_name),
        "depth": F.size(F.split(path_name, "/")), "labels": F.size(F.split(host_name, r"\.")),
        "digits": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")).cast("double") / n).otherwise(0.0),
        "entropy": entropy(url),
        "parameters": F.when(F.locate("?", url) > 0, 1 + F.regexp_count(url, F.lit("&"))).otherwise(0),
        "hyphens": F.regexp_count(url, F.lit("-")), "secure": url.startswith("https").cast("int"),
        "fragment": (F.locate("#", url) > 0).cast("int")}


def class_bounds(per: dict, most: int) -> dict:
    """Rows of each of two classes to learn from: all, or ``most`` in proportion with a twentieth for the rare one at least."""
    if sum(per.values()) <= most:
        return per
    rare = min(per, key=per.get)
    own = min(per[rare], max(1, most // 20, most * per[rare] // sum(per.values())))
    return {c: own if c == rare else min(n, most - own) for c, n in per.items()}


def class_samples(rows: DataFrame, per: dict, most: int) -> DataFrame:
    """So many rows of each ``label``, by a hash of page_id and URL: never none of a class, and never more than the bound."""
    parts = None
    for label, bound in class_bounds(per, most).items():
        mine = rows.where(F.col("label") == label)
        if bound < per[label]:
            by = F.xxhash64("page_id", "url")
            limit = int((1.5 * bound + 500) / per[label] * (1 << 62))
            some = mine.where(F.pmod(by, F.lit(1 << 62)) < F.lit(min(limit, 1 << 62)))  # so that few rows are sorted
            if some.limit(bound).count() == bound:  # fewer only if a few pages with very many copies are the class
                mine = some
            mine = mine.orderBy(by).limit(bound)
        parts = mine if parts is None else parts.union(mine)
    return parts


def judge(pages: DataFrame, rules=RULES, training_rows: int = TRAINING_ROWS, seed: int = 11) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` (of block).

    URLs that a rule fits take its verdict, and they are the labels: a bounded
    sample of each class (``training_rows`` in all, by a hash of page_id and URL) trains gradient-boosted
    trees, which judge the others. Share of blocked URLs per host suffix is counted
    over all labelled rows. Without two labelled classes there is nothing to learn:
    others get the one class there is, or allow. Null URLs, and those without
    ``://``, have empty host and path and are judged by the trees. Repeated
    rows are judged each. Other columns are not read.
    """
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    parsed = parsed.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))) \
        .withColumn("found", rule(F.col("host"), F.col("path"), rules)) \
        .withColumn("suffix", suffix(F.col("host")))
    for name, value in lexical(F.col("url"), F.col("host"), F.col("path")).items():
        parsed = parsed.withColumn(name, value.cast("double"))
    parsed = durable(parsed, "urls")
    known = parsed.where("found is not null").withColumn("label", (F.col("found.verdict") == "block").cast("double"))
    rates = known.groupBy("suffix").agg(
        ((F.sum("label") + 0.5) / (F.count("*") + 1)).alias("suffix_rate"), F.count("*").cast("double").alias("suffix_known"))
    rows = parsed.join(rates, "suffix", "left").fillna({"suffix_rate": 0.5, "suffix_known": 0.0}) \
        .withColumn("suffix_known", (F.col("suffix_known") > 0).cast("double"))
    per = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(per) < 2:
        only = float(*per) if per else 0.0
        scored = rows.withColumn("score", F.lit(only))
    else:
        labelled = rows.where("found is not null").withColumn("label", (F.col("found.verdict") == "block").cast("double"))
        sample = class_samples(labelled.select("page_id", "url", "label", *FEATURES), per, training_rows)
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(maxDepth=4, maxIter=10, stepSize=0.3, seed=seed, maxBins=32, cacheNodeIds=False)
        sample = durable(sample.select("label", *FEATURES), "labelled")
        model = trees.fit(vectors.transform(sample).select("features", "label"))
        scored = model.transform(vectors.transform(rows)) \
            .withColumn("score", vector_to_array("probability").getItem(1))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", own).alias("verdict"),
                         F.coalesce((F.col("found.verdict") == "block").cast("double"), "score").alias("score"))
