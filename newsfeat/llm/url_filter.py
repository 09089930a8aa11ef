"""URL filters: explicit rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs. Features are all column expressions: lengths, depth,
digit ratio, entropy, parameter counts and statistics of the URL's suffixes.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import ascii_lower
from newsfeat.session import stored

#: The suffixes of a URL, from wide to narrow.
LEVELS = ("tld", "site", "section")
LEXICAL = ("url_chars", "host_chars", "path_chars", "depth", "labels", "digit_ratio", "hyphens", "entropy", "params",
           "has_fragment", "secure", "dot_file")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (host/path) that fits, or null. The rules are a short list the caller writes.

    A rule fits its host and all subdomains when the path starts with the rule's path.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules: dict[str, str]) -> Column:
    """The verdict of a rule string, null for none."""
    out = F.lit(None).cast("string")
    for name, verdict in rules.items():
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def entropy_of(text: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for empty text."""
    size = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size == 0, 0.0).otherwise(
        F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0)))


def lexical_features(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, the suffixes and the lexical features. A null url counts as empty."""
    text = F.coalesce(F.col(url), F.lit(""))
    df = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    size = F.size(labels)
    site = F.concat_ws(".", F.slice(labels, F.greatest(size - 1, F.lit(1)), 2))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    count = lambda pattern, of: F.length(of) - F.length(F.regexp_replace(of, pattern, ""))
    return df.withColumns({
        "tld": F.element_at(labels, -1), "site": site,
        "section": F.concat(site, F.lit("/"), F.coalesce(F.get(steps, F.lit(1)), F.lit(""))),
        "url_chars": F.length(text).cast("double"), "host_chars": F.length("host").cast("double"),
        "path_chars": F.length("path").cast("double"),
        "depth": F.size(F.filter(steps, lambda s: s != "")).cast("double"), "labels": size.cast("double"),
        "digit_ratio": count("[0-9]", text) / F.greatest(F.length(text), F.lit(1)),
        "hyphens": count("[-_]", F.col("host")).cast("double"), "entropy": entropy_of(F.col("host")),
        "params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "has_fragment": F.contains(text, F.lit("#")).cast("double"),
        "secure": text.startswith("https:").cast("double"),
        "dot_file": F.col("path").rlike(r"\.[A-Za-z0-9]+$").cast("double"),
    })


class UrlModel:
    """Trees and suffix statistics fitted on labelled URLs."""

    def __init__(self, trees, rates: dict[str, DataFrame], base: float):
        self.trees, self.rates, self.base = trees, rates, base

    def features(self, df: DataFrame, volumes: dict[str, DataFrame]) -> DataFrame:
        """Add each suffix's block rate among the labelled rows and its share of all rows."""
        for level in LEVELS:
            df = df.join(self.rates[level], level, "left").join(volumes[level], level, "left")
        return df.fillna({f"{level}_rate": self.base for level in LEVELS}
                         | {f"{level}_share": 0.0 for level in LEVELS})

    def judge(self, df: DataFrame, volumes: dict[str, DataFrame]) -> DataFrame:
        """Add `blocked`, 1.0 or 0.0, to rows that have the lexical features."""
        if self.trees is None:
            return df.withColumn("blocked", F.lit(float(self.base >= 0.5)))
        rows = _assembler().transform(self.features(df, volumes))
        return self.trees.transform(rows).withColumnRenamed("prediction", "blocked")


def _assembler() -> VectorAssembler:
    inputs = [*LEXICAL, *(f"{level}_{kind}" for level in LEVELS for kind in ("rate", "share"))]
    return VectorAssembler(inputCols=inputs, outputCol="url_features")


def suffix_volumes(featured: DataFrame) -> dict[str, DataFrame]:
    """Share of all rows for each suffix of each level, over every row."""
    out = {}
    counts = stored(featured.groupBy(*LEVELS).count(), "suffixes")
    total = counts.agg(F.sum("count")).first()[0] or 1
    for level in LEVELS:
        out[level] = counts.groupBy(level).agg((F.sum("count") / F.lit(total)).alias(f"{level}_share"))
    return out


def fit_url_model(labelled: DataFrame, volumes: dict[str, DataFrame], label: str = "label", max_rows: int = 20_000,
                  trees: int = 12, depth: int = 4, weight: float = 2.0) -> UrlModel:
    """Fit on labelled rows that have the lexical features; label 1 is block, 0 allow.

    Label balance and suffix rates count all labelled rows; rates are smoothed towards one half
    by `weight` rows. Only the trees are fitted on a part: at most `max_rows` distinct URLs with
    their row counts as weight, so the fit does not grow with the corpus. Both labels get the
    same total weight. Without labelled rows everything is allowed; with one label only, that
    label is the answer.
    """
    rows = labelled.select("url", *LEVELS, F.col(label).cast("double").alias("label"))
    counts = stored(rows.groupBy(*LEVELS, "label").count(), "labelled-suffixes")
    size, blocked = counts.agg(F.sum("count"), F.sum(F.col("label") * F.col("count"))).first()
    base = blocked / size if size else 0.0
    if not size or base in (0.0, 1.0):
        return UrlModel(None, {}, base)
    # both labels weigh the same, so a suffix nobody labelled says nothing
    counts = counts.withColumn(
        "w", F.col("count") * F.when(F.col("label") == 1, 0.5 / base).otherwise(0.5 / (1 - base)))
    rates = {level: stored(counts.groupBy(level).agg(
        ((F.sum(F.col("label") * F.col("w")) + 0.5 * weight) / (F.sum("w") + weight)).alias(f"{level}_rate")), "rates")
        for level in LEVELS}
    model = UrlModel(None, rates, 0.5)
    chosen = _fit_urls(rows, max_rows)
    total = dict(chosen.groupBy("label").agg(F.sum("rows")).collect())
    share = F.when(F.col("label") == 1, 0.5 / total[1.0]).otherwise(0.5 / total[0.0])
    chosen = lexical_features(chosen).withColumn("w", F.col("rows") * share * sum(total.values()))
    fit = _assembler().transform(model.features(chosen, volumes)).select("url_features", "label", "w")
    model.trees = GBTClassifier(featuresCol="url_features", labelCol="label", weightCol="w", maxIter=trees,
                                maxDepth=depth, seed=7).fit(fit)
    return model


def _fit_urls(rows: DataFrame, most: int) -> DataFrame:
    """url, label, rows: the distinct URLs with the smallest hashes, both labels alike as far as they reach.

    `rows` holds labels 0 and 1. The hash's first 12 bits are counted first, so the task that
    sorts gets about as many URLs as it keeps.
    """
    urls = rows.groupBy("url", "label").agg(F.count("*").alias("rows"))
    urls = stored(urls.withColumn("slot", F.shiftrightunsigned(F.xxhash64("url"), 52).cast("int")), "labelled-urls")
    slots = sorted(urls.groupBy("label", "slot").count().collect())
    sizes = {y: sum(n for label, _, n in slots if label == y) for y in (0.0, 1.0)}
    picked = []
    for y in (0.0, 1.0):
        quota = max(1, most // 2, most - sizes[1.0 - y])
        seen, until = 0, -1
        for label, slot, n in slots:
            if label == y and seen < quota:
                seen, until = seen + n, slot
        picked.append(urls.where((F.col("label") == y) & (F.col("slot") <= until))
                      .orderBy("slot", F.xxhash64("url"), "url").limit(quota))
    return stored(picked[0].unionByName(picked[1]).drop("slot"), "labelled")


def filter_urls(pages: DataFrame, rules: dict[str, str], max_rows: int = 20_000) -> DataFrame:
    """Judge every url: the longest fitting rule, else the trees learnt from the rule-labelled rows.

    Adds host, path, rule (null if none fits) and verdict (allow or block) to the columns of
    `pages`, one row per row. A null url or one without :// has empty host and path, no rule,
    and the trees' verdict on an empty URL. Repeated rows get equal verdicts. Columns of the
    input named like a feature are replaced in the work table only; the output has the input's
    columns but for host, path, rule and verdict.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    slim = pages.select(F.struct(*names).alias("_row"), F.col("url"))
    rows = lexical_features(slim).withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("_by_rule", rule_verdict(F.col("rule"), rules))
    volumes = suffix_volumes(rows)
    labelled = rows.where("_by_rule IS NOT NULL").withColumn("label", (F.col("_by_rule") == "block").cast("int"))
    model = fit_url_model(labelled.drop("_row"), volumes, max_rows=max_rows)
    verdict = F.coalesce("_by_rule", F.when(F.col("blocked") > 0.5, "block").otherwise("allow"))
    return model.judge(rows, volumes).select("_row.*", "host", "path", "rule", verdict.alias("verdict"))
