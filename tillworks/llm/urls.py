"""URL filtering by fixed host and path rules, and by association rules mined from labelled URLs.

A URL is a set of tokens: the labels of its host, the words of its path, its query parameters. Spark's FP-growth finds token
combinations that are frequent among labelled URLs, with the label as one more item; those that come with a bad label often
enough (confidence) and in enough URLs (support) are rules. To match, each rule is filed under its rarest token, URL tokens
are joined with that index, and the rules found are tested against the whole URL. A fixed rule goes before a mined one.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import stored, unused

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 10, 0.6
MAX_LABELLED, MAX_ITEMS = 200_000, 16
BAD = "label:bad"


def host(url: Column) -> Column:
    """Between the first :// and the next of / ? # or the end, A-Z in lower case; empty without :// or for null."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...], value: int) -> Column:
    """Text (value 0) or verdict (1) of the longest rule that fits: its host is the URL's or a parent domain of it, and the
    URL's path starts with its path. Null if none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule[0].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule[value]).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """The set of a URL's tokens. Digits count as 0, so that numbers of equal length are one token."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))

    def words(text: Column, separators: str, kind: str) -> Column:
        parts = F.split(F.regexp_replace(F.lower(text), "[0-9]", "0"), separators)
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    parts = words(host(url), r"\.", "host:"), words(path(url), r"[/._-]", "path:"), words(query, "&", "query:")
    return F.array_distinct(F.concat(*parts))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE, max_labelled: int = MAX_LABELLED, max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Rules as ``anchor`` (rarest token), ``antecedent``, ``confidence`` and ``support`` from ``url`` and ``bad`` (boolean).

    At most ``max_labelled`` rows, chosen by a hash of all columns but ``bad``, are used. Combinations are sought among each
    URL's ``max_items`` frequent tokens whose share of bad URLs differs most from the average, and then counted in all
    tokens. A rule needs ``min_count`` bad URLs at least, whatever their share. Null URLs or
    labels are not used. Without bad URLs there are no rules.
    """
    spark = labelled.sparkSession
    known = labelled.where("url is not null and bad is not null")
    known = known.orderBy(F.xxhash64(*(c for c in known.columns if c != "bad")), "url", "bad").limit(max_labelled)
    known = stored(known.select(F.monotonically_increasing_id().alias("id"), "bad", tokens(F.col("url")).alias("items")), "labelled-urls")
    n, n_bad = known.agg(F.count("*"), F.count_if("bad")).first()
    none = spark.createDataFrame([], "anchor string, antecedent array<string>, confidence double, support double")
    if not n_bad:
        return none
    min_support = max(min_support, min(min_count / n, 1.0))
    least = min_support * n
    each = known.select("id", "bad", F.explode("items").alias("item"))
    weights = each.groupBy("item").agg(F.count("*").alias("n"), (F.count_if("bad") / F.count("*") - n_bad / n).alias("shift"))
    weights = weights.where(F.col("n") >= least)
    ranked = each.join(weights, "item").groupBy("id", "bad").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.abs("shift")).alias("w"), "item"))), 1, max_items).alias("top")
    )
    baskets = ranked.select(F.concat("top.item", F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array())).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(stored(baskets, "baskets"))
    sets = stored(found.freqItemsets.select(F.array_sort("items").alias("items")), "itemsets")
    bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("antecedent"))
    rare = bad.select("antecedent", F.explode("antecedent").alias("item")).join(weights, "item")
    rare = rare.groupBy("antecedent").agg(F.min_by("item", F.struct("n", "item")).alias("anchor"))
    held = known.select("bad", "items", F.explode("items").alias("anchor")).join(rare, "anchor")
    held = held.where(F.size(F.array_except("antecedent", "items")) == 0)
    rules = held.groupBy("anchor", "antecedent").agg(F.count("*").alias("n"), F.count_if("bad").alias("both"))
    rules = rules.withColumn("confidence", F.col("both") / F.col("n")).where(F.col("confidence") >= min_confidence)
    return stored(rules.select("anchor", "antecedent", "confidence", (F.col("both") / F.lit(float(n))).alias("support")), "url-rules")


def judged(urls: DataFrame, mined: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """All columns of a stored table with ``url`` and ``host``, ``path``, ``rule`` (fixed, else null), ``confidence`` (of the
    strongest mined rule that fits, else null) and ``verdict``: that of the fixed rule, else block if a mined rule fits, else
    allow. Columns of these names are replaced. Null URLs have empty host and path and fit nothing."""
    name = unused(urls, "row_id")
    rows = urls.withColumn(name, F.monotonically_increasing_id())
    items = rows.select(name, tokens(F.coalesce("url", F.lit(""))).alias("items"))
    each = items.select(name, "items", F.explode("items").alias("anchor"))
    fits = each.join(mined, "anchor").where(F.size(F.array_except("antecedent", "items")) == 0)
    fits = stored(fits.groupBy(name).agg(F.max("confidence").alias("confidence")), "matched-urls")
    kept = [c for c in rows.columns if c not in ("host", "path", "rule", "confidence", "verdict")]
    parted = rows.select(*kept, host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).join(fits, name, "left")
    mined_verdict = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    where = F.col("host"), F.col("path")
    return parted.withColumns(
        {"rule": fixed_rule(*where, rules, 0), "verdict": F.coalesce(fixed_rule(*where, rules, 1), mined_verdict)}
    ).drop(name)


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``bad`` (toxic or of low quality) of the pages whose id has a label."""
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return pages.select("page_id", "url").join(known, F.col("page_id") == F.col("doc_id")).select("page_id", "url", "bad")
