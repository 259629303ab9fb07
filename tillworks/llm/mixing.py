"""Mixing sources to target weights: complete epochs of each source, then Efraimidis-Spirakis sampling of the rest.

A document's key is -ln(u) / weight, where u is a hash of its id and text and the weight its quality: the documents with
the smallest keys of a source are a weighted sample without replacement. They are taken in key order until the source's
budget of words is used up; the last one is taken if that ends nearer to the budget.

Nothing is sorted as a whole. Where a source's budget ends is found in steps, each of which sums the rows that are left by
one more part of the order: a coarse bucket of the key, the key, a block of row ids, the row id. A window sees at most
the buckets of a source, the keys of one bucket, the blocks of one key's rows or the rows of one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.storage import stored, unused

SHARES, TOTAL, MOST = (5, 2, 1), 1.5, 2.0
BUCKETS = 1 << 14
RANGES = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column) -> Column:
    """A number between 0 and 1 that depends on id and text only."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``weight``: 2 for good, 0.5 for bad documents, between them where labels differ."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    return known.agg((0.5 + 1.5 * F.avg("quality")).alias("weight"))


def keyed(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``row_id`` (of the table's scan), ``doc_id``, ``source``, ``size`` in words and the sampling order of every row."""
    sized = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", word_count(F.col("text")).alias("size"),
        uniform(F.col("doc_id"), F.col("text")).alias("u"),
    )
    weighted = sized.join(weights.select("doc_id", "weight"), "doc_id", "left")
    key = -F.log("u") / F.coalesce("weight", F.lit(1.0))
    return weighted.select("row_id", "doc_id", "source", "size", key.alias("key")).withColumns(
        {"bucket": F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), "block": F.shiftright("row_id", 20)}
    )


def source_targets(rows: DataFrame, shares: tuple[float, ...], total: float, most: float) -> DataFrame:
    """``source``, ``source_size``, ``target`` words. Sources get the shares in turn, by code point and null last. Together
    they get ``total`` times all words, each at most ``most`` times its own; what is above goes to the others by share."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = stored(
        sizes.repartitionByRange(RANGES, F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()),
        "source-sizes",
    )
    parts = sizes.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    inside = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("at", F.row_number().over(inside)).join(parts, "part")
    turn = (F.col("before") + F.col("at") - 1) % len(shares)
    share = F.element_at(F.array(*(F.lit(float(s)) for s in shares)), turn.cast("int") + 1)
    sources = stored(ranked.select("source", "source_size", share.alias("share")), "source-shares")

    all_words, all_shares = sources.agg(F.sum("source_size"), F.sum("share")).first()
    if not all_shares:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    limit, level, full = most * F.col("source_size"), total * all_words / all_shares, 0
    while True:
        above = F.col("share") * level > limit
        n, held, open_shares = sources.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)), F.sum(F.when(~above, F.col("share")))
        ).first()
        if n == full or not open_shares:
            return sources.select("source", "source_size", F.least(F.col("share") * level, limit).alias("target"))
        level, full = (total * all_words - held) / open_shares, n


def _cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source with a budget: the key and row id at which it ends, and whether that row is taken."""
    cuts, known = budgets.select(F.col("source").alias("of"), F.col("budget").alias("rest")).where("rest > 0"), []
    for level in ("bucket", "key", "block", "row_id"):
        same = rows["source"].eqNullSafe(cuts["of"])
        for c in known:
            same = same & (rows[c] == cuts[f"cut_{c}"])
        sums = rows.join(cuts, same).groupBy("of", "rest", level, *(f"cut_{c}" for c in known)).agg(F.sum("size").alias("n"))
        before = F.sum("n").over(Window.partitionBy("of").orderBy(level)) - F.col("n")
        ends = sums.withColumn("before", before).where("before < rest and rest <= before + n")
        cuts = ends.select(
            "of", (F.col("rest") - F.col("before")).alias("rest"), "n",
            *(f"cut_{c}" for c in known), F.col(level).alias(f"cut_{level}"),
        )
        cuts = stored(cuts, f"cut-{level}").drop("n") if level != "row_id" else cuts
        known.append(level)
    return stored(cuts.select("of", "cut_key", "cut_row_id", (2 * F.col("rest") >= F.col("n")).alias("takes_last")), "cuts")


def mixed(
    docs: DataFrame, weights: DataFrame, shares: tuple[float, ...] = SHARES, total: float = TOTAL, most: float = MOST
) -> DataFrame:
    """``row_id``, ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words, repeats
    counted) of every row of a stored table with ``doc_id``, ``source`` and ``text``; ``weights`` has ``doc_id`` and
    ``weight`` (no row: 1).

    Null text has no words; a null source is a source; a null doc_id has weight 1. Rows with equal id and text come one
    after the other in the order. Texts without words take no part in budgets. An empty table gives an empty result.
    """
    rows = stored(keyed(docs, weights), "mix-rows")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = stored(source_targets(rows, shares, total, most).withColumn("epochs", epochs), "targets")
    cuts = _cuts(rows, targets.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    plan = targets.join(cuts, targets.source.eqNullSafe(cuts.of), "left").drop("of").withColumnRenamed("source", "of")
    plan = stored(plan, "mix-plan")
    last = (F.col("row_id") < F.col("cut_row_id")) | ((F.col("row_id") == F.col("cut_row_id")) & F.col("takes_last"))
    chosen = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & last)
    copies = F.col("epochs") + F.coalesce(chosen, F.lit(False)).cast("long")
    return rows.join(plan, rows.source.eqNullSafe(plan.of)).withColumn("copies", copies).select(
        "row_id", "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def repeated(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """The rows of a stored table as often as the mix takes them; its columns stay as they are."""
    name, times = unused(docs, "row_id"), unused(docs, "copies")
    copies = mixed(docs, weights, **options).where("copies > 0").select(F.col("row_id").alias(name), F.col("copies").alias(times))
    taken = docs.withColumn(name, F.monotonically_increasing_id()).join(copies, name)
    return taken.withColumn(times, F.explode(F.array_repeat(F.lit(1), F.col(times).cast("int")))).select(docs.columns)


ORACLE = f"""
WITH words AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT + 0.5)
      / 4503599627370496.0 AS u
  FROM documents),
quality AS (
  SELECT doc_id, 0.5 + 1.5 * avg(quality) AS weight FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
keyed AS (
  SELECT words.doc_id, source, size, -ln(u) / coalesce(weight, 1.0) AS key
  FROM words LEFT JOIN quality ON words.doc_id = quality.doc_id),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
shares AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS share
  FROM sizes),
filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size::DOUBLE) OVER () AS total,
    coalesce(sum(most) OVER fuller, 0) AS held, sum(share) OVER () - coalesce(sum(share) OVER fuller, 0) AS open
  FROM shares WINDOW fuller AS (ORDER BY most / share, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((total - held) / open, held) AS level FROM filled WHERE most >= share * ((total - held) / open)),
targets AS (SELECT source, source_size, least(share * level, most) AS target FROM shares, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
summed AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS budget,
    sum(size) OVER (PARTITION BY plan.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed JOIN plan ON keyed.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN budget > 0 AND 2 * upto - size <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
