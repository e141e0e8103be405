"""Mixing sources to target weights: whole copies plus one hash-seeded chance copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.joins import attach
from skyledger.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
CHANCES = 2**52


def n_words(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share_percent: int = 150, most: int = 2, weights=WEIGHTS) -> DataFrame:
    """Target of every source, from ``source`` and ``size`` of each document.

    All targets add up to ``share_percent`` of all sizes. Sources by code point, null
    last, weigh ``weights`` in turn; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. With the sources in order of size per
    weight the ones that stop come first, so running sums find them in one step.
    Works on one row per source; documents are summed before the shuffle.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    weighed = total.withColumn("weight", weight)

    # hundredths, so that sums stay whole numbers
    order = (F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    limit = F.col("source_size") * (100 * most)
    left = F.sum("source_size").over(whole) * share_percent - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    judged = weighed.select(
        "source", "source_size", "weight", limit.alias("limit"),
        (left.cast("double") * F.col("weight") >= limit.cast("double") * weight_left).alias("stops"),
    )
    free = F.when(~F.col("stops"), F.col("weight"))
    taken = F.when(F.col("stops"), F.col("limit"))
    rest = F.sum("source_size").over(whole) * share_percent - F.coalesce(F.sum(taken).over(whole), F.lit(0))
    shared = F.col("weight").cast("double") * rest.cast("double") / (F.sum(free).over(whole) * 100).cast("double")
    stopped = (F.col("source_size") * most).cast("double")
    return judged.select("source", "source_size", F.when(F.col("stops"), stopped).otherwise(shared).alias("target"))


def chance(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(CHANCES))


def copies(docs: DataFrame, seed: str = "mix-1", share_percent: int = 150, most: int = 2, weights=WEIGHTS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, n_copies.

    The repetition rate of a source is its target over its size. A document is taken
    floor(rate) times, and once more if its chance is below the fraction, so never more
    than ``most`` times and alike on every run. A null text has size 0; a source without
    words has rate 0. Rows that share a doc_id get the same chance. An empty table gives
    no rows. Other columns of ``docs`` are not looked at.

    The texts are read once: only ids and sizes are staged. Targets are joined by
    broadcast only where they are counted to be few.
    """
    sizes = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = stage(source_targets(sizes, share_percent, most, weights), "mix-targets")
    keyed = [F.coalesce("source", F.lit("")).alias("_key"), F.col("source").isNull().alias("_none")]
    lookup = targets.select(*keyed, "source_size", "target")
    joined = attach(sizes.select("*", *keyed), lookup, ["_key", "_none"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = chance(F.col("doc_id"), seed) < rate - F.floor(rate)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.floor(rate) + extra.cast("long")).cast("long").alias("n_copies"),
    )


def mix(docs: DataFrame, seed: str = "mix-1", share_percent: int = 150, most: int = 2, weights=WEIGHTS) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as it is taken.

    Sizes and rates are as in ``copies``; only the texts' own scan decides, so no text
    is shuffled: rates are attached to the rows by source.
    """
    sizes = stage(docs.select("source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = stage(source_targets(sizes, share_percent, most, weights), "mix-targets")
    keyed = [F.coalesce("source", F.lit("")).alias("_key"), F.col("source").isNull().alias("_none")]
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    lookup = targets.select(*keyed, rate.alias("rate"))
    joined = attach(docs.select(F.struct(*docs.columns).alias("row"), *keyed), lookup, ["_key", "_none"])
    extra = chance(F.col("row.doc_id"), seed) < F.col("rate") - F.floor("rate")
    times = (F.floor("rate") + extra.cast("long")).cast("int")
    return joined.select(F.explode(F.array_repeat("row", times)).alias("row")).select("row.*")


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM per_source
), running AS (
  SELECT *,
         (sum(source_size) OVER ()) * 150
           - coalesce(sum(source_size * 200) OVER before, 0) AS rest,
         (sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed
  WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT source, source_size, weight,
         rest::DOUBLE * weight >= (source_size * 200)::DOUBLE * weight_left AS stops
  FROM running
), targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN (source_size * 2)::DOUBLE
              ELSE weight::DOUBLE
                   * ((sum(source_size) OVER ()) * 150
                      - coalesce(sum(CASE WHEN stops THEN source_size * 200 END) OVER (), 0))::DOUBLE
                   / ((sum(CASE WHEN NOT stops THEN weight END) OVER ()) * 100)::DOUBLE END AS target
  FROM judged
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS chance
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
