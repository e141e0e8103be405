"""Attaching a table that is unique per key to a larger one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 1_000
HOT_SPREAD = 256


def attach(
    fact: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS, weight: str | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join ``lookup`` to ``fact``; broadcast it only when rows and bytes are counted to be few.

    Past the bound it is a shuffle join. ``weight`` names a lookup column with the
    number of fact rows per key; with it the rows of very frequent keys are kept out
    of the shuffled match, otherwise adaptive execution has to split them. Pass a
    staged ``lookup`` so that counting it does not compute it twice.
    """
    few = lookup.limit(max_broadcast_rows + 1).agg(F.count("*").alias("rows"), F.sum(_width(lookup)).alias("bytes")).first()
    if few["rows"] <= max_broadcast_rows and (few["bytes"] or 0) <= max_broadcast_bytes:
        return fact.join(F.broadcast(lookup.drop(weight) if weight else lookup), keys, how)
    if weight and how == "left":
        return _attach_hot_apart(fact, lookup, keys, weight)
    return fact.join(lookup.hint("shuffle_merge"), keys, how)


def _width(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    total = F.lit(16)
    for name, kind in df.dtypes:
        quoted = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            total = total + 16 + F.coalesce(F.octet_length(quoted), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            total = total + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(quoted))), F.lit(0))
        else:
            total = total + 8
    return total.cast("long")


def _attach_hot_apart(fact: DataFrame, lookup: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Left join whose frequent keys are answered by a broadcast.

    A key counts as hot from a thousandth of all rows on, so there are at most a
    thousand of them. Their rows take a salt that the shuffled lookup does not
    have: they match nothing there and are spread over many tasks. The salt comes
    from the row's values, so a retried task sends every row the same way.
    """
    values = [c for c in lookup.columns if c not in keys and c != weight]
    total = lookup.agg(F.sum(weight)).first()[0]
    hot = lookup.filter(F.col(weight) * HOT_KEYS >= total)
    hot = hot.select(*keys, F.struct(*values).alias("_hot"))
    # always 0, but not as a literal: the optimizer would turn that into a filter on
    # the other side and shuffle by the bare keys
    no_salt = F.pmod(F.hash(*keys), F.lit(1))
    rest = lookup.select(*keys, no_salt.alias("_salt"), F.struct(*values).alias("_rest"))
    salt = (F.pmod(F.xxhash64(*fact.columns), F.lit(HOT_SPREAD)) + 1).cast("int")
    marked = fact.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), salt).otherwise(0)
    )
    joined = marked.join(rest.hint("shuffle_merge"), [*keys, "_salt"], "left")
    found = F.coalesce("_hot", "_rest")
    return joined.select(*fact.columns, *[found[v].alias(v) for v in values])
