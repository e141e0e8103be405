"""Sharding by a k-d tree over document metadata, split at weighted medians."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.joins import attach
from skyledger.operators.numbering import number_rows
from skyledger.sources.staging import stage

COORDINATE_BITS = 20
TIE_BITS = 42  # of which the last ones come from the id, so that equal texts are neighbours
ID_BITS = 14
KEY_BITS = COORDINATE_BITS + TIE_BITS
MOST_BINS = 65_536
SLOT_ROWS = 20_000
DIMENSIONS = ("bytes", "source", "lang")


def _ranked(rows: DataFrame, column: str, rank: str) -> DataFrame:
    """``rows`` with the dense rank of a name in code point order, a null one 0."""
    names = number_rows(rows.select(column).filter(F.col(column).isNotNull()).distinct(), [column], rank)
    return attach(rows, stage(names, "shard-names"), [column]).withColumn(rank, F.coalesce(rank, F.lit(0)).cast("double"))


def _points(docs: DataFrame) -> DataFrame:
    """Narrow rows: id, size, checksum, one scaled coordinate per dimension, and a tie-breaker."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.log2(F.octet_length(text) + 1.0).alias("x0"), F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            (
                F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - TIE_BITS + ID_BITS), ID_BITS)
                + F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - ID_BITS)
            ).alias("tie"),
        ),
        "shard-points",
    )
    rows = _ranked(_ranked(rows, "source", "x1"), "lang", "x2")
    ends = rows.agg(*[f(f"x{d}").alias(f"{n}{d}") for d in range(len(DIMENSIONS)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    levels = 2**COORDINATE_BITS - 1
    scaled = []
    for d in range(len(DIMENSIONS)):
        low, high = ends[f"lo{d}"], ends[f"hi{d}"]
        wide = low is not None and high > low
        x = F.floor((F.col(f"x{d}") - low) / (high - low) * levels).cast("long") if wide else F.lit(0).cast("long")
        scaled.append(x.alias(f"c{d}"))
    return rows.select("doc_id", "size", "text_crc32", "tie", *scaled)


def _widest(nodes: DataFrame) -> dict[int, tuple[int, int]]:
    """Of each node: the dimension of greatest width (the first of equals), and its weight."""
    wide = nodes.groupBy("node").agg(
        F.sum("size").alias("weight"),
        *[(F.max(f"c{d}") - F.min(f"c{d}")).alias(f"w{d}") for d in range(len(DIMENSIONS))],
    )
    found = {}
    for row in wide.collect():  # one row per node, so never more than there are shards
        widths = [row[f"w{d}"] for d in range(len(DIMENSIONS))]
        found[row["node"]] = (widths.index(max(widths)), row["weight"])
    return found


def _key(dim) -> F.Column:
    coordinate = F.element_at(F.array(*[F.col(f"c{d}") for d in range(len(DIMENSIONS))]), dim + 1)
    return F.shiftleft(coordinate, TIE_BITS) + F.col("tie")


def _medians(keyed: DataFrame, weights: dict[int, float], few: int) -> dict[int, int]:
    """For each node the key below which the given weight lies, as near as rows allow.

    Searched by histograms: each round counts weights in equal bins of the interval that
    still holds the wanted key, so only bins travel, never rows. ``few`` bounds bins times
    nodes, which is what reaches the driver in a round.
    """
    spark = keyed.sparkSession
    bits = max(4, (few // max(1, len(weights))).bit_length() - 1)
    low = {n: 0 for n in weights}
    below = {n: 0 for n in weights}
    shift = KEY_BITS
    open_nodes, cut = set(weights), {}
    while open_nodes:
        step = max(0, shift - bits)
        wanted = spark.createDataFrame([(n, low[n]) for n in sorted(open_nodes)], "node int, low long")
        inside = keyed.join(F.broadcast(wanted), "node").filter(
            (F.col("key") >= F.col("low")) & (F.col("key") - F.col("low") < F.lit(2**shift))
        )
        bins = inside.groupBy("node", F.shiftright(F.col("key") - F.col("low"), step).alias("bin")).agg(
            F.sum("size").alias("weight"), F.count("*").alias("n"),
        )
        counted: dict[int, list] = {}
        for row in bins.collect():  # at most `few` rows
            counted.setdefault(row["node"], []).append((row["bin"], row["weight"], row["n"]))
        for n in sorted(open_nodes):
            half, sum_ = weights[n], below[n]
            for bin_, weight, rows in sorted(counted.get(n, [])):
                start = low[n] + (bin_ << step)
                if sum_ + weight >= half:
                    if rows == 1 or step == 0:
                        # the row across the middle goes where the halves come out nearer
                        cut[n] = start if half - sum_ < sum_ + weight - half else start + (1 << step)
                        open_nodes.discard(n)
                    else:
                        low[n], below[n] = start, sum_
                    break
                sum_ += weight
            else:
                cut[n] = low[n]
                open_nodes.discard(n)
        shift = step
    return cut


def _of_node(nodes: DataFrame, values: dict[int, int], name: str) -> DataFrame:
    """A number per node as a column; the first level has one node, and nothing to join."""
    if len(values) == 1:
        return nodes.withColumn(name, F.lit(next(iter(values.values()))).cast("long"))
    table = nodes.sparkSession.createDataFrame(sorted(values.items()), f"node int, {name} long")
    return nodes.join(F.broadcast(table), "node")


def kd_shards(docs: DataFrame, n_shards: int = 8, few: int = MOST_BINS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, by equal bytes.

    A document weighs its UTF-8 bytes plus one (a null text one). The documents start as
    one node of ``n_shards`` leaves; every node of several leaves is split along the
    dimension in which it is widest (bytes on a log scale, rank of the source, rank of the
    language; each scaled to the whole table's range), where the weights stand like the
    leaves of the two sides, at the weighted median if their number is even. So any
    number of leaves comes out near equal in bytes. Names are ranked in code point order,
    null before all. Within equal coordinates a hash of the text decides, then one of the
    id: copies with equal metadata stay neighbours, and one source or one group of copies
    of any size is divided like everything else; rows alike in text and id stay together.
    An empty table gives no rows; other columns are not looked at.

    The texts are read once. Everything after works on narrow staged rows: a level is a
    group-by for the widths and a few for the histogram search, with map-side sums.
    """
    nodes = _points(docs).withColumn("node", F.lit(0))
    leaves = {0: n_shards}
    level = 0
    while any(n > 1 for n in leaves.values()):
        widths = _widest(nodes)
        split = {n: w for n, w in widths.items() if leaves[n] > 1}
        if not split:
            break
        # a node that is whole already is cut beyond its last key
        dims = {n: d for n, (d, _) in widths.items()}
        keyed = stage(_of_node(nodes, dims, "dim").withColumn("key", _key(F.col("dim").cast("int"))).drop("dim"), f"shard-level{level}")
        left = {n: -(-k // 2) for n, k in leaves.items()}
        cuts = {n: 1 << KEY_BITS for n in widths} | _medians(keyed, {n: w * left[n] / leaves[n] for n, (_, w) in split.items()}, few)
        steps = {n: left[n] for n in widths}
        moved = F.when(F.col("key") >= F.col("cut"), F.col("step")).otherwise(0).cast("int")
        nodes = _of_node(_of_node(keyed, cuts, "cut"), steps, "step").withColumn("node", F.col("node") + moved).drop("cut", "key", "step")
        leaves = {m: k for n, k in leaves.items() for m, k in ((n, left[n]), (n + left[n], k - left[n])) if k > 0}
        level += 1
    return nodes.select("doc_id", "size", "text_crc32", "tie", "c0", "c1", "c2", F.col("node").alias("shard"))


def with_slots(sharded: DataFrame, rows: int = SLOT_ROWS) -> DataFrame:
    """Adds ``slot``: places 0, 1, 2, ... without a gap in each shard.

    A shard is cut into parts of about ``rows`` rows by a hash; a part's first slot is the
    number of rows in the parts before it, so no task has to order a whole shard.
    """
    placed = stage(sharded, "shard-placed")
    parts = max(1, -(-placed.count() // rows))
    placed = placed.withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "_part").count()
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("_nth", F.row_number().over(order) - 1)
    return (
        numbered.join(first.hint("shuffle_hash"), ["shard", "_part"])
        .withColumn("slot", F.col("_first") + F.col("_nth")).drop("_part", "_first", "_nth")
    )


def shard_table(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``kd_shards`` with slots and the law that holds."""
    return with_slots(kd_shards(docs, n_shards)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
