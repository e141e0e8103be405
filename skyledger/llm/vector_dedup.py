"""Near-duplicate embeddings: NN-descent over a neighbour graph, of which the links above a threshold stay."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.groups import smallest_labels
from skyledger.operators.joins import attach
from skyledger.sources.staging import stage, temporary

LOG = logging.getLogger(__name__)
NEIGHBOURS = 12  # length of a neighbour list
REVERSE = 6  # neighbours the other way that join in
OFFERS = 4  # best new neighbours that a join offers to each of its members
TREES, LEAF = 6, 256  # trees planted at a time; their number is a multiple of it
MISS = 0.02  # chance that a pair at the threshold shares no leaf of the first trees
ROUNDS = 6
BLOCK = 1024
SLACK = 1e-6  # radians, far above the rounding of an angle
MARGIN = 1e-6  # of a cosine, above what single precision of the components can make of it
AUDITED = 256
OTHERS = 4
ENOUGH = 200  # vectors with a link that an audit of a kind has to see
MOST_DRAWN = 65_536
DRAWS = 1 << 30
GOOD_RECALL = 0.98
ATTEMPTS = 4


# ---- vectors

def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision and a digest of each; null where a vector has no direction."""
    for batch in batches:
        ids, nodes, units = [], [], []
        for vec_id, given in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
            ids.append(vec_id)
            unit = None
            if given.is_valid and len(given) and not given.values.null_count:
                x = given.values.to_numpy().astype(np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    unit = x / math.sqrt(float((x * x).sum()))
            units.append(unit)
            nodes.append(None if unit is None else xxhash.xxh3_128_digest(unit.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(nodes, pa.binary()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "node", "unit"],
        )


def _matrix(column) -> np.ndarray:
    """Lists of equal length as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same number for a pair in whatever block it is met."""
    return (a * b).sum(axis=-1)


# ---- the first graph: leaves of random-hyperplane trees

def _short(vectors: DataFrame) -> DataFrame:
    """The vectors in single precision, half as much to shuffle; what lies near the threshold is worked out anew later."""
    return vectors.withColumn("unit", F.col("unit").cast("array<float>"))


def _planted(depth: int, trees: int, seed: int):
    """Each vector's leaf code in every tree: which side of ``depth`` random hyperplanes it lies on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("dim").to_numpy()
            codes = np.zeros((batch.num_rows, trees), dtype=np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = _matrix(batch.column("unit").take(pa.array(at)))
                draw = np.random.default_rng([seed, int(dim)])
                for first in range(0, trees, TREES):  # a few at a time, so that the sides take little room
                    some = min(TREES, trees - first)
                    sides = (x @ draw.standard_normal((int(dim), some * max(1, depth))) > 0).reshape(len(at), some, -1)
                    code = np.zeros((len(at), some), dtype=np.int64)
                    for bit in range(depth):
                        code = code * 2 + sides[:, :, bit]
                    codes[at, first:first + some] = code
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * trees), pa.array(codes.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("dim"), lists], names=["node", "dim", "codes"])

    return run


def _leaf_lists(wanted: int):
    """Best ``wanted`` neighbours of each vector inside its leaf."""

    def near(leaf: pa.Table) -> pa.Table:
        nodes = leaf.column("node").combine_chunks()
        x = _matrix(leaf.column("unit"))
        n = len(x)
        k = min(wanted, n - 1)
        if k < 1:
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "sim": pa.array([], pa.float64())})
        sims = x @ x.T
        np.fill_diagonal(sims, -2.0)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        left, right = np.repeat(np.arange(n), k), best.ravel()
        return pa.table({"a": nodes.take(pa.array(left)), "b": nodes.take(pa.array(right)), "sim": _cosines(x[left].astype(np.float64), x[right])})

    return near


def _depth(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n / LEAF))))


def _trees(n: int, least: float) -> int:
    """Trees, a multiple of ``TREES``, so that a pair with a cosine of ``least`` shares no leaf with a chance of ``MISS`` at most.

    A random hyperplane separates two vectors with a chance of their angle over pi.
    """
    together = (1 - math.acos(max(-1.0, min(1.0, least))) / math.pi) ** _depth(n)
    if together >= 1 - MISS:
        return TREES
    if together <= 0:  # opposite vectors share no leaf
        return TREES
    return TREES * math.ceil(math.log(MISS) / math.log1p(-together) / TREES)


def _leaves(vectors: DataFrame, n: int, trees: int, seed: int) -> DataFrame:
    """node, dim, tree, code, cut and turn of every vector in every tree, ``TREES`` of them a turn; no vectors.

    An overfull leaf is cut by a hash, so no leaf grows with a group of copies.
    """
    planted = vectors.select("node", "unit", "dim").mapInArrow(
        _planted(_depth(n), trees, seed), "node binary, dim int, codes array<long>"
    )
    turn = F.floor(F.col("tree") / TREES).cast("int")
    leaves = planted.select("node", "dim", F.posexplode("codes").alias("tree", "code")).withColumn("turn", turn)
    leaves = stage(leaves, "vectors-leaves", by="turn")
    sizes = leaves.groupBy("dim", "tree", "code").count().filter(F.col("count") > 2 * LEAF)
    full = stage(sizes.select("dim", "tree", "code", F.ceil(F.col("count") / (2 * LEAF)).cast("int").alias("cuts")), "vectors-full")
    cut = F.pmod(F.xxhash64("node", "tree", F.lit(seed)), F.coalesce("cuts", F.lit(1))).cast("int")
    return leaves.join(full, ["dim", "tree", "code"], "left").withColumn("cut", cut).drop("cuts")


def _first_graph(vectors: DataFrame, leaves: DataFrame, turn: int, wanted: int) -> DataFrame:
    """Neighbours inside the leaves of one turn's trees."""
    held = leaves.filter(F.col("turn") == turn).drop("turn").join(vectors.select("node", "unit"), "node")
    return held.groupBy("dim", "tree", "code", "cut").applyInArrow(_leaf_lists(wanted), "a binary, b binary, sim double")


# ---- neighbours of neighbours

def _best(edges: DataFrame, wanted: int) -> DataFrame:
    """Each node's best ``wanted`` neighbours; ``new`` is 1 where a pair was not in the list before."""
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    return one.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= wanted).drop("nth")


def _join_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meets the members of each list with each other; offers every member the best that beat its worst neighbour."""
    for batch in batches:
        members = batch.column("members")
        sizes = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        nodes, units, lows = flat.field("member"), flat.field("unit"), flat.field("low").to_numpy()
        begins = np.cumsum(sizes) - sizes
        out_a, out_b, out_sim = [], [], []
        for size in np.unique(sizes):
            if size < 2:
                continue
            lists = np.flatnonzero(sizes == size)
            for some in np.array_split(lists, max(1, len(lists) * int(size) // 20_000)):
                at = begins[some][:, None] + np.arange(size)
                x = _matrix(units.take(pa.array(at.ravel()))).reshape(len(some), size, -1)
                sims = x @ x.transpose(0, 2, 1)
                sims[:, np.arange(size), np.arange(size)] = -2.0
                k = min(OFFERS, size - 1)
                best = np.argpartition(-sims, k - 1, axis=2)[:, :, :k]
                rows, left = np.meshgrid(np.arange(len(some)), np.arange(size), indexing="ij")
                rows, left = np.repeat(rows.ravel(), k), np.repeat(left.ravel(), k)
                right = best.ravel()
                exact = _cosines(x[rows, left].astype(np.float64), x[rows, right])
                good = exact > lows[at[rows, left]]
                out_a.append(at[rows, left][good])
                out_b.append(at[rows, right][good])
                out_sim.append(exact[good])
        if out_a:
            a, b, sim = (np.concatenate(p) for p in (out_a, out_b, out_sim))
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(a)), nodes.take(pa.array(b)), pa.array(sim)], names=["a", "b", "sim"])


def _offers(lists: DataFrame, vectors: DataFrame, wanted: int, least: float, floor: float) -> DataFrame:
    """New neighbour candidates from the lists that changed, by joining each list with itself."""
    top = F.max("sim").over(Window.partitionBy("a"))
    usable = lists.withColumn("top", top).filter((F.col("sim") >= floor) | (F.col("top") < least)).drop("top")
    order = Window.partitionBy("b").orderBy(F.xxhash64("a", "b"))
    backward = usable.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= REVERSE)
    members = (
        usable.select(F.col("a").alias("w"), F.col("b").alias("member"), "new")
        .union(backward.select(F.col("b").alias("w"), F.col("a").alias("member"), "new"))
        .union(usable.select(F.col("a").alias("w"), F.col("a").alias("member"), F.lit(0).alias("new")).distinct())
    )
    members = members.groupBy("w", "member").agg(F.max("new").alias("new"))
    low = lists.groupBy("a").agg(F.when(F.count("*") >= wanted, F.min("sim")).otherwise(-1.0).alias("low"))
    known = vectors.select(F.col("node").alias("member"), "unit").join(low.withColumnRenamed("a", "member"), "member", "left")
    known = known.withColumn("low", F.coalesce("low", F.lit(-1.0)))
    held = members.join(known, "member").groupBy("w").agg(
        F.collect_list(F.struct("member", "unit", "low")).alias("members"), F.max("new").alias("new")
    )
    return held.filter("new = 1").select("members").mapInArrow(_join_lists, "a binary, b binary, sim double")


def _descend(edges: DataFrame, vectors: DataFrame, least: float, wanted: int, rounds: int = ROUNDS) -> DataFrame:
    """Refines the lists, which are the best ``wanted`` neighbours of each vector, until a round finds next to no new link.

    Two vectors linked through a common linked neighbour are within twice the threshold's
    angle of it, so after the first round a list that holds a link is followed only up to
    that angle. A list without a link is followed to its end.
    """
    floor = math.cos(min(math.pi, 2 * math.acos(min(1.0, least))))
    lists = edges.withColumn("new", F.lit(1))
    for turn in range(rounds):
        more = _offers(lists, vectors, wanted, least, -1.0 if turn == 0 else floor).withColumn("new", F.lit(1))
        lists = stage(_best(lists.withColumn("new", F.lit(0)).unionByName(more), wanted), "vectors-lists")
        links = lists.agg(
            F.count(F.when(F.col("sim") >= least, 1)).alias("all"),
            F.count(F.when((F.col("sim") >= least) & (F.col("new") == 1), 1)).alias("new"),
        ).first()
        if links["new"] * 1000 <= links["all"]:
            break
    return lists


# ---- links

def _ball_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the unit vectors of each component in a batch."""
    for batch in batches:
        names = batch.column("component").dictionary_encode()
        codes = names.indices.to_numpy()
        sizes = np.diff(batch.column("unit").offsets.to_numpy())
        out_names, out_sums = [], []
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            kinds, where = np.unique(codes[at], return_inverse=True)
            sums = np.zeros((len(kinds), int(dim)))
            np.add.at(sums, where, _matrix(batch.column("unit").take(pa.array(at))))
            out_names.append(names.dictionary.take(pa.array(kinds)))
            out_sums += sums.tolist()
        if out_names:
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(out_names), pa.array(out_sums, pa.list_(pa.float64()))], names=["component", "centre"]
            )


def _ball_centre(parts: pa.Table) -> pa.Table:
    """The direction of the sum; any direction will do where the vectors cancel out."""
    total = _matrix(parts.column("centre")).sum(axis=0)
    length = math.sqrt(float((total * total).sum()))
    centre = total / length if length > 1e-9 else np.eye(1, len(total))[0]
    return pa.table({"component": parts.column("component").slice(0, 1), "centre": pa.array([centre.tolist()], pa.list_(pa.float64()))})


def _angles_to_centre(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the column ``centre`` by the angle between it and ``unit``."""
    for batch in batches:
        sizes = np.diff(batch.column("unit").offsets.to_numpy())
        angles = np.zeros(batch.num_rows)
        for dim in np.unique(sizes):
            at = pa.array(np.flatnonzero(sizes == dim))
            cosines = _cosines(_matrix(batch.column("unit").take(at)), _matrix(batch.column("centre").take(at)))
            angles[at.to_numpy()] = np.arccos(np.clip(cosines, -1.0, 1.0))
        rest = [c for c in batch.schema.names if c != "centre"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(angles)], names=[*rest, "angle"])


def _with_angles(rows: DataFrame) -> DataFrame:
    kept = [f"`{name}` {kind}" for name, kind in rows.dtypes if name != "centre"]
    return rows.mapInArrow(_angles_to_centre, ", ".join([*kept, "angle double"]))


def _near_balls(reach: float):
    """Pairs of components, one of each block, between whose balls a link is possible."""

    def meet(block: pa.Table) -> pa.Table:
        side, dims = block.column("side").to_numpy(), block.column("dim").to_numpy()
        found_a, found_b = [], []
        for dim in np.unique(dims):
            left, right = (block.filter(pa.array((side == s) & (dims == dim))) for s in (0, 1))
            if not left.num_rows or not right.num_rows:
                continue
            angles = np.arccos(np.clip(_matrix(left.column("centre")) @ _matrix(right.column("centre")).T, -1.0, 1.0))
            far = left.column("radius").to_numpy()[:, None] + right.column("radius").to_numpy()[None, :] + reach
            i, j = np.nonzero(angles <= far)
            found_a += left.column("component").take(pa.array(i)).to_pylist()
            found_b += right.column("component").take(pa.array(j)).to_pylist()
        return pa.table({"here": pa.array(found_a, pa.binary()), "there": pa.array(found_b, pa.binary())})

    return meet


def _meetings(spots: DataFrame, least: float) -> DataFrame:
    """``spots`` under each pair (here, there) of components: the own one, and all that a vector may have links into.

    A component lies in a ball around its mean direction. By the triangle inequality a
    vector has no link into a component whose centre is farther off than the ball's radius
    and the threshold's angle together, so what is left out is out of reach.
    """
    own = spots.withColumns({"here": F.col("component"), "there": F.col("component")})
    reach = math.acos(max(-1.0, min(1.0, least))) + SLACK
    sums = spots.select("component", "unit").mapInArrow(_ball_sums, "component binary, centre array<double>")
    centres = stage(sums.groupBy("component").applyInArrow(_ball_centre, "component binary, centre array<double>"), "vectors-centres")
    angles = _with_angles(attach(spots.select("component", "unit"), centres, ["component"], how="inner"))
    radii = angles.groupBy("component").agg(F.max("angle").alias("radius"))
    balls = stage(centres.join(radii, "component").withColumn("dim", F.size("centre")), "vectors-balls")
    n = balls.count()
    if n < 2:
        return own
    cuts = math.ceil(n / BLOCK)
    place, every = F.pmod(F.xxhash64("component"), F.lit(cuts)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(cuts - 1)))
    columns = ["l", "r", "side", "component", "centre", "radius", "dim"]
    lefts = balls.withColumns({"l": place, "side": F.lit(0)}).withColumn("r", every).select(columns)
    rights = balls.withColumns({"r": place, "side": F.lit(1)}).withColumn("l", every).select(columns)
    pairs = lefts.union(rights).groupBy("l", "r").applyInArrow(_near_balls(reach), "here binary, there binary")
    others = balls.select(F.col("component").alias("there"), "centre", "radius")
    pairs = stage(pairs.filter("here <> there").join(others, "there").withColumn("component", F.col("here")), "vectors-near-balls")
    across = _with_angles(attach(spots, pairs, ["component"], how="inner")).filter(F.col("angle") <= F.col("radius") + reach)
    return own.unionByName(across.select(own.columns))


def _block_counts(least: float):
    """Links between a block of saturated vectors and a block of their own or another component.

    Links between two saturated vectors are counted, never listed; those to a vector with
    a short list, which has few, are listed. Components that a link joins come with n = 0.
    """

    def compare(block: pa.Table) -> pa.Table:
        side = block.column("side").to_numpy()
        left, right = block.filter(pa.array(side == 0)), block.filter(pa.array(side == 1))
        none = {"node": pa.array([], pa.binary()), "other": pa.array([], pa.binary()), "n": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(none)
        a, b = left.column("node").combine_chunks(), right.column("node").combine_chunks()
        x, y = _matrix(left.column("unit")), _matrix(right.column("unit"))
        sims = x @ y.T
        # pairs so near the threshold that the block product could round the other way
        for i, j in zip(*np.nonzero(np.abs(sims - least) < 1e-9), strict=True):
            sims[i, j] = _cosines(x[i], y[j])
        same = np.array(a.to_pylist(), dtype=object)[:, None] == np.array(b.to_pylist(), dtype=object)[None, :]
        linked = (sims >= least) & ~same
        full = right.column("saturated").to_numpy(zero_copy_only=False).astype(bool)
        counts = linked[:, full].astype(np.int64) @ right.column("copies").to_numpy()[full]
        i, j = np.nonzero(linked & ~full)
        joined, met = _components_met(left.column("component"), right.column("component"), linked)
        return pa.table({
            "node": pa.concat_arrays([a, a.take(pa.array(i)), joined]),
            "other": pa.concat_arrays([pa.nulls(len(a), pa.binary()), b.take(pa.array(j)), met]),
            "n": pa.concat_arrays([pa.array(counts), pa.nulls(len(i), pa.int64()), pa.array(np.zeros(len(met), np.int64))]),
        })

    return compare


def _components_met(left: pa.ChunkedArray, right: pa.ChunkedArray, linked: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The pairs of different components with a link between them, each once."""
    both = pa.chunked_array([*left.chunks, *right.chunks], pa.binary()).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy().astype(np.int64)
    a, b = codes[:len(left)], codes[len(left):]
    i, j = np.nonzero(linked & (a[:, None] != b[None, :]))
    pairs = np.unique(a[i] * len(both.dictionary) + b[j])
    return tuple(both.dictionary.take(pa.array(x)) for x in np.divmod(pairs, len(both.dictionary)))


def _exact_links(least: float):
    """The pairs (a, b) whose vectors x and y are linked in double precision."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            linked = np.zeros(batch.num_rows, dtype=bool)
            for dim in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == dim))
                linked[at.to_numpy()] = _cosines(_matrix(batch.column("x").take(at)), _matrix(batch.column("y").take(at))) >= least
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return run


def _confirmed(lists: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """The pairs of ``lists`` that are links; those within rounding of the threshold are worked out anew from whole vectors."""
    sure = lists.filter(F.col("sim") >= least + MARGIN).select("a", "b")
    close = lists.filter((F.col("sim") >= least - MARGIN) & (F.col("sim") < least + MARGIN)).select("a", "b")
    if close.isEmpty():
        return sure
    held = vectors.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    held = attach(held, stage(close, "vectors-close"), ["a"], how="inner")
    held = held.join(vectors.select(F.col("node").alias("b"), F.col("unit").alias("y")), "b")
    return sure.union(held.select("a", "b", "x", "y").mapInArrow(_exact_links(least), "a binary, b binary"))


def _links(lists: DataFrame, vectors: DataFrame, least: float, wanted: int, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """node, component, saturated and node, n_links (copies of the node itself left out) of every vector with a link.

    A link with a vector whose list ends below the threshold is in that list. A list of
    which even the last entry is a link may be too short: such a saturated vector is
    compared, block by block, with its own component and with all others that hold
    saturated vectors and are not out of its reach. Components joined thereby are one. With ``whole`` every vector
    is taken as saturated and compared with all of its length.
    """
    links = stage(_confirmed(lists, vectors, least), "vectors-links")
    near = lists.filter(F.col("sim") >= least - MARGIN).groupBy("a").count()
    saturated = near.filter(F.col("count") >= wanted).select(F.col("a").alias("node"))
    labels = smallest_labels(vectors.select("node"), links)
    flagged = stage(
        labels.join(saturated.withColumn("saturated", F.lit(True)), "node", "left")
        .withColumn("saturated", F.lit(True) if whole else F.coalesce("saturated", F.lit(False))),
        "vectors-flagged",
    )
    dense = stage(flagged.filter("saturated").select("component").distinct(), "vectors-dense")
    spots = flagged.join(dense, "component").join(vectors.select("node", "unit", "copies"), "node")
    spots = stage(spots.select("component", "node", "saturated", "unit", "copies"), "vectors-spots")
    if whole:
        of_length = F.size("unit").cast("string").cast("binary")
        met = stage(spots.withColumns({"here": of_length, "there": of_length}), "vectors-meetings")
    else:
        met = stage(_meetings(spots, least), "vectors-meetings")
    sizes = stage(met.groupBy("here", "there").agg(F.count("*").alias("n"), F.count(F.when(F.col("saturated"), 1)).alias("n_full")), "vectors-sizes")
    # a grid for each pair: the saturated vectors here by all vectors there
    sides = sizes.select("here", "there", F.ceil(F.col("n_full") / BLOCK).cast("int").alias("nl")).filter("nl > 0").join(
        sizes.select(F.col("here").alias("there"), F.col("there").alias("here"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nr")),
        ["here", "there"],
    )
    sides = stage(sides, "vectors-sides")
    columns = ["here", "there", "l", "r", "side", "component", "node", "saturated", "unit", "copies"]
    lefts = attach(met.filter("saturated"), sides, ["here", "there"], how="inner").withColumns({
        "l": F.pmod(F.xxhash64(F.lit("l"), "node"), F.col("nl")).cast("int"),
        "r": F.explode(F.sequence(F.lit(0), F.col("nr") - 1)), "side": F.lit(0),
    }).select(columns)
    swapped = met.select(F.col("there").alias("here"), F.col("here").alias("there"), "component", "node", "saturated", "unit", "copies")
    rights = attach(swapped, sides, ["here", "there"], how="inner").withColumns({
        "r": F.pmod(F.xxhash64("node"), F.col("nr")).cast("int"),
        "l": F.explode(F.sequence(F.lit(0), F.col("nl") - 1)), "side": F.lit(1),
    }).select(columns)
    blocks = lefts.union(rights).groupBy("here", "there", "l", "r")
    found = stage(blocks.applyInArrow(_block_counts(least), "node binary, other binary, n long"), "vectors-blocks")

    # components with a link between them are one
    joined = stage(found.filter("other is not null and n = 0").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct(), "vectors-joined")
    if not joined.isEmpty():
        wider = smallest_labels(labels.select(F.col("component").alias("node")).distinct(), joined)
        wider = wider.select(F.col("node").alias("component"), F.col("component").alias("wider"))
        labels = stage(labels.join(wider, "component").select("node", F.col("wider").alias("component")), "vectors-labels")

    # listed links: at least one end has a short list
    is_full = flagged.select("node", "saturated")
    marked = links.join(is_full.withColumnsRenamed({"node": "a", "saturated": "a_full"}), "a").join(
        is_full.withColumnsRenamed({"node": "b", "saturated": "b_full"}), "b"
    )
    listed = marked.filter("not (a_full and b_full)").select("a", "b")
    listed = listed.union(found.filter("other is not null and n is null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    both = listed.union(listed.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    weighed = both.join(vectors.select(F.col("node").alias("b"), F.col("copies").alias("n")), "b").select(F.col("a").alias("node"), "n")
    counted = weighed.union(found.filter("other is null").select("node", "n")).groupBy("node").agg(F.sum("n").alias("n_links"))
    return labels.join(is_full, "node"), counted


def _settled(lists: DataFrame, vectors: DataFrame, least: float, wanted: int, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """``_links`` as tables of their own; those it was made through are removed."""
    with temporary(vectors.sparkSession):
        labels, counted = _links(lists, vectors, least, wanted, whole)
        return stage(labels, "vectors-settled", outer=True), stage(counted, "vectors-settled", outer=True)


def _shares(vectors: DataFrame, picked: DataFrame, least: float) -> list[float]:
    """Share of its own links that was found, for each picked vector that has any.

    The picked vectors are compared with every vector in blocks; only sums come back.
    """
    rows = picked.select("unit", "dim", "copies", "n_links").toArrow()
    dims = rows.column("dim").to_numpy()
    by_dim = {}
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        by_dim[int(dim)] = (at, _matrix(rows.column("unit").take(pa.array(at))))
    shared = vectors.sparkSession.sparkContext.broadcast(by_dim)
    n_picked = rows.num_rows

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n_picked, dtype=np.int64)
        for batch in batches:
            lengths, copies = batch.column("dim").to_numpy(), batch.column("copies").to_numpy()
            for dim, (places, units) in shared.value.items():
                all_of_dim = np.flatnonzero(lengths == dim)
                for begin in range(0, len(all_of_dim), BLOCK):
                    at = all_of_dim[begin:begin + BLOCK]
                    x = _matrix(batch.column("unit").take(pa.array(at))).T
                    for first in range(0, len(places), BLOCK):
                        near = units[first:first + BLOCK] @ x >= least
                        totals[places[first:first + BLOCK]] += near @ copies[at]
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["i", "n"])

    true = vectors.select("dim", "unit", "copies").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    links = np.zeros(n_picked, dtype=np.int64)
    for row in true.collect():  # a number per picked vector
        links[row["i"]] = row["n"]
    shared.destroy()
    links -= rows.column("copies").to_numpy()
    found = rows.column("n_links").fill_null(0).to_numpy()
    some = links > 0
    return np.minimum(1.0, found[some] / links[some]).tolist()


def _audit(vectors: DataFrame, labels: DataFrame, counted: DataFrame, least: float, audited: int) -> dict[bool, tuple[float | None, int, bool]]:
    """Of saturated (True) and other vectors (False): mean share of its links found for a vector, vectors it is of, and whether all were looked at.

    Vectors are drawn by hash, ever more of them, until ``ENOUGH`` with a true link were
    seen, or all were looked at, or ``MOST_DRAWN`` drawn: where links are rare, a sample
    that saw none says nothing, so it is not the end. A mean of nothing is None.
    """
    kinds = vectors.select("node", "unit", "dim", "copies").join(labels.select("node", "saturated"), "node").join(counted, "node", "left")
    place = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(DRAWS)) / F.lit(float(DRAWS))
    kinds = stage(kinds.withColumn("place", place), "vectors-audit")
    sizes = {r["saturated"]: r["count"] for r in kinds.groupBy("saturated").count().collect()}
    told = {}
    for kind, draw in ((True, audited), (False, audited * OTHERS)):
        n, done, shares = sizes.get(kind, 0), 0.0, []
        while done < min(1.0, MOST_DRAWN / max(n, 1)) and n and len(shares) < ENOUGH:
            upto = min(1.0, done + draw / n)
            some = kinds.filter((F.col("saturated") == kind) & (F.col("place") >= done) & (F.col("place") < upto))
            shares += _shares(vectors, some, least)
            done, draw = upto, draw * 4
        told[kind] = (sum(shares) / len(shares) if shares else None, len(shares), not n or done >= 1.0)
    return told


def _good(told: dict[bool, tuple[float | None, int, bool]]) -> bool:
    """Whether every kind that has links was found to have most; says so where too few were seen to tell."""
    for kind, (share, seen, whole) in told.items():
        name = "saturated" if kind else "other"
        LOG.info("recall of %s vectors: %s, on %d with links%s", name, share, seen, ", all looked at" if whole else "")
        if seen < ENOUGH and not whole:
            LOG.warning("recall of %s vectors is measured on %d only: links are rarer than the draws can tell", name, seen)
    return all(share is None or share >= GOOD_RECALL for share, _, _ in told.values())


def link_vectors(table: DataFrame, least: float = 0.9, audited: int = AUDITED) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors with a cosine of ``least`` or more are linked, in double precision; n_links is
    the number of other rows linked directly, component_id the least vec_id reachable.
    Null, empty, zero and not wholly finite vectors are linked with nothing, and so are
    vectors of different lengths with each other. Equal vectors are one node with a number
    of copies, so copies are counted, not paired; repeated rows are copies. A null vec_id
    is never the least one unless it stands alone. An empty table gives no rows; other
    columns are not read.

    The graph starts from leaves of random-hyperplane trees and is refined by joining
    neighbours of neighbours until a round finds next to no new link. Lists are made of
    vectors in single precision; cosines within rounding of ``least`` are worked out anew. There are so many
    trees that a pair at the threshold shares no leaf with a chance of 0.02 at most, where
    leaves are not overfull. Vectors whose list
    holds nothing but links are compared in blocks with every dense component in their
    reach. A sample of vectors is then compared with all, until 200 of each kind that have
    a link were seen, all were looked at or 65,536 drawn: where a saturated or another
    vector has on average less than 0.98 of its links, the lists are made twice as long,
    further trees join, and the work is done again. If four times are not enough, all
    vectors are compared with all in blocks, which takes the square of their number but
    leaves nothing short. No link is ever wrong; up to there some may be missed.
    """
    units = stage(
        table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
            _units, "vec_id long, node binary, unit array<double>"
        ),
        "vectors-units",
    )
    vectors = stage(
        units.filter("node is not null").groupBy("node").agg(
            F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id")
        ).withColumn("dim", F.size("unit")),
        "vectors-nodes",
    )
    n, short = vectors.count(), _short(vectors)
    spark, edges, wanted = table.sparkSession, None, NEIGHBOURS
    for attempt in range(ATTEMPTS):
        with temporary(spark):
            trees = _trees(n, least)
            leaves = _leaves(vectors, n, trees, seed=attempt)
            # a few trees at a time, so that no more copies of the vectors are dealt out at once
            for turn in range(trees // TREES):
                first = _first_graph(short, leaves, turn, wanted).withColumn("new", F.lit(1))
                edges = first if edges is None else edges.select("a", "b", "sim").withColumn("new", F.lit(1)).unionByName(first)
                edges = stage(_best(edges, wanted), "vectors-edges", outer=True)
        with temporary(spark):
            edges = stage(_descend(edges.select("a", "b", "sim"), short, least, wanted), "vectors-edges", outer=True)
        edges = edges.select("a", "b", "sim")
        labels, counted = _settled(edges, vectors, least, wanted)
        with temporary(spark):
            if _good(_audit(vectors, labels, counted, least, audited)):
                break
        wanted *= 2
    else:
        labels, counted = _settled(edges, vectors, least, wanted, whole=True)
    named = stage(vectors.select("node", "copies", "least_id").join(labels, "node").join(counted, "node", "left"), "vectors-named")
    least_ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = named.join(least_ids, "component").select("node", "copies", "n_links", "component_id")
    return _rows(units.select("vec_id", "node").join(told, "node", "left"))


def _rows(joined: DataFrame) -> DataFrame:
    links: Column = F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", links.cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


LINKS_SQL = """
WITH RECURSIVE given AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS MATERIALIZED (
  SELECT r, v, sqrt(list_dot_product(v, v)) AS size FROM given
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r < b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM given UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
least AS (SELECT reach.a AS r, MIN(g.vec_id) AS component_id FROM reach JOIN given g ON g.r = reach.b GROUP BY reach.a),
counts AS (SELECT a AS r, COUNT(*) AS n FROM ways GROUP BY a)
SELECT g.vec_id, COALESCE(c.n, 0) AS n_links, l.component_id, l.component_id IS NOT DISTINCT FROM g.vec_id AS kept
FROM given g JOIN least l USING (r) LEFT JOIN counts c USING (r)
"""
