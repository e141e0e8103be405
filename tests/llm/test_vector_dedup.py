import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import vector_dedup as V

DDL = "vec_id long, embedding array<float>, label int, node string, unit string, least_id long"


def table(spark, vectors):
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v], 1, "n", "u", 7) for i, v in vectors]
    return spark.createDataFrame(rows, DDL).repartition(3)


def expected(vectors, least):
    usable = [
        i for i, (_, v) in enumerate(vectors)
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(np.float32(x) for x in v)
    ]
    units = {i: (x := np.array(vectors[i][1], dtype=np.float32).astype(float)) / np.linalg.norm(x) for i in usable}
    n, parent = [0] * len(vectors), list(range(len(vectors)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in usable:
        for j in usable:
            if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                n[i] += 1
                n[j] += 1
                parent[find(i)] = find(j)
    lowest = {}
    for i, (v, _) in enumerate(vectors):
        if v is not None:
            lowest[find(i)] = min(lowest.get(find(i), v), v)
    return sorted(((v, n[i], lowest.get(find(i)), lowest.get(find(i)) == v) for i, (v, _) in enumerate(vectors)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def groups(rnd, sizes, dim=24, noise=0.06):
    out = []
    for size in sizes:
        centre = rnd.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        out += [centre + noise * rnd.standard_normal(dim) for _ in range(size)]
    return out


def test_against_all_pairs(spark):
    rnd = np.random.default_rng(1)
    vectors = groups(rnd, [60, 25, 9] + [3] * 10 + [1] * 200)
    vectors += vectors[:5]  # exact copies
    vectors = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert result(V.link_vectors(table(spark, vectors))) == expected(vectors, 0.9)


def test_lists_and_blocks_agree(spark, monkeypatch):
    # a group far above the list length, cut into several blocks, and a chain of links
    monkeypatch.setattr(V, "BLOCK", 32)
    rnd = np.random.default_rng(2)
    vectors = groups(rnd, [150, 40], noise=0.09)
    turn = [[math.cos(a), math.sin(a)] + [0.0] * 22 for a in np.arange(0, 3, 0.2)]
    vectors = [(1000 - i, list(v)) for i, v in enumerate([*vectors, *turn])]
    assert result(V.link_vectors(table(spark, vectors))) == expected(vectors, 0.9)


def test_links_between_dense_groups(spark, monkeypatch):
    # every list is full of its own group: no listed link leads across, nor does a short list
    monkeypatch.setattr(V, "BLOCK", 32)
    monkeypatch.setattr(V, "ATTEMPTS", 1)
    rnd = np.random.default_rng(4)
    one, two, far = np.linalg.qr(rnd.standard_normal((64, 3)))[0].T
    two = 0.935 * one + math.sqrt(1 - 0.935**2) * two
    vectors = [c + 0.0125 * rnd.standard_normal(64) for c in (one, two, far) for _ in range(100)]
    vectors = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want = expected(vectors, 0.9)
    assert len({r[2] for r in want}) == 2 and max(r[1] for r in want) > 150
    assert result(V.link_vectors(table(spark, vectors))) == want


def test_audit_sees_past_a_hot_group(spark, monkeypatch):
    # the graph knows the hot group only; its many links must not make up for the lost pairs
    first = V._first_graph
    monkeypatch.setattr(V, "BLOCK", 64)
    monkeypatch.setattr(V, "ATTEMPTS", 1)
    monkeypatch.setattr(V, "_first_graph", lambda *args, **named: first(*args, **named).filter("sim >= 0.97"))
    monkeypatch.setattr(V, "_descend", lambda edges, vectors, least, wanted: V._best(edges.withColumn("new", F.lit(1)), wanted))
    rnd = np.random.default_rng(5)
    vectors = groups(rnd, [150], dim=64, noise=0.006)
    for centre in groups(rnd, [1] * 20, dim=64, noise=0):
        aside = rnd.standard_normal(64)
        aside -= (aside @ centre) * centre
        vectors += [centre, 0.92 * centre + math.sqrt(1 - 0.92**2) * aside / np.linalg.norm(aside)]
    vectors = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert result(V.link_vectors(table(spark, vectors))) == expected(vectors, 0.9)


def lone_pairs(rnd, centres, cosine, dim):
    """Each centre and a vector at the given cosine of it."""
    out = []
    for centre in centres:
        aside = rnd.standard_normal(dim)
        aside -= (aside @ centre) * centre
        out += [centre, cosine * centre + math.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)]
    return out


def test_audit_has_to_see_links(spark):
    """Twenty pairs among 20,000 vectors, none of them in the lists: the first draws see next to no link."""
    rnd = np.random.default_rng(15)
    x = rnd.standard_normal((20_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = list(x[:1])
    for v in x[1:20_000]:  # far enough from a few fixed ones to plant pairs there
        kept.append(v)
    planted = lone_pairs(rnd, np.eye(16)[:10], 0.93, 16) + lone_pairs(rnd, -np.eye(16)[:10], 0.93, 16)
    units = [v for v in kept if max(abs(v)) < 0.8][:19_960] + planted
    rows = [(b"%d" % i, [float(c) for c in v], 1, 16) for i, v in enumerate(units)]
    vectors = spark.createDataFrame(rows, "node binary, unit array<double>, copies long, dim int").repartition(4)
    # a threshold that only the planted pairs reach
    labels = vectors.select("node", F.lit(False).alias("saturated"))
    nothing = vectors.limit(0).select("node", F.lit(0).cast("long").alias("n_links"))
    true = np.array(units) @ np.array(units[-40:]).T
    assert ((true >= 0.925).sum(axis=0) >= 2).all()
    told = V._audit(vectors, labels, nothing, 0.925, 64)
    share, seen, whole = told[False]
    assert seen >= 40 and (whole or seen >= V.ENOUGH) and share == 0.0 and not V._good(told)
    assert told[True] == (None, 0, True)


def test_recall_in_a_cloud(spark):
    """Vectors that all lie close together, as text embeddings do, with lone pairs among them."""
    rnd = np.random.default_rng(16)
    middle = np.zeros(64)
    middle[0] = 1.7
    x = rnd.standard_normal((2500, 64)) / 8 + middle
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = [*x, *lone_pairs(rnd, x[:100], 0.93, 64)[1::2]]
    vectors = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want = expected(vectors, 0.92)
    assert 0.6 < np.median(x[:300] @ x[300:600].T) < 0.9 and sum(r[1] > 0 for r in want) >= 200
    got = result(V.link_vectors(table(spark, vectors), 0.92))
    found = [g[1] / w[1] for g, w in zip(got, want, strict=True) if w[1]]
    assert np.mean(found) >= 0.98 and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("n", [200_000, 50_000_000])
def test_lone_pairs_share_a_leaf(n):
    # near copies without a common neighbour, among so many vectors, are found by their leaves only
    rnd = np.random.default_rng(6)
    one, aside = rnd.standard_normal((2, 1500, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    aside -= (aside * one).sum(axis=1, keepdims=True) * one
    two = 0.91 * one + math.sqrt(1 - 0.91**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    units = pa.array([*one.tolist(), *two.tolist()], pa.list_(pa.float64()))
    nodes = pa.array([b"%d" % i for i in range(3000)], pa.binary())
    batch = pa.RecordBatch.from_arrays([nodes, units, pa.array([64] * 3000, pa.int32())], names=["node", "unit", "dim"])
    (planted,) = V._planted(V._depth(n), V._trees(n, 0.9), 0)([batch])
    codes = np.array(planted.column("codes").to_pylist())
    assert (codes[:1500] == codes[1500:]).any(axis=1).mean() >= 0.97


def test_recall_without_lucky_leaves(spark, monkeypatch):
    # one tree only: the joins and the audit have to make up for it
    monkeypatch.setattr(V, "TREES", 1)
    monkeypatch.setattr(V, "LEAF", 16)
    rnd = np.random.default_rng(3)
    vectors = [(i, v.tolist()) for i, v in enumerate(groups(rnd, [30] * 6 + [2] * 60 + [1] * 200))]
    got = result(V.link_vectors(table(spark, vectors)))
    want = expected(vectors, 0.9)
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_odd_vectors(spark):
    vectors = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (None, [3.0, 0.0]), (None, None), (9, [1.0, 0.0, 0.0]),
        (10, [-1.0, 0.0]), (11, [1e-30, 0.0]), (12, [3e38, 1e37]),
    ]
    assert result(V.link_vectors(table(spark, vectors))) == expected(vectors, 0.9)


def test_at_the_threshold(spark):
    # a cosine of exactly 0.5 is linked, one just below is not
    vectors = [(1, [1.0, 1.0, 0.0, 0.0]), (2, [1.0, 0.0, 1.0, 0.0]), (3, [1.0, 0.0, 0.0, 1.0001])]
    assert {r[0]: r[1] for r in result(V.link_vectors(table(spark, vectors), 0.5 - 1e-12))} == {1: 1, 2: 1, 3: 0}


def test_within_rounding_of_the_threshold(spark, monkeypatch):
    # sixty lone pairs whose cosines differ by less than single precision can tell; half of them are links
    rnd = np.random.default_rng(21)
    x = rnd.standard_normal((60, 64))
    vectors = lone_pairs(rnd, x / np.linalg.norm(x, axis=1, keepdims=True), 0.93, 64)
    vectors = [(i, v.tolist()) for i, v in enumerate(vectors)]
    units = [(u := np.array(v, dtype=np.float32).astype(float)) / np.linalg.norm(u) for _, v in vectors]
    cosines = sorted(float(a @ b) for a, b in zip(units[::2], units[1::2], strict=True))
    least = (cosines[29] + cosines[30]) / 2
    assert cosines[-1] - cosines[0] < V.MARGIN and cosines[30] - cosines[29] > 1e-13
    want = expected(vectors, least)
    assert sum(r[1] for r in want) == 60
    assert result(V.link_vectors(table(spark, vectors), least)) == want


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])]])
def test_tiny_tables(spark, vectors):
    assert result(V.link_vectors(table(spark, vectors))) == expected(vectors, 0.9)
