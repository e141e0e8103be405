import collections
import math
import random

import duckdb
import pytest

from skyledger.llm import mixing as M
from skyledger.llm import shards as S


def many(rnd, n=400):
    return [
        (i, " ".join(["w"] * rnd.randrange(0, 200)), rnd.choice(["en", "de", None]),
         rnd.choice(["a", "a", "a", "b", "c", "zz", "é", None]))
        for i in range(n)
    ]


def by_sql(rows):
    import pandas as pd

    documents = pd.DataFrame([(r[0], r[1], r[3]) for r in rows], columns=["doc_id", "text", "source"])  # noqa: F841
    documents = documents.astype({"doc_id": "Int64", "text": "string", "source": "string"})
    return collections.Counter(map(tuple, duckdb.sql(M.MIX_SQL).fetchall()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_equals_its_sql(make_docs, odd_rows, seed):
    rows = many(random.Random(seed)) + odd_rows
    out = M.copies(make_docs(rows, extra=True))
    got = collections.Counter((r.doc_id, r.size, r.source_size, r.target, r.size * r.n_copies) for r in out.collect())
    assert got == by_sql(rows)


def test_targets(spark):
    # a plain search for the level at which the capped shares use up the total
    rnd = random.Random(7)
    sizes = {f"s{i:02}": rnd.randrange(0, 2000) for i in range(25)} | {None: 700}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in M.source_targets(rows).collect()}
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(2 * sizes[s], level * weight[s]) for s in sizes) < 1.5 * sum(sizes.values()):
            low = level
        else:
            high = level
    assert all(got[s] == pytest.approx(min(2 * sizes[s], low * weight[s]), abs=1e-3) for s in sizes)


def test_mixed_rows(make_docs, odd_rows):
    rows = many(random.Random(5)) + odd_rows
    docs = make_docs(rows, extra=True)
    out = M.mix(docs)
    assert out.columns == docs.columns
    counted = collections.Counter(r.doc_id for r in out.collect() if r.doc_id is not None and r.doc_id < 400)
    asked = {r.doc_id: r.n_copies for r in M.copies(docs).collect() if r.doc_id is not None and r.doc_id < 400}
    asked_odd = {r[0] for r in odd_rows}
    assert all(counted[i] == n for i, n in asked.items() if i not in asked_odd)
    assert max(asked.values()) <= 2
    assert sorted(map(str, out.collect())) == sorted(map(str, M.mix(docs).collect()))


def test_taken_is_near_the_target(make_docs):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randrange(20, 60)), "en", f"s{i % 4}") for i in range(8000)]
    taken, target = collections.Counter(), {}
    for r in M.copies(make_docs(rows)).collect():
        taken[r.source] += r.size * r.n_copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.05 * target[s] for s in target)


def test_no_words_nothing_taken(make_docs):
    got = M.copies(make_docs([(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert [(r.size, r.target, r.n_copies) for r in got] == [(0, 0.0, 0)] * 2
    assert M.copies(make_docs([])).count() == 0 and M.mix(make_docs([])).count() == 0


# ---- shards

def plain_points(spark, rows):
    """Scaled coordinates from the rows alone; only the hashes are Spark's."""
    import zlib

    from pyspark.sql import functions as F

    levels = 2**20 - 1
    ranks = [{x: i + 1 for i, x in enumerate(sorted({r[k] for r in rows} - {None}))} for k in (3, 2)]
    texts = [(r[1] or "").encode() for r in rows]
    raw = [
        (math.log(len(t) + 1.0) / math.log(2.0), ranks[0].get(r[3], 0), ranks[1].get(r[2], 0)) for r, t in zip(rows, texts, strict=True)
    ]
    hashed = spark.createDataFrame([(r[0], r[1] or "") for r in rows], "i long, t string").select(F.xxhash64("t"), F.xxhash64("i")).collect()
    points = []
    for r, t, x, (of_text, of_id) in zip(rows, texts, raw, hashed, strict=True):
        c = []
        for d in range(3):
            low, high = min(y[d] for y in raw), max(y[d] for y in raw)
            c.append(math.floor((x[d] - low) / (high - low) * levels) if high > low else 0)
        tie = ((of_text % 2**64) >> (64 - 28)) << 14 | (of_id % 2**64) >> (64 - 14)
        points.append({"doc_id": r[0], "text_crc32": zlib.crc32(t), "size": len(t) + 1, "tie": tie, "c": c})
    return points


def plain_tree(points, leaves, first=0):
    """The same splits, one node after the other in Python."""
    if leaves == 1 or not points:
        return {(p["doc_id"], p["text_crc32"]): first for p in points}
    widths = [max(p["c"][d] for p in points) - min(p["c"][d] for p in points) for d in range(3)]
    dim = widths.index(max(widths))
    ordered = sorted(points, key=lambda p: (p["c"][dim], p["tie"]))
    left = -(-leaves // 2)
    wanted, sum_, cut = sum(p["size"] for p in points) * left / leaves, 0, len(ordered)
    for i, p in enumerate(ordered):
        if sum_ + p["size"] >= wanted:
            cut = i if wanted - sum_ < sum_ + p["size"] - wanted else i + 1
            break
        sum_ += p["size"]
    return plain_tree(ordered[:cut], left, first) | plain_tree(ordered[cut:], leaves - left, first + left)


@pytest.mark.parametrize("few, shards", [(64, 8), (65_536, 8), (65_536, 6), (65_536, 7), (65_536, 1)])
def test_shards_equal_a_plain_tree(spark, make_docs, few, shards):
    rows = [(r[0], r[1], r[2], None if i % 50 == 0 else f"crawl-part-{i % 9}") for i, r in enumerate(many(random.Random(3), 300))]
    got = {(r.doc_id, r.text_crc32): r.shard for r in S.kd_shards(make_docs(rows), shards, few).collect()}
    assert got == plain_tree(plain_points(spark, rows), shards)
    assert set(got.values()) == set(range(shards))


def test_sources_that_share_ten_bytes_are_told_apart(make_docs):
    # equal sizes and languages: the source alone can part the documents
    rows = [(i, "w " * 20, "en", f"common-beginning-{i % 6}" if i else None) for i in range(601)]
    sources = collections.defaultdict(set)
    for r in S.kd_shards(make_docs(rows), 6).collect():
        sources[r.shard].add(rows[r.doc_id][3])
    assert len(sources) == 6 and sum(map(len, sources.values())) <= 7 + 5


def check_table(rows, docs):
    assert len(rows) == len(docs)
    for shard in range(8):
        mine = sorted(r.slot for r in rows if r.shard == shard)
        assert mine == list(range(len(mine)))
    assert {r.law for r in rows} <= {"bytes"} and all(r.grown_shard is None for r in rows)


def test_bytes_are_near_equal(make_docs, monkeypatch):
    monkeypatch.setattr(S, "SLOT_ROWS", 100)
    # a third of all rows in one source, and a third with one text
    rnd = random.Random(4)
    docs = [(i, "one text of many copies" if i % 3 == 0 else "w " * rnd.randrange(1, 90), "en", "hot" if i % 3 else "s") for i in range(3000)]
    rows = S.shard_table(make_docs(docs)).collect()
    check_table(rows, docs)
    sums = collections.Counter()
    for r in rows:
        sums[r.shard] += r.size
    assert len(sums) == 8 and max(sums.values()) < 1.03 * min(sums.values())


def test_odd_rows(make_docs, odd_rows):
    import zlib

    rows = S.shard_table(make_docs(odd_rows, extra=True)).collect()
    check_table(rows, odd_rows)
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_empty_and_tiny_tables(make_docs):
    assert S.shard_table(make_docs([])).count() == 0
    assert S.shard_table(make_docs(["only one"])).count() == 1
    assert S.kd_shards(make_docs(["a", "b"]), 1).count() == 2
