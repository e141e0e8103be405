import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from skyledger.llm import prefix_trie as P

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def expected(rows):
    """The contract, every prefix of every conversation written out."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))  # the remainder has the sign of c
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in full.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        cost = (len(of) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
            for node, of in members.items()
        ),
        key=str,
    )


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def talk(rnd, n, most=7):
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(1, most + 1)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rnd.choice(["hi", "ça va", "ok", f"long {rnd.randrange(6)}"])))
    return rows


@pytest.fixture(scope="module")
def make(spark):
    def build(rows):
        return spark.createDataFrame(rows, DDL).repartition(3)

    return build


def test_against_every_prefix_written_out(make):
    rows = talk(random.Random(1), 120)
    assert result(P.prefix_nodes(make(rows))) == expected(rows)


def test_sql_on_a_small_table(make):
    rows = talk(random.Random(2), 60) + [(-7, 0, "user", "hi"), (-5, 0, "user", "hi"), (-5, 1, None, "ok")]
    df = make(rows)
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "int64", "turn": "int64"}))
    found = sorted((tuple(r) for r in con.execute(P.NODES_SQL).fetchall()), key=str)
    assert found == expected(rows) == result(P.prefix_nodes(df))


def test_hot_copies_and_long_conversations(make, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_IDS", 7)
    rnd = random.Random(3)
    rows = []
    for c in range(200):
        if c % 3:
            rows += [(c, t, "user", f"the same {t}") for t in range(6)]
        else:
            rows += [(c, t, "user", f"turn {t}" if t < 10 else f"turn {t} of {rnd.randrange(3)}") for t in range(12)]
    rows += [(1000, t, "user", f"very long {t % 7}") for t in range(300)]  # shares 12 turns with the next
    rows += [(2000, t, "user", f"very long {t % 7}" if t < 12 else "other") for t in range(290)]
    assert result(P.prefix_nodes(make(rows))) == expected(rows)


def test_chains_are_peeled_at_once(make):
    """Two conversations of a thousand turns that part after two leave three levels, not a thousand."""
    rows = [(c, t, "user", f"{t}" if t < 2 else f"{t} of {c}") for c in (45, 50) for t in range(1000)]
    cut = P._alone(P.rebuilt(make(rows)).mapInArrow(P._chain, "conv_id long, key binary, keys array<binary>, sums array<long>"))
    assert {r["cut"] for r in cut.collect()} == {4}


def test_odd_rows(make, spark):
    rows = [
        (0, None, "user", "first"), (0, 0, None, None), (0, 0, "user", ""), (0, 3, "user", "x"), (0, 3, "user", "x"),
        (1, 5, "", ""), (2, 1, "a", "b"), (2, 1, "ab", ""), (None, 0, "user", "nobody's"), (None, None, None, None),
        (7, 0, "user", "base is absent"), (12, 0, "user", "z" * 100_000), (2**40, 1, "user", "far"),
    ]
    df = make(rows).withColumns({n: F.lit("x") for n in ("key", "keys", "sums", "cut", "turns", "_base", "ends", "depth")})
    assert result(P.prefix_nodes(df)) == expected(rows)
    assert result(P.prefix_nodes(make(rows).limit(0))) == []
    assert result(P.prefix_nodes(make([(None, 1, "user", "x")]))) == []
    empty = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    only = [(empty, 0, "user", "gone")]
    assert result(P.prefix_nodes(make(only))) == expected(only) != []
