"""Conversation prefix trie by truncation peeling: level by level from the deepest turn to the root."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import attach
from skyledger.sources.staging import stage

KEY_BYTES = 16
CHUNK_IDS = 8192
GROUP = 5  # conversations of one group share the beginning of its first
MOST_SHARED = 8
NO_IDS = hashlib.sha256(b"").hexdigest()
ROOT = b""


# ---- conversations as paths

def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each a digest of role and text, and the text's bytes.

    Null turns come first, turns of one number follow their digests; null role or text is
    empty; rows without a conv_id belong to no conversation. Texts themselves are not shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.substring(digest, 1, KEY_BYTES).alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("x"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and turns of every conversation, its beginning taken from the first of its group.

    The first crc32(conv_id as text) % 9 turns are those of conversation conv_id - conv_id
    % 5 (all it has if they are fewer, none if it is absent); its own turns after as many
    follow. The remainder has the sign of conv_id.
    """
    own = stage(conversation_turns(conversations), "trie-turns")
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, MOST_SHARED).alias("_head")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    both = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % GROUP, "_h": shared}).join(heads, "_base", "left")
    head = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    tail = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, tail).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of each prefix, made of the one before and the turn, and the bytes up to it."""
    for batch in batches:
        keys_of, sums_of, last = [], [], []
        for turns in batch.column("turns"):
            key, keys = ROOT, []
            for digest in turns.values.field("digest").to_pylist():
                key = hashlib.blake2b(key + digest, digest_size=KEY_BYTES).digest()
                keys.append(key)
            keys_of.append(keys)
            sums_of.append(np.cumsum(turns.values.field("bytes").to_numpy()))
            last.append(key)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), pa.array(last, pa.binary()), pa.array(keys_of, pa.list_(pa.binary())),
                pa.array(sums_of, pa.list_(pa.int64())),
            ],
            names=["conv_id", "key", "keys", "sums"],
        )


# ---- ids of the conversations that end at a node

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids of each key's run in a sorted batch."""
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        rows, begin = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin] or i - begin == CHUNK_IDS:
                rows.append((keys[begin], ids[begin], ",".join(map(str, ids[begin:i]))))
                begin = i
        key, first, text = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["key", "first", "ids"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each key's chunks, which come one after the other; only the running state is held."""

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.string())], names=["key", "ends"]
        )

    current, state = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != current:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield out(done)
    if state is not None:
        yield out([(current, state.hexdigest())])


def _ends(paths: DataFrame) -> DataFrame:
    """key and the digest of the ids that end there, ascending.

    Ids are joined by ranges of (key, id), so many tasks share the copies of one
    conversation; the one task that has to run over all of them sees chunks of 8192 ids.
    """
    ranged = paths.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranged.mapInArrow(_chunks, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends string")


# ---- peeling

def _alone(kinds: DataFrame) -> DataFrame:
    """key (of a whole path) and the least power of two from whose depth on no other path goes along.

    A path below such a depth is a chain, whose levels are peeled at once; so as many
    levels are left as twice the deepest shared depth, however long conversations are.
    """
    length = F.size("keys")
    depths = F.transform(F.sequence(F.lit(0), F.floor(F.log2(length)).cast("int")), lambda j: F.pow(F.lit(2), j).cast("int"))
    spots = kinds.filter(length > 0).select("key", "keys", F.explode(depths).alias("cut"))
    shared = spots.groupBy("cut", F.element_at("keys", F.col("cut")).alias("at")).agg(
        F.count("*").alias("paths"), F.min("key").alias("key")
    )
    return shared.filter("paths = 1").groupBy("key").agg(F.min("cut").alias("cut"))


def peel(paths: DataFrame) -> DataFrame:
    """Every node of the paths' prefix tree.

    ``paths`` has conv_id and turns, as :func:`rebuilt` gives them. Equal paths become one
    with a count. From the deepest level on, the paths that end there and what survived
    from below meet by their prefix key; each node that this finds is emitted with its
    sums, and goes on, with its last turn stripped, as one row to its parent. So a level
    moves one row per node, added up before the shuffle, and no path is expanded.
    Columns: key, parent, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends (digest of the ids of the conversations that end at the node).
    """
    chained = stage(
        paths.mapInArrow(_chain, "conv_id long, key binary, keys array<binary>, sums array<long>"), "trie-paths"
    )
    kinds = chained.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("keys").alias("keys"), F.first("sums").alias("sums")
    )
    kinds = stage(kinds.join(_ends(chained), "key"), "trie-kinds")
    length = F.size("keys")
    cut = stage(kinds.join(_alone(kinds), "key", "left").withColumn("cut", F.coalesce("cut", length)), "trie-cut")
    # the chains below: nodes of one path each
    whole = F.element_at("sums", -1)
    before = F.when(F.col("depth") > 1, F.element_at("sums", F.greatest(F.col("depth") - 1, F.lit(1)))).otherwise(0)
    chains = cut.filter(length > F.col("cut")).withColumn("depth", F.explode(F.sequence(F.col("cut") + 1, length)))
    is_last = F.col("depth") == length
    chains = chains.select(
        F.element_at("keys", F.col("depth")).alias("key"), F.element_at("keys", F.col("depth") - 1).alias("parent"),
        F.col("depth").cast("long").alias("depth"), F.col("low").alias("conv_id"), F.col("low").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(is_last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * (whole - before)).alias("saved_tokens"),
        F.when(is_last, F.col("ends")).alias("ends"),
    )
    goes_on = length > F.col("cut")
    reached = F.when(F.col("cut") > 0, F.element_at("sums", F.greatest("cut", F.lit(1)))).otherwise(0)
    entries = stage(
        cut.select(
            "cut", F.slice("keys", F.lit(1), F.col("cut")).alias("keys"), F.slice("sums", F.lit(1), F.col("cut")).alias("sums"),
            "n", "low", goes_on.cast("long").alias("children"), goes_on.cast("long").alias("leaves"),
            F.when(goes_on, (F.col("n") - 1) * (whole - reached)).otherwise(0).alias("saved"),
            F.when(~goes_on, F.col("ends")).alias("ends"),
        ),
        "trie-entries", by="cut",
    )
    deepest = entries.agg(F.max("cut")).first()[0]
    levels, above = [], None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        rows = entries.filter(F.col("cut") == depth).drop("cut")
        rows = rows.unionByName(above) if above is not None else rows
        key = F.element_at("keys", -1) if depth else F.lit(ROOT)
        met = rows.groupBy(key.alias("key")).agg(
            F.first("keys").alias("keys"), F.first("sums").alias("sums"), F.sum("n").alias("n"), F.min("low").alias("low"),
            F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
        )
        last = F.element_at("sums", -1) - (F.element_at("sums", -2) if depth > 1 else F.lit(0)) if depth else F.lit(0)
        level = stage(
            met.withColumns({
                "leaves": F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long"),
                "saved": F.col("saved") + (F.col("n") - 1) * last,
            }),
            f"trie-level-{depth}",
        )
        parent = F.lit(None).cast("binary") if not depth else F.element_at("keys", -2) if depth > 1 else F.lit(ROOT)
        levels.append(level.select(
            "key", parent.alias("parent"), F.lit(depth).cast("long").alias("depth"), F.col("low").alias("conv_id"),
            F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), "ends",
        ))
        if depth:
            above = level.select(
                F.slice("keys", 1, depth - 1).alias("keys"), F.slice("sums", 1, depth - 1).alias("sums"), "n", "low",
                F.lit(1).cast("long").alias("children"), "leaves", "saved", F.lit(None).cast("string").alias("ends"),
            )
    if not levels:
        return chains
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    parents = found.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    named = attach(found, parents, ["parent"], weight="_n")
    return named.select(chains.columns).unionByName(chains)


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    A node is a distinct sequence of the first ``depth`` turns (role, text) of the rebuilt
    conversations; conv_id is its smallest member, n_convs the number of members (equal
    conversations count each; a rebuilt conversation without turns is a member of the root
    only), n_leaves the childless nodes of its subtree, itself included, saved_tokens the
    sum over its subtree of (n_convs - 1) times the UTF-8 bytes of the node's last text, and
    ends_sha256 the digest of the ids of the members that end there.

    Null turns come first, equal turn numbers in the order of a digest of role and text; null
    role or text is empty; rows without a conv_id are in no conversation; a repeated row is
    a turn of its own; a table without conversations gives no rows; other columns are not
    read. A conversation's digests, some 40 bytes a turn, are one row.
    """
    nodes = peel(rebuilt(conversations))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"),
    )


NODES_SQL = """
WITH ids AS (
  SELECT conv_id, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, e: CASE WHEN xor(c, e) & 1 = 1 THEN xor(xor(c, e) >> 1, 3988292384::BIGINT) ELSE xor(c, e) >> 1 END),
    4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id, role, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS t
  FROM (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
          sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT i.conv_id, i.h, COUNT(t.t) AS n FROM ids i
  LEFT JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 AND t.t <= i.h GROUP BY ALL),
both_parts AS (
  SELECT h.conv_id, t.t AS d, t.role, t.text FROM heads h
  JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 5 AND t.t <= h.h
  UNION ALL
  SELECT h.conv_id, h.n + t.t - h.h, t.role, t.text FROM heads h
  JOIN turns t ON t.conv_id = h.conv_id AND t.t > h.h),
steps AS (
  SELECT conv_id, d, strlen(text) AS size, string_agg(sha256(strlen(role) || ':' || role || text), ',')
    OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM both_parts),
members AS (
  SELECT conv_id, d, size, path, COALESCE(LAG(path) OVER (PARTITION BY conv_id ORDER BY d), '') AS parent FROM steps
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM ids),
nodes AS (
  SELECT path, d, parent, size, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs FROM members GROUP BY ALL),
kids AS (SELECT parent AS path, COUNT(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
own AS (
  SELECT n.*, COALESCE(k.n, 0) AS n_children, (n.n_convs - 1) * n.size AS saved
  FROM nodes n LEFT JOIN kids k USING (path)),
subtree AS (
  SELECT m.path, SUM(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM(o.saved) AS saved_tokens
  FROM own o JOIN members m ON m.conv_id = o.conv_id AND m.d <= o.d GROUP BY ALL),
lengths AS (SELECT conv_id, MAX(d) AS d FROM members GROUP BY ALL),
ends AS (
  SELECT m.path, string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) AS list
  FROM members m JOIN lengths USING (conv_id, d) GROUP BY ALL)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(COALESCE(e.list, '')) AS ends_sha256
FROM own o JOIN subtree s USING (path) LEFT JOIN own p ON p.path = o.parent LEFT JOIN ends e ON e.path = o.path
"""
