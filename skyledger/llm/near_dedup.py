"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.groups import smallest_labels
from skyledger.llm.words import coded, fitting, hashes, id_or_lowest, mixed, over_slices, split_words, window_hashes
from skyledger.sources.staging import stage

REGISTERS = 144
MOST_MISSED = 2e-5  # chance that a pair at the threshold shares no band
MEMBERS = 1024  # documents of one block of a bucket that is compared in full
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# ---- shingles and signatures

def shingle_sets(texts: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other; and where each begins.

    Words are lower-cased in A-Z only. A text of fewer than ``size`` words has one shingle,
    its whole sequence; a text without words has none.
    """
    lists, starts = split_words([x.translate(_LOWER) if x else None for x in texts])
    total = int(starts[-1])
    kinds, codes = coded(lists, total)
    values = hashes(kinds, len(kinds))[codes] if total else np.zeros(0, np.uint64)
    inside = fitting(starts, size)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    keys, owners = window_hashes(values, size)[inside], owner[:len(inside)][inside]
    few = np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < size))
    if len(few):
        whole = hashes((b"\0" + b" ".join(lists[i]) for i in few), len(few))
        keys, owners = np.concatenate([keys, whole]), np.concatenate([owners, few])
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[first], owners[first]
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.bincount(owners, minlength=len(texts)), out=begins[1:])
    return keys, begins


def signatures(keys: np.ndarray, begins: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures, ``size`` registers for each text.

    Every element draws a random permutation of the registers, one step per round, and in
    round j offers j plus a random fraction to the register it lands on; a register keeps
    its least offer. Elements are independent, so all of them take a round together. A
    text stops once no register holds more than the next round could offer, which is the
    early stop; long texts need a round or two. The permutation is a Fisher-Yates shuffle
    of which only the swaps are kept. A text without elements keeps empty registers.
    """
    n_texts = len(begins) - 1
    table = np.full(n_texts * size, np.inf)
    text = np.repeat(np.arange(n_texts), np.diff(begins))
    seed = keys
    chosen: list[np.ndarray] = []  # the place swapped with in round i, per element
    moved: list[np.ndarray] = []  # what lay on place i before that swap

    def lying(place: np.ndarray) -> np.ndarray:
        found = place.copy()
        for at, old in zip(chosen, moved, strict=True):
            np.copyto(found, old, where=at == place)
        return found

    for j in range(size):
        if not len(seed):
            break
        draw = mixed(seed + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) % (1 << 64)))
        fraction = (draw >> np.uint64(40)).astype(np.float64) / (1 << 24)
        place = (j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)).astype(np.int32)
        here = lying(np.full(len(seed), j, dtype=np.int32))
        register = lying(place)
        np.minimum.at(table, text * size + register, j + fraction)
        chosen.append(place)
        moved.append(here)
        going = table.reshape(n_texts, size).max(axis=1, initial=0) > j + 1
        keep = going[text]
        if not keep.all():
            seed, text = seed[keep], text[keep]
            chosen, moved = [c[keep] for c in chosen], [m[keep] for m in moved]
    return table.reshape(n_texts, size)


def band_layout(percent: int) -> tuple[int, int]:
    """Number of bands and registers in each: the widest bands that still catch pairs at the threshold."""
    for width in range(12, 1, -1):
        n_bands = REGISTERS // width
        if (1 - (percent / 100) ** width) ** n_bands <= MOST_MISSED:
            return n_bands, width
    return REGISTERS, 1


def _sign(part: pa.RecordBatch, texts: list, shingle: int, n_bands: int, width: int) -> dict:
    keys, begins = shingle_sets(texts, shingle)
    table = signatures(keys, begins, n_bands * width)
    rows = np.ascontiguousarray(table).view(np.uint64).reshape(len(texts), n_bands, width)
    bands = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64), (len(texts), n_bands)).copy()
    for r in range(width):
        bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    raw = keys.tobytes()
    sets = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) if b > a else None for a, b in zip(begins[:-1], begins[1:], strict=True)]
    flat = pa.array(bands.view(np.int64).ravel())
    return {
        "doc_id": part.column("doc_id"), "_mark": part.column("_mark"), "n_shingles": np.diff(begins), "node": pa.array(sets, pa.binary()),
        "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * n_bands), flat),
    }


# ---- candidates and links

def _alike(percent: int, a: str = "a_set", b: str = "b_set"):
    """Whether two sets have at least ``percent`` of their union in common."""
    shared = F.size(F.array_intersect(a, b))
    return shared * 100 >= (F.size(a) + F.size(b) - shared) * percent


def _star_links(others: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of every bucket's members to the bucket's least node: one row per member and pivot.

    A pivot of very many members is a hot key of the second join only, whose two sides
    are plain shuffles, so adaptive execution splits it.
    """
    pairs = stage(others.select("node", "pivot").distinct(), "near-pairs")
    near = pairs.join(sets.select("node", F.col("members").alias("a_set")), "node")
    both = near.join(sets.select(F.col("node").alias("pivot"), F.col("members").alias("b_set")), "pivot")
    return both.filter(_alike(percent)).select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def _block_links(percent: int):
    """Compares a block of unsettled documents with a block of members; a link per document and component found."""

    def compare(keys, rows):
        import pandas as pd

        left = rows[rows["side"] == 0].reset_index(drop=True)
        right = rows[rows["side"] == 1].reset_index(drop=True)
        found = []
        if len(left) and len(right):
            ids = np.concatenate([*left["members"], *right["members"]])
            sizes = np.array([len(x) for x in [*left["members"], *right["members"]]])
            owner = np.repeat(np.arange(len(sizes)), sizes)
            _, place, count = np.unique(ids, return_inverse=True, return_counts=True)
            useful = count[place] > 1
            place, owner = place[useful], owner[useful]
            _, place = np.unique(place, return_inverse=True)
            shared = np.zeros((len(left), len(right)), dtype=np.float32)
            width = 4096
            for begin in range(0, int(place.max()) + 1 if len(place) else 0, width):
                some = (place >= begin) & (place < begin + width)
                dense = np.zeros((len(sizes), width), dtype=np.float32)
                dense[owner[some], place[some] - begin] = 1
                shared += dense[:len(left)] @ dense[len(left):].T
            union = sizes[:len(left), None] + sizes[None, len(left):] - shared
            apart = left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]
            for i, j in zip(*np.nonzero((shared * 100 >= union * percent) & apart), strict=True):
                found.append((left["node"][i], right["component"][j], right["node"][j]))
        out = pd.DataFrame(found, columns=["a", "component", "b"]).drop_duplicates(["a", "component"])
        return out[["a", "b"]]

    return compare


def _rest_links(others: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links that the stars left open: pairs in one bucket whose components still differ.

    Buckets with the same pivot are taken together, as near copies share many of them.
    Pairs with the pivot are settled already. Of any other pair at least one document lies
    outside the largest component of the pivot's other members. Those documents, cut into
    blocks, meet all members, cut into blocks; a block pair is one group, so no group grows
    with its bucket, and only links leave it.
    """
    spots = stage(others.select("pivot", "node").distinct().join(labels, "node"), "near-spots")
    parts = stage(spots.groupBy("pivot", "component").count(), "near-parts")
    largest = parts.groupBy("pivot").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("n"),
        (F.sum("count") - F.max("count")).alias("n_rest"), F.count("*").alias("n_parts"),
    )
    open_ = stage(largest.filter("n_parts > 1"), "near-open")
    if open_.isEmpty():
        return open_.select(F.col("main").alias("a"), F.col("main").alias("b"))
    right_blocks = F.ceil(F.col("n") / MEMBERS).cast("int")
    left_blocks = F.ceil(F.col("n_rest") / MEMBERS).cast("int")
    held = spots.join(open_, "pivot").select(
        "pivot", "node", "component", (F.col("component") != F.col("main")).alias("rest"),
        right_blocks.alias("nr"), left_blocks.alias("nl"),
    )
    held = held.join(sets, "node")
    block = F.pmod(F.xxhash64("node"), F.col("nr")).cast("int")
    left_block = F.pmod(F.xxhash64(F.lit("l"), "node"), F.col("nl")).cast("int")
    columns = ["pivot", "l", "r", "side", "node", "component", "members"]
    lefts = held.filter("rest").withColumns(
        {"l": left_block, "r": F.explode(F.sequence(F.lit(0), F.col("nr") - 1)), "side": F.lit(0)}
    ).select(columns)
    rights = held.withColumns(
        {"r": block, "l": F.explode(F.sequence(F.lit(0), F.col("nl") - 1)), "side": F.lit(1)}
    ).select(columns)
    return lefts.union(rights).groupBy("pivot", "l", "r").applyInPandas(_block_links(percent), "a binary, b binary")


def _components(docs: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Every row's _id, _mark (of the text), doc_id, n_shingles and node; and node, component_id of the nodes."""
    n_bands, width = band_layout(percent)
    signed = stage(
        over_slices(
            docs.select("doc_id", "text", F.xxhash64("text").alias("_mark")), _sign,
            "doc_id long, _mark long, n_shingles long, node binary, bands array<long>", shingle=shingle,
            n_bands=n_bands, width=width,
        ),
        "near-signed",
    )
    nodes = stage(
        signed.filter("node is not null").groupBy("node").agg(
            F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"), F.min(F.struct(id_or_lowest().alias("_id"), "_mark")).alias("row")
        ),
        "near-nodes",
    )
    spots = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stage(spots.groupBy("bucket").count().filter("count > 1").select("bucket"), "near-shared")
    buckets = stage(spots.join(shared, "bucket", "left_semi"), "near-buckets")
    wanted = stage(
        buckets.select("node").distinct().join(nodes, "node").select("node", "row._id", "row._mark"), "near-wanted"
    )
    # always a shuffle: the candidates follow the corpus, so their ids are no small side
    rows = docs.select("text", id_or_lowest().alias("_id"), F.xxhash64("text").alias("_mark"))
    rows = rows.join(wanted.hint("shuffle_merge"), ["_id", "_mark"])
    # the set itself has the last word on which row a node stands for
    sets = stage(
        over_slices(rows.select("node", "text"), _checked_sets, "node binary, members array<long>", shingle=shingle)
        .dropDuplicates(["node"]),
        "near-sets",
    )
    pivots = stage(buckets.groupBy("bucket").agg(F.min("node").alias("pivot")), "near-pivots")
    others = stage(buckets.join(pivots, "bucket").filter("node <> pivot"), "near-others")
    links = stage(_star_links(others, sets, percent), "near-stars")
    labels = smallest_labels(buckets.select("node").distinct(), links)
    more = stage(_rest_links(others, sets, labels, percent), "near-rest")
    if not more.isEmpty():
        labels = smallest_labels(buckets.select("node").distinct(), links.union(more))
    named = nodes.select("node", "doc_id").join(labels, "node", "left")
    named = stage(named.withColumn("component", F.coalesce("component", "node")), "near-named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = stage(named.join(least, "component").select("node", "component", "component_id"), "near-ids")
    return signed.select("doc_id", "_mark", "n_shingles", "node"), ids


def near_groups(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document.

    Two documents are linked if ``percent`` or more of the union of their shingle sets is
    shared; components follow from the links. component_id is the least doc_id of the
    component, and kept marks its document. Documents without words have an empty set and
    are linked with nothing; a null id is never the least one unless it stands alone.
    Rows that share id and text are in one component and all marked kept if one is. An
    empty table gives no rows; other columns are not read.

    Equal sets are one node from the start, so copies cost nothing more. Candidates share
    a band of the SuperMinHash signature, laid out so that a pair at the threshold shares
    none with a probability of 2e-5 at most; every candidate is settled on its full sets.
    Members are first compared with their bucket's least node. Where components still
    differ inside a bucket, the documents outside its largest component are compared with
    all members, block by block. Sets are 64-bit hashes of the shingles; only those of
    candidates are staged.
    """
    signed, ids = _components(docs, percent, shingle)
    out = signed.join(ids, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _checked_sets(part: pa.RecordBatch, texts: list, shingle: int) -> dict:
    """Sets of the rows whose text really has the node's set."""
    keys, begins = shingle_sets(texts, shingle)
    raw = keys.tobytes()
    nodes = part.column("node").to_pylist()
    good = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) == n for n, a, b in zip(nodes, begins[:-1], begins[1:], strict=True)]
    sets = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(keys.view(np.int64)))
    mask = pa.array(good, pa.bool_())
    return {"node": part.column("node").filter(mask), "members": sets.filter(mask)}


def keep_one(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the least doc_id, of repeated rows one.

    Rows are told apart by id and text, so rows without an id, or with one id and several
    texts, are judged each; a row without an id stays only where no other of its component
    has one. Rows without words are linked with nothing and stay, repeated ones once.
    """
    signed, ids = _components(docs, percent, shingle)
    named = signed.join(ids.select("node", "component"), "node", "left")
    group = F.struct("component", F.when(F.col("component").isNull(), F.struct("doc_id", "_mark")))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), id_or_lowest().alias("_id"), "_mark")
    stay = named.groupBy(group.alias("group")).agg(F.min(row).alias("row")).select("row._id", "row._mark")
    stay = stage(stay.distinct(), "near-stay")
    rows = docs.select(id_or_lowest().alias("_id"), F.xxhash64("text").alias("_mark"), F.struct(*docs.columns).alias("row"))
    return rows.join(stay, ["_id", "_mark"], "left_semi").dropDuplicates(["_id", "_mark"]).select("row.*")


NEAR_SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
spots AS (SELECT r, UNNEST(words) AS word, generate_subscripts(words, 1) AS p FROM docs WHERE len(words) >= 3),
triples AS (SELECT r, word || ' ' || LEAD(word) OVER w || ' ' || LEAD(word, 2) OVER w AS s FROM spots WINDOW w AS (PARTITION BY r ORDER BY p)),
sets AS MATERIALIZED (
  SELECT DISTINCT r, s FROM triples WHERE s IS NOT NULL
  UNION ALL SELECT r, array_to_string(words, ' ') FROM docs WHERE len(words) BETWEEN 1 AND 2),
sizes AS MATERIALIZED (SELECT r, COUNT(*) AS n FROM sets GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, COUNT(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
least AS (SELECT reach.a AS r, MIN(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, COALESCE(z.n, 0) AS n_shingles, l.component_id, l.component_id IS NOT DISTINCT FROM d.doc_id AS kept
FROM docs d JOIN least l USING (r) LEFT JOIN sizes z USING (r)
"""
