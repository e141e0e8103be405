"""Substring dedup: difference-cover anchors find long repeats, full windows settle them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.words import (
    coded, fitting, hashes, id_or_lowest, mixed, over_slices, owners, split_words, window_hashes,
)
from skyledger.sources.staging import stage

# Perfect difference sets; every number modulo the period is a difference of two members.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (1, 5, 11, 24, 25, 27)}
PLACE_BITS = 38
SECOND_BASE = 0xD1B54A32D192ED03


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least two fifths of the window."""
    fitting_ones = [p for p in COVERS if (window - p + 1) * 5 >= window * 2]
    if not fitting_ones:
        raise ValueError("the window is too short for an anchor")
    return max(fitting_ones)


def _word_values(texts: list) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    lists, starts = split_words(texts)
    total = int(starts[-1])
    kinds, codes = coded(lists, total)
    return lists, starts, hashes(kinds, len(kinds))[codes] if total else np.zeros(0, np.uint64)


def _key_and_mark() -> tuple[Column, Column]:
    """A row's number, hashed from id and text, and further bits of the text: 89 bits that tell rows apart.

    Rows of one id, or without one, are thus as far apart as any others.
    """
    return F.xxhash64(id_or_lowest(), "text"), F.shiftrightunsigned(F.xxhash64("text"), PLACE_BITS + 1)


def _rows(docs: DataFrame) -> DataFrame:
    """_id (the row's number), _mark, doc_id and text."""
    key, mark = _key_and_mark()
    return docs.select(key.alias("_id"), mark.alias("_mark"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _numbers(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a slice's rows, and their marks in the high bits of a place."""
    return part.column("_id").to_numpy(), part.column("_mark").to_numpy() << PLACE_BITS


ROW = "h long, _id long, place long, weight byte, more array<long>"


def _emitted(key: np.ndarray, at: np.ndarray, owner: np.ndarray, ids: np.ndarray, marks: np.ndarray, starts: np.ndarray, more=None) -> dict:
    """Rows for places with hashes: of equal hashes in one slice only the first travels.

    ``weight`` 2 says that the slice itself holds the hash twice, so a passage that is in
    every document is one row per slice at its own key. The other places are known to be
    repeats; each document's come as one row of weight 0 under a key of the document.
    """
    order = np.argsort(key, kind="stable") if more is None else np.lexsort((more, key))
    key = key[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    if more is not None:
        more = more[order]
        first[1:] |= more[1:] != more[:-1]
    lead = np.flatnonzero(first)
    weight = np.minimum(np.diff(np.append(lead, len(key))), 2).astype(np.int8)
    at, owner = at[order], owner[order]
    place = marks[owner] | (at - starts[owner])
    rest = np.flatnonzero(~first)
    rest = rest[np.argsort(owner[rest], kind="stable")]
    docs, begins = np.unique(owner[rest], return_index=True)
    packed = mixed((ids[docs] ^ marks[docs]).view(np.uint64))
    n, k = len(lead), len(docs)
    offsets = np.concatenate([np.zeros(n, dtype=np.int32), np.append(begins, len(rest)).astype(np.int32)])
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[rest]), mask=pa.array(np.arange(n + k) < n))
    out = {
        "h": np.concatenate([key[lead], packed]).view(np.int64), "_id": np.concatenate([ids[owner[lead]], ids[docs]]),
        "place": pa.array(np.concatenate([place[lead], np.zeros(k, np.int64)]), mask=np.arange(n + k) >= n),
        "weight": np.concatenate([weight, np.zeros(k, np.int8)]), "more": lists,
    }
    if more is not None:
        high = (more >> np.uint64(32)).astype(np.uint32).view(np.int32)
        out["h2"] = np.concatenate([high[lead], np.zeros(k, np.int32)])
    return out


def _anchors(part: pa.RecordBatch, texts: list, window: int, period: int) -> dict:
    """Hashes of the short windows at cover positions of texts that hold a whole window."""
    length = window - period + 1
    _, starts, values = _word_values(texts)
    owner = owners(starts)
    found = window_hashes(values, length)
    inside = fitting(starts, length)
    covered = np.zeros(period, dtype=bool)
    covered[list(COVERS[period])] = True
    local = np.arange(len(owner)) - starts[owner]
    long_enough = np.diff(starts)[owner] >= window
    at = np.flatnonzero(inside & (covered[local % period] & long_enough)[:len(inside)])
    ids, marks = _numbers(part)
    return _emitted(found[at], at, owner[at], ids, marks, starts)


def _windows(part: pa.RecordBatch, texts: list, window: int, period: int) -> dict:
    """Full-window hashes, of 64 and of 32 bits, of the windows around each repeated anchor."""
    _, starts, values = _word_values(texts)
    total = int(starts[-1])
    owner = owners(starts)
    ids, marks = _numbers(part)
    steps = np.zeros(total + 1, dtype=np.int64)
    for i, places in enumerate(part.column("places")):
        mine = places.values.to_numpy() & ((1 << PLACE_BITS) - 1)
        np.add.at(steps, starts[i] + np.maximum(0, mine - period + 1), 1)
        np.add.at(steps, np.minimum(starts[i] + mine + 1, total), -1)
    inside = fitting(starts, window)
    wanted = inside & (np.cumsum(steps)[:total] > 0)[:len(inside)]
    at = np.flatnonzero(wanted)
    one = window_hashes(values, window)[at]
    two = window_hashes(mixed(values ^ np.uint64(SECOND_BASE)), window, SECOND_BASE)[at]
    return _emitted(one, at, owner[at], ids, marks, starts, two)


def _repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """_id, _mark and places of the rows whose hash occurs at another place too.

    A hash has at most one row with weight per slice of texts, however many places it has.
    Places are kept once, however often a row is repeated.
    """
    seen = F.sum("weight").over(Window.partitionBy(*keys))
    twice = rows.withColumn("n", seen).filter((F.col("weight") == 0) | (F.col("n") > 1))
    places = twice.select("_id", F.explode(F.coalesce("more", F.array("place"))).alias("place"))
    mark = F.shiftright("place", PLACE_BITS)
    return stage(places.groupBy("_id", mark.alias("_mark")).agg(F.collect_set("place").alias("places")), name)


def _plain_rows(part: pa.RecordBatch, texts: list) -> dict:
    """Every text as if all its words were kept."""
    lists = [x.split() if x else [] for x in texts]
    return {
        "_id": part.column("_id"), "_mark": part.column("_mark"), "doc_id": part.column("doc_id"),
        "n_words": np.array([len(w) for w in lists], dtype=np.int64),
        "kept_sha256": pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in lists], pa.string()),
    }


def _covered(places: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words the windows at ``places`` cover."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + window, -1)
    return np.cumsum(steps)[:n] > 0


def _kept_words(places, words: list[bytes], window: int) -> tuple[list[bytes], int]:
    """The words that stay, and how many go."""
    gone = _covered(places.values.to_numpy() & ((1 << PLACE_BITS) - 1), len(words), window)
    return [w for w, g in zip(words, gone, strict=True) if not g], int(gone.sum())


def _changed_rows(part: pa.RecordBatch, texts: list, window: int, with_text: bool) -> dict:
    removed, joined = [], []
    for places, text in zip(part.column("places"), texts, strict=True):
        kept, n = _kept_words(places, (text or b"").split(), window)
        removed.append(n)
        joined.append(b" ".join(kept))
    out = {"_id": part.column("_id"), "_mark": part.column("_mark"), "n_removed": np.array(removed, dtype=np.int64)}
    if with_text:
        return out | {"kept": pa.array(joined, pa.binary())}
    return out | {"kept": pa.array([hashlib.sha256(x).hexdigest() for x in joined], pa.string())}


def _changes(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    """_id, _mark, n_removed and kept (the text, or its checksum) of what loses words, once per id and text."""
    period = period_for(window)
    rows = _rows(docs).drop("doc_id")
    anchors = over_slices(rows, _anchors, ROW, window=window, period=period)
    near = _repeated(anchors, ["h"], "substring-anchors")
    suspects = stage(rows.join(near, ["_id", "_mark"]), "substring-suspects")
    windows = over_slices(suspects, _windows, "h2 int, " + ROW, window=window, period=period)
    twice = _repeated(windows, ["h", "h2"], "substring-windows")
    told = suspects.drop("places").join(twice, ["_id", "_mark"])
    schema = f"_id long, _mark long, n_removed long, kept {'binary' if with_text else 'string'}"
    changed = over_slices(told, _changed_rows, schema, window=window, with_text=with_text)
    return stage(changed.filter("n_removed > 0").dropDuplicates(["_id", "_mark"]), "substring-changed")


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row.

    Words are what lies between ASCII white space. A word goes if it is covered by a
    window of ``window`` words whose sequence also starts anywhere else, in any document
    or the same one; all occurrences go, judged on the input. kept_sha256 is of the kept
    words joined by one space. Null and empty texts have no words; repeated rows are
    occurrences of each other; rows are told apart by id and text, with an id or without; an empty table gives no rows;
    other columns are not read.

    Anchors are hashed only at positions in a difference cover modulo a period: two equal
    windows, wherever they begin, have an anchor at the same distance from their begin
    (period 21 and anchors of 15 words for windows of 35). A repeated anchor makes the
    windows around it suspects; these alone are hashed whole, with 96 bits, and settled.
    Texts are shuffled once, to the suspects' places.
    """
    changed = _changes(docs, window, with_text=False)
    whole = over_slices(_rows(docs), _plain_rows, "_id long, _mark long, doc_id long, n_words long, kept_sha256 string")
    out = whole.join(changed, ["_id", "_mark"], "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "kept_sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with the text of rows that lose words replaced by the kept words; other rows stay as they are."""
    changed = _changes(docs, window, with_text=True).select("_id", "_mark", "kept")
    key, mark = _key_and_mark()
    rows = docs.select(key.alias("_id"), mark.alias("_mark"), F.struct(*docs.columns).alias("row"))
    out = rows.join(changed, ["_id", "_mark"], "left")
    text = F.when(F.col("kept").isNotNull(), F.decode("kept", "utf-8")).otherwise(F.col("row.text"))
    return out.select(F.col("row").withField("text", text).alias("row")).select("row.*")


REPEATS_SQL = r"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spots AS MATERIALIZED (SELECT r, UNNEST(words) AS word, generate_subscripts(words, 1) AS p FROM docs),
windows AS (
  SELECT r, p, string_agg(word, ' ') OVER w AS text, COUNT(*) OVER w AS n FROM spots
  WINDOW w AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
marked AS MATERIALIZED (SELECT r, p, md5(text) AS mark FROM windows WHERE n = 35),
starts AS (SELECT r, p FROM marked WHERE mark IN (SELECT mark FROM marked GROUP BY mark HAVING COUNT(*) > 1)),
gone AS (SELECT DISTINCT r, p + i AS p FROM starts, range(0, 35) AS steps(i)),
kept AS (
  SELECT r, COUNT(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM spots s WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.r = s.r AND g.p = s.p) GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - COALESCE(k.n, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (r)
"""
