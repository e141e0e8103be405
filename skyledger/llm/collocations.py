"""Phrase collocations: counting quotient filters of word-id n-grams, merged across shards without loss."""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.words import coded, mixed, over_slices
from skyledger.operators.joins import BROADCAST_BYTES, attach
from skyledger.sources.staging import stage

LONGEST = 4
SLICE_BYTES = 4 << 20
GROUP_ENTRIES = 2 << 20  # about so many entries, before merging, come together in one merge
LEVEL_BITS = 12  # a filter is cut into so many times as many parts per level of merging
UNKNOWN_LANG = "und"
# fixed values of the contract: ends of a piece, and what parts words
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")


# ---- texts as numbers

def _code(part: pa.RecordBatch, texts: list) -> dict:
    """A row per slice and language: its distinct words, how often each occurs, and all of them in order.

    A code counts from 1; 0 stands where a piece or a text ends.
    """
    held = defaultdict(list)
    for lang, text in zip(part.column("_lang").to_pylist(), texts, strict=True):
        if text:
            held[lang].append(text)
    langs, kinds_of, counts_of, codes_of = [], [], [], []
    for lang, some in held.items():
        tokens = b"\n".join(some).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        kinds, codes = coded([tokens], len(tokens))
        number = np.zeros(len(kinds), dtype=np.int64)
        words = [k for k in kinds if k not in (b"", b"\n")]
        number[[i for i, k in enumerate(kinds) if k not in (b"", b"\n")]] = np.arange(1, len(words) + 1)
        if b"" in kinds:
            codes = codes[codes != kinds.index(b"")]
        codes = number[codes]
        langs.append(lang)
        kinds_of.append(words)
        counts_of.append(np.bincount(codes, minlength=len(words) + 1)[1:])
        codes_of.append(codes.astype(np.uint32).tobytes())
    return {
        "lang": pa.array(langs, pa.string()), "words": pa.array(kinds_of, pa.list_(pa.binary())),
        "counts": pa.array(counts_of, pa.list_(pa.int64())), "codes": pa.array(codes_of, pa.binary()),
    }


def _vocabulary(slices: DataFrame, least: int) -> tuple[DataFrame, int]:
    """lang, word, id and f of the words that occur ``least`` times or more, ids from 1 without gaps; and how many."""
    pairs = slices.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    counted = pairs.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    # a row's place inside its partition, then the partitions' own offsets: one row per partition
    row = F.monotonically_increasing_id()
    frequent = stage(counted.filter(F.col("f") >= least).withColumn("_row", row), "phrases-words")
    part = F.shiftright("_row", 33)
    sizes = frequent.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    named = attach(frequent.withColumn("_part", part), offsets, ["_part"])
    word_id = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    words = stage(named.select("lang", "word", word_id.alias("id"), "f"), "phrases-vocabulary")
    return words, words.count()


# ---- n-grams as permuted keys

def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def _halves(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Word ids packed into two halves of equal width, and that width. ``bits`` per word is even."""
    if len(ids) == 2:
        return ids[0], ids[1], bits
    if len(ids) == 3:
        half = bits // 2
        return ids[0] << _u(half) | ids[1] >> _u(half), (ids[1] & _mask(half)) << _u(bits) | ids[2], bits + half
    return ids[0] << _u(bits) | ids[1], ids[2] << _u(bits) | ids[3], 2 * bits


def _ids(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    if n == 2:
        return [left, right]
    if n == 3:
        half = bits // 2
        middle = (left & _mask(half)) << _u(half) | right >> _u(bits)
        return [left >> _u(half), middle, right & _mask(bits)]
    return [left >> _u(bits), left & _mask(bits), right >> _u(bits), right & _mask(bits)]


_ROUNDS = [(0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64) for i in range(4)]


def permuted(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A bijection of pairs of ``width`` bit numbers (four Feistel rounds)."""
    for key in _ROUNDS:
        left, right = right, left ^ (mixed(right + _u(key)) & _mask(width))
    return left, right


def restored(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that :func:`permuted` was given."""
    for key in reversed(_ROUNDS):
        left, right = right ^ (mixed(left + _u(key)) & _mask(width)), left
    return left, right


def _joined(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """A pair as one number: its first 64 bits, and the rest if there are more."""
    if 2 * width <= 64:
        return left << _u(width) | right, None
    rest = 2 * width - 64
    return left << _u(64 - width) | right >> _u(rest), right & _mask(rest)


def _parted(top: np.ndarray, low: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    if low is None:
        return top >> _u(width), top & _mask(width)
    rest = 2 * width - 64
    return top >> _u(64 - width), (top & _mask(64 - width)) << _u(rest) | low


def _width(n: int, bits: int) -> int:
    return {2: bits, 3: bits + bits // 2, 4: 2 * bits}[n]


# ---- filters

class Filter:
    """Distinct permuted keys in order, with their counts.

    Stored, the leading bits of a key (those after the part's own) are its quotient:
    instead of it, each quotient's run length is kept. The remaining bits follow in
    whole bytes, complete, so nothing is lost, and a counter of one byte; counts of 255
    and more stand apart.
    """

    def __init__(self, top: np.ndarray, low: np.ndarray | None, counts: np.ndarray):
        self.top, self.low, self.counts = top, low, counts

    @classmethod
    def of(cls, top: np.ndarray, low: np.ndarray | None, counts: np.ndarray | None = None) -> Filter:
        """Equal keys become one, their counts added."""
        order = np.argsort(top, kind="stable") if low is None else np.lexsort((low, top))
        top, low = top[order], None if low is None else low[order]
        first = np.ones(len(top), dtype=bool)
        first[1:] = top[1:] != top[:-1]
        if low is not None:
            first[1:] |= low[1:] != low[:-1]
        at = np.flatnonzero(first)
        if counts is None:
            summed = np.diff(np.append(at, len(top)))
        else:
            summed = np.add.reduceat(counts[order], at) if len(at) else counts
        return cls(top[at], None if low is None else low[at], summed)

    @classmethod
    def merged(cls, some: list[Filter]) -> Filter:
        low = None if some[0].low is None else np.concatenate([f.low for f in some])
        return cls.of(np.concatenate([f.top for f in some]), low, np.concatenate([f.counts for f in some]))

    def parts(self, top_bits: int, skip: int) -> Iterator[tuple[int, Filter]]:
        """The filter cut by the first ``skip`` bits of the keys."""
        prefix = self.top >> _u(top_bits - skip) if skip else np.zeros(len(self.top), np.uint64)
        begins = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1])) if len(prefix) else []
        for a, b in zip(begins, [*begins[1:], len(prefix)], strict=True):
            yield int(prefix[a]), Filter(self.top[a:b], None if self.low is None else self.low[a:b], self.counts[a:b])

    def stored(self, top_bits: int, low_bits: int, skip: int) -> bytes:
        bits, n = top_bits - skip, len(self.top)
        quotient_bits = min(range(bits % 8, min(bits, 24) + 1, 8), key=lambda q: (1 << q) + n * ((bits - q) // 8))
        rest, low_bytes = (bits - quotient_bits) // 8, -(-low_bits // 8)
        quotient = (self.top & _mask(bits)) >> _u(8 * rest)
        runs = np.bincount(quotient.astype(np.int64), minlength=1 << quotient_bits)
        wide = 1 if runs.max(initial=0) < 256 else 4
        many = self.counts >= 255
        head = struct.pack("<IBBBBI", n, quotient_bits, rest, low_bytes, wide, int(many.sum()))
        return b"".join([
            head, runs.astype(f"<u{wide}").tobytes(), _low_bytes(self.top, rest),
            _low_bytes(self.low, low_bytes) if low_bytes else b"",
            np.where(many, 255, self.counts).astype(np.uint8).tobytes(), self.counts[many].astype("<i8").tobytes(),
        ])

    @classmethod
    def loaded(cls, data: bytes, top_bits: int, skip: int, prefix: int) -> Filter:
        n, quotient_bits, rest, low_bytes, wide, n_many = struct.unpack_from("<IBBBBI", data)
        at = struct.calcsize("<IBBBBI")

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        runs = take(1 << quotient_bits, f"<u{wide}")
        quotient = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), runs)
        top = quotient << _u(8 * rest) | _from_bytes(take(n * rest, "u1"), n, rest)
        if skip:
            top |= _u(prefix << (top_bits - skip))
        low = _from_bytes(take(n * low_bytes, "u1"), n, low_bytes) if low_bytes else None
        counts = take(n, "u1").astype(np.int64)
        counts[counts == 255] = take(n_many, "<i8")
        return cls(top, low, counts)


def _low_bytes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_bytes(data: np.ndarray, n: int, width: int) -> np.ndarray:
    full = np.zeros((n, 8), dtype=np.uint8)
    full[:, :width] = data.reshape(n, width)
    return full.view("<u8").ravel()


def _bits_of(n: int, bits: int) -> tuple[int, int]:
    """Bits of a key's first number and of its second."""
    both = 2 * _width(n, bits)
    return min(both, 64), max(both - 64, 0)


def _filter_rows(lang: str, n: int, whole: Filter, bits: int, skip: int) -> Iterator[tuple]:
    top_bits, low_bits = _bits_of(n, bits)
    for prefix, part in whole.parts(top_bits, skip):
        yield lang, n, prefix, part.stored(top_bits, low_bits, skip)


FILTER_ROW = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("prefix", pa.int64()), ("filter", pa.binary())])
FILTER_DDL = "lang string, n int, prefix long, filter binary"


def _shard_filters(slices: DataFrame, vocabulary: dict | None, bits: int, skip: int) -> DataFrame:
    """Filters of each slice's n-grams of 2, 3 and 4 frequent words, cut by ``skip`` bits."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lang = row.column("lang")[0].as_py()
                codes = np.frombuffer(row.column("codes")[0].as_py(), dtype=np.uint32)
                if vocabulary is None:
                    ids = np.zeros(row.column("size")[0].as_py() + 1, dtype=np.uint64)
                    ids[row.column("places")[0].values.to_numpy() + 1] = row.column("ids")[0].values.to_numpy()
                else:
                    words = row.column("words")[0].values
                    ids = np.zeros(len(words) + 1, dtype=np.uint64)
                    known, numbers = vocabulary.get(lang, (pa.array([], pa.binary()), np.zeros(0, np.uint64)))
                    found = pc.index_in(words, value_set=known)
                    hit = found.is_valid().to_numpy(zero_copy_only=False)
                    ids[1:][hit] = numbers[found.drop_null().to_numpy()]
                ids = ids[codes]
                rows = []
                inside = ids > 0
                for n in range(2, LONGEST + 1):
                    inside = inside[:max(len(ids) - n + 1, 0)] & (ids[n - 1:] > 0)
                    at = np.flatnonzero(inside)
                    if not len(at):
                        break
                    left, right, width = _halves([ids[at + k] for k in range(n)], bits)
                    whole = Filter.of(*_joined(*permuted(left, right, width), width))
                    rows.extend(_filter_rows(lang, n, whole, bits, skip))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), FILTER_ROW, strict=True)], schema=FILTER_ROW
                    )

    return slices.mapInArrow(run, FILTER_DDL)


def _gathered(batches, n: int, bits: int, skip: int) -> Filter:
    """All filters of a group as one; few more entries are held than the result has."""
    top_bits, _ = _bits_of(n, bits)
    held, fresh = [], 0
    for batch in batches:
        for data, prefix in zip(batch.column("filter"), batch.column("prefix").to_pylist(), strict=True):
            some = Filter.loaded(data.as_buffer().to_pybytes(), top_bits, skip, prefix)
            held.append(some)
            fresh += len(some.top)
        if fresh > GROUP_ENTRIES:
            held, fresh = [Filter.merged(held)], 0
    return Filter.merged(held)


def _remerged(filters: DataFrame, bits: int, skip: int, wider: int) -> DataFrame:
    """A level of merging: the filters of a part, some at a time, become one that is cut more finely."""

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, n = key[0].as_py(), key[1].as_py()
        rows = list(_filter_rows(lang, n, _gathered(batches, n, bits, skip), bits, wider))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), FILTER_ROW, strict=True)], schema=FILTER_ROW
        )

    some = F.pmod(F.xxhash64("filter"), F.lit(1 << (wider - skip)))
    return filters.withColumn("some", some).groupBy("lang", "n", "prefix", "some").applyInArrow(merge, FILTER_DDL)


def _frequent(filters: DataFrame, bits: int, skip: int, least: int) -> DataFrame:
    """lang, ids and f of the n-grams that occur ``least`` times or more: the last merge, and the keys turned back."""

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, n = key[0].as_py(), key[1].as_py()
        whole = _gathered(batches, n, bits, skip)
        keep = whole.counts >= least
        width = _width(n, bits)
        pair = _parted(whole.top[keep], None if whole.low is None else whole.low[keep], width)
        ids = np.stack(_ids(*restored(*pair, width), n, bits), axis=1).astype(np.int64)
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(ids), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(ids.ravel())), pa.array(whole.counts[keep])],
            names=["lang", "ids", "f"],
        )

    return filters.groupBy("lang", "n", "prefix").applyInArrow(merge, "lang string, ids array<long>, f long")


def _with_ids(slices: DataFrame, words: DataFrame, n_words: int, most_bytes: int) -> tuple[DataFrame, dict | None]:
    """The slices with what their words' ids are read from.

    A vocabulary of few bytes goes to all tasks; any other is joined to the slices' own words.
    """
    size = words.agg(F.sum(F.octet_length("word") + 16)).first()[0] or 0
    if size <= most_bytes:
        found = words.select("lang", "word", "id").toArrow()
        by_lang = {}
        for lang in pc.unique(found.column("lang")).to_pylist():
            mine = found.filter(pc.equal(found.column("lang"), lang))
            by_lang[lang] = (mine.column("word").combine_chunks(), mine.column("id").to_numpy().astype(np.uint64))
        return slices.select("lang", "words", "codes"), by_lang
    spots = slices.select("slice", "lang", F.posexplode("words").alias("place", "word"))
    hits = spots.join(words.select("lang", "word", "id"), ["lang", "word"])
    lists = hits.groupBy("slice").agg(F.collect_list(F.struct("place", "id")).alias("x"))
    told = lists.select("slice", F.col("x.place").alias("places"), F.col("x.id").alias("ids"))
    return slices.select("slice", "lang", "codes", F.size("words").alias("size")).join(told, "slice"), None


def count_phrases(docs: DataFrame, least: int = 30, most_bytes: int = BROADCAST_BYTES // 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The frequent phrases' lang, ids and f (one word to four), the vocabulary, and lang and n (all words).

    Texts are coded by slices. Only words that occur ``least`` times get an id, as no
    phrase is more frequent than its words. Each slice's n-grams of ids are packed,
    permuted by a bijection and kept in a counting quotient filter, whose parts are merged
    across slices by the leading bits: parts are even whatever the phrases are, and a
    phrase in every text is one entry per slice. A part holds about two million entries;
    where that takes more parts than a slice's filter can sensibly be cut into, merging
    goes in levels.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG))
    rows = docs.select(lang.alias("_lang"), F.col("text").cast("string").alias("text"))
    schema = "lang string, words array<binary>, counts array<long>, codes binary"
    found = over_slices(rows, _code, schema, most=SLICE_BYTES)
    slices = stage(found.withColumn("slice", F.monotonically_increasing_id()), "phrases-slices")
    words, n_words = _vocabulary(slices, least)
    counted = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = stage(slices.groupBy("lang").agg(F.sum(counted).alias("n")), "phrases-totals")
    bits = max(16, 2 * -(-(n_words + 1).bit_length() // 2))
    total = totals.agg(F.sum("n")).first()[0] or 0
    wanted = min((total // GROUP_ENTRIES).bit_length(), 2 * bits)
    known, vocabulary = _with_ids(slices, words, n_words, most_bytes)
    skip = min(wanted, LEVEL_BITS)
    filters = _shard_filters(known, vocabulary, bits, skip)
    while skip < wanted:
        wider = min(wanted, skip + LEVEL_BITS)
        filters = stage(_remerged(filters, bits, skip, wider), "phrases-filters")
        skip = wider
    single = words.select("lang", F.array("id").alias("ids"), "f")
    grams = stage(single.unionByName(_frequent(filters, bits, skip, least)), "phrases-counts")
    return grams, words, totals


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def mine_phrases(docs: DataFrame, least: int = 30, top: int = 2000, most_bytes: int = BROADCAST_BYTES // 4) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases of two to four words.

    Texts are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends, pieces
    into words at blanks and tabs. A phrase that occurs a >= ``least`` times inside pieces
    is a candidate; of its cuts the one with the lowest floor(2000000 * a / (l + r))
    counts, the earliest of equal ones, where l and r are the frequencies of the two
    parts. A candidate goes if its words lie inside a longer candidate with 100 * f >= 80
    * a. Order: score and a descending, then the phrase's bytes.

    A null lang is ``und``, as is the lang of that name; null and empty texts have no
    words; repeated rows count again; ids do not matter; languages without a candidate
    and empty tables give no rows; other columns are not read.
    """
    grams, words, totals = count_phrases(docs, least, most_bytes)
    size = F.size("ids")
    phrases = grams.filter(size >= 2).withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumns(
        {"left": F.slice("ids", 1, F.col("k")), "right": F.slice("ids", F.col("k") + 1, size - F.col("k"))}
    )
    cuts = attach(cuts, grams.select(F.col("ids").alias("left"), F.col("f").alias("l")), ["left"])
    cuts = attach(cuts, grams.select(F.col("ids").alias("right"), F.col("f").alias("r")), ["right"])
    # the quotient of the decimals is cut to a whole number exactly
    score = F.expr("CAST(CAST(a AS DECIMAL(20,0)) * 2000000 AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.groupBy("lang", "ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("ids", i, m)),
    ))
    inside = grams.filter(size >= 3).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    covered = F.coalesce(_exact("longer") * 100 >= _exact("a") * 80, F.lit(False))
    kept = attach(best, stage(inside, "phrases-inside"), ["ids"]).filter(~covered)
    kept = kept.select("lang", "ids", "a", "x.l", "x.r", "x.score")
    order = [F.desc("score"), F.desc("a")]
    # rows that tie with the last place stay until their words are known
    first = kept.withColumn("_at", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("_at") <= top)
    first = stage(first.drop("_at"), "phrases-first")
    spelled = attach(first.select("ids", F.posexplode("ids").alias("place", "id")), words.select("id", "word"), ["id"])
    spelled = spelled.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("x"))
    text = F.concat_ws(" ", F.transform("x.word", lambda w: w.cast("string")))
    named = first.join(spelled.select("ids", text.alias("phrase")), "ids")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    ranked = named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return attach(ranked, totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, UNNEST(string_split_regex(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
places AS (SELECT lang, w, m, UNNEST(range(1, len(w) - m + 2)) AS i FROM lists, range(1, 5) AS sizes(m) WHERE len(w) >= m),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, COUNT(*) AS f
  FROM places GROUP BY ALL HAVING COUNT(*) >= 30),
cuts AS (
  SELECT lang, m, phrase, f, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first_part,
    array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS rest
  FROM grams, range(1, 4) AS cut(k) WHERE k < m),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
    (CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first_part
  JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest),
best AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1),
inside AS (
  SELECT g.lang, array_to_string(string_split(g.phrase, ' ')[i:i + s - 1], ' ') AS phrase, MAX(g.f) AS longer
  FROM grams g, range(1, 4) AS start(i), range(2, 4) AS sizes(s)
  WHERE g.m >= 3 AND s < g.m AND i + s - 1 <= g.m GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE NOT COALESCE(CAST(i.longer AS HUGEINT) * 100 >= CAST(b.a AS HUGEINT) * 80, FALSE)),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t USING (lang) WHERE r.rank <= 2000
"""
