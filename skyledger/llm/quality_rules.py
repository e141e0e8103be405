"""Quality rules: fixed counts of a text, and how well a public vocabulary fits it."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import (
    coded, fitting, hashes, mixed, over_slices, owners, split_words, sums_per_text, window_hashes,
)
from skyledger.operators.joins import attach
from skyledger.operators.quantiles import exact_quantiles
from skyledger.sources.staging import stage

SYMBOLS = b"#*$%&|<>"
NOT_COUNTED = bytes(range(0x80, 0xC0)) + b" \t\n\v\f\r"  # continuation bytes and white space
WINDOW = 5
PRIOR_ROWS = 50  # documents that weigh as much as what is known of the wider group
WIDTH = 3.0
MEASURES = ("chars_per_token", "byte_share", "entropy")
# judged as a share of the most that so many tokens can have
JUDGED = ("chars_per_token", "byte_share", "entropy_share")
LEAST_REACH = {"chars_per_token": 0.05, "byte_share": 0.01, "entropy_share": 0.0125}
_loaded: dict = {}

# Where the blocks of scripts begin, by code point; letters of no block named are "other".
SCRIPTS = {
    0x41: "latin", 0x250: "other", 0x370: "greek", 0x400: "cyrillic", 0x530: "armenian", 0x590: "hebrew", 0x600: "arabic",
    0x700: "other", 0x750: "arabic", 0x780: "other", 0x8A0: "arabic", 0x900: "devanagari", 0x980: "indic", 0xE00: "thai",
    0xE80: "other", 0x10A0: "georgian", 0x1100: "hangul", 0x1200: "other", 0x1E00: "latin", 0x1F00: "greek", 0x2000: "other",
    0x3040: "kana", 0x3130: "hangul", 0x3190: "other", 0x3400: "han", 0xA000: "other", 0xAC00: "hangul", 0xD7B0: "other",
    0xF900: "han", 0xFB00: "latin", 0xFB13: "other",
}
_BEGINS, _NAMES = list(SCRIPTS), list(SCRIPTS.values())
_KINDS = sorted({*_NAMES, "none"})

BASE_COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def processor_from(model: bytes):
    """The library's processor of a model file's bytes; each Python worker builds it once."""
    key = hash(model)
    if key not in _loaded:
        import sentencepiece

        _loaded.clear()
        _loaded[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _loaded[key]


def n_dup_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(kind_hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text, the words in windows of five that its text holds twice or more."""
    total = int(starts[-1])
    inside = fitting(starts, WINDOW)
    covered = np.zeros(total, dtype=np.int64)
    if inside.any():
        at = np.flatnonzero(inside)
        owner = mixed(owners(starts).astype(np.uint64) + np.uint64(1))
        keys = window_hashes(kind_hashes[codes], WINDOW)[at] ^ owner[at]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        steps = np.zeros(total + 1, dtype=np.int64)
        begins = at[twice]
        np.add.at(steps, begins, 1)
        np.add.at(steps, begins + WINDOW, -1)
        covered = (np.cumsum(steps)[:total] > 0).astype(np.int64)
    return sums_per_text(covered, starts)


def entropy(ids: np.ndarray) -> float:
    """Bits per token of one text's own token frequencies."""
    if not len(ids):
        return 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum())


def script_of(word: str) -> int:
    """Number of the script of a word's first letter among the sorted names; a word without one has ``none``."""
    letter = next((c for c in word if c.isalpha()), None)
    return _KINDS.index(_NAMES[bisect_right(_BEGINS, ord(letter)) - 1] if letter else "none")


def scripts_of_texts(kinds: list[str], codes: np.ndarray, starts: np.ndarray) -> list[str]:
    """The script that most words of each text with letters are in; the first by name of equal ones."""
    n, none = len(_KINDS), _KINDS.index("none")
    of_kind = np.fromiter(map(script_of, kinds), dtype=np.int64, count=len(kinds))
    table = np.bincount(owners(starts) * n + of_kind[codes], minlength=(len(starts) - 1) * n).reshape(-1, n)
    table[:, none] = 0
    return [_KINDS[i] if most else "none" for i, most in zip(table.argmax(axis=1), table.max(axis=1), strict=True)]


def _measure(part: pa.RecordBatch, texts: list, shared) -> dict:
    processor = processor_from(shared.value)
    lists, starts = split_words(texts)
    total = int(starts[-1])
    kinds, codes = coded(lists, total)
    spelled = [k.decode("utf-8", "replace") for k in kinds]
    pieces = processor.encode(spelled, num_threads=1) if kinds else []
    per_kind = np.array([len(p) for p in pieces], dtype=np.int64)
    flat = np.fromiter((x for p in pieces for x in p), dtype=np.int64, count=int(per_kind.sum()) if kinds else 0)
    is_byte = np.array([processor.is_byte(i) for i in range(processor.vocab_size())], dtype=np.int64)
    ends = np.cumsum(per_kind)
    begins = ends - per_kind
    bytes_per_kind = (
        np.concatenate([[0], np.cumsum(is_byte[flat])])[ends] - np.concatenate([[0], np.cumsum(is_byte[flat])])[begins]
        if kinds else per_kind
    )
    entropies = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        c = codes[a:b]
        n = per_kind[c]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        entropies.append(entropy(flat[np.repeat(begins[c], n) + within]))
    of_kind = hashes(kinds, len(kinds))
    return {
        "doc_id": part.column("doc_id"), "lang": part.column("lang"),
        "n_words": np.diff(starts),
        "word_chars": np.array([len(x.translate(None, NOT_COUNTED)) if x else 0 for x in texts], dtype=np.int64),
        "n_symbols": np.array([len(x) - len(x.translate(None, SYMBOLS)) if x else 0 for x in texts], dtype=np.int64),
        "n_dup_lines": np.array([n_dup_lines(x) if x else 0 for x in texts], dtype=np.int64),
        "n_repeat_words": repeated_words(of_kind, codes, starts),
        "n_tokens": sums_per_text(per_kind[codes], starts) if total else np.zeros(len(texts), np.int64),
        "n_byte_tokens": sums_per_text(bytes_per_kind[codes], starts) if total else np.zeros(len(texts), np.int64),
        "entropy": np.array(entropies, dtype=np.float64), "script": scripts_of_texts(spelled, codes, starts),
    }


def measures(docs: DataFrame, path: str) -> DataFrame:
    """Per document the base counts, its script, and n_tokens, n_byte_tokens and entropy under the vocabulary at ``path``.

    Each word is encoded on its own, as the vocabulary has no piece across white space.
    A null or empty text has 0 everywhere. The model file's bytes are broadcast.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = f"doc_id long, lang string, {BASE_COLUMNS}, n_tokens long, n_byte_tokens long, entropy double, script string"
    return over_slices(docs.select("doc_id", "lang", "text"), _measure, schema, shared=shared)


def _rates(measured: DataFrame) -> DataFrame:
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))
    return measured.withColumns({
        "chars_per_token": F.col("word_chars") / tokens,
        "byte_share": F.col("n_byte_tokens") / tokens,
        "entropy_share": F.col("entropy") / F.log2(F.greatest("n_tokens", F.lit(2)).cast("double")),
        "base_failed": (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20),
        # texts of like length are judged together: entropy rises with the number of words
        "octave": F.floor(F.log2(F.greatest("n_words", F.lit(1)).cast("double"))).cast("int"),
        "language": F.coalesce("lang", F.lit("")), "corpus": F.lit(0),
    })


def bands(rated: DataFrame, by: list[str], width: float = WIDTH) -> DataFrame:
    """Per group of ``by``, low and high of each judged measure, and the number of documents behind them.

    From the exact quartiles of the documents that pass the base rules, ``width`` times
    their distance (a small least distance) beyond them.
    """
    passed = rated.filter("not base_failed")
    found = exact_quantiles(passed, list(JUDGED), [0.25, 0.75], by)
    ends = {}
    for m in JUDGED:
        q = [F.max(F.when((F.col("measure") == m) & (F.col("probability") == p), F.col("quantile"))) for p in (0.25, 0.75)]
        reach = F.greatest(q[1] - q[0], F.lit(LEAST_REACH[m])) * width
        ends[m] = F.struct((q[0] - reach).alias("low"), (q[1] + reach).alias("high"))
    ranges = found.groupBy(*by).agg(*[end.alias(m) for m, end in ends.items()])
    counts = passed.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.join(ranges, by).select(*by, F.struct("n", *JUDGED).alias("band"))


# from the widest group to the narrowest, and how much wider than the narrowest its band is
LEVELS = {
    "band_all": (["corpus"], 2), "band_script": (["script"], 2), "band_language": (["language"], 2), "band_near": (["language", "octave"], 1),
}


def judge(docs: DataFrame, path: str, width: float = WIDTH, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """All measures of each document with base_failed and kept.

    A document is kept if it passes the base rules and every measure lies in its band;
    the entropy counts as a share of the most that its number of tokens allows. One law
    holds for any number of documents: the band of a language and length (octave of words)
    with n documents counts n / (n + ``prior_rows``), the rest is the language's band for
    all lengths, which is shrunk in the same way towards that of the script most words of
    the text are in, and this one towards the corpus's. The wider bands are twice as wide.
    So a text of a language of which nothing else is known is judged by what its script
    and the corpus allow. A null language is a language of its own. Rows count singly,
    repeated ones too; an empty table gives no rows; other columns are not read. The texts
    are read once; the bands come from the staged measures.
    """
    rated = stage(_rates(measures(docs, path)), "quality-measures")
    joined, low, high = rated, {}, {}
    for name, (by, times) in LEVELS.items():
        found = stage(bands(rated, by, width * times), f"quality-{name}-bands")
        joined = attach(joined, found.withColumnRenamed("band", name), by)
        n = F.coalesce(F.col(f"{name}.n"), F.lit(0))
        share = n / (n + prior_rows)
        for m in JUDGED:
            for ends, end in ((low, "low"), (high, "high")):
                own = F.col(f"{name}.{m}.{end}")
                ends[m] = share * F.coalesce(own, F.lit(0.0)) + (1 - share) * ends[m] if m in ends else own
    fits = F.lit(True)
    for m in JUDGED:
        fits = fits & F.col(m).between(low[m], high[m])
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        # without a document that passes the base rules there is no band, and none to judge
        (~F.col("base_failed") & F.coalesce(fits, F.lit(True))).alias("kept"), "n_tokens", *MEASURES,
    )
