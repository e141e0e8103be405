"""Token counts with a whole-token shortcut: only what is not one token by proof is merged."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.words import coded, over_slices, split_words, sums_per_text

# The file's pre-token pattern, for lower-case words of the plain letters below.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
WORD_END = "</w>"
# printable ASCII and Latin-1 letters: the normaliser only lower-cases them, one for one
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
SLICE_BYTES = 8 << 20  # little is held besides the words, and larger slices merge fewer of them
_loaded: dict = {}


def tokenizer_from(text: str):
    """The tokenizer of a file's text; each Python worker builds it once."""
    key = hash(text)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded.clear()
        _loaded[key] = Tokenizer.from_str(text)
    return _loaded[key]


def lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def whole_tokens(text: str) -> frozenset[str]:
    """Lower-case ASCII pre-tokens that are proven to encode alone as one token.

    Candidates are the vocabulary's word-end entries that the pattern leaves in one
    piece; each is run through the tokenizer itself.
    """
    tokenizer = tokenizer_from(text)
    found = []
    for token in tokenizer.get_vocab():
        word = token.removesuffix(WORD_END)
        if word != token and word.isascii() and PIECES.fullmatch(word) and PIECES.findall(word) == [word]:
            found.append(word)
    found.sort()
    return frozenset(w for w, n in zip(found, lengths(tokenizer, found), strict=True) if n == 1)


def count_kinds(kinds: list[bytes], tokenizer, whole: frozenset[str]) -> np.ndarray:
    """Tokens of each distinct word.

    A word of plain letters and marks without a special string is cut into pre-tokens:
    proven whole tokens count one, the others are merged by the library once each. Any
    other word goes through the library as it is.
    """
    counts = np.zeros(len(kinds), dtype=np.int64)
    rest: dict[str, list[int]] = {}
    for i, kind in enumerate(kinds):
        word = kind.decode("utf-8", "replace")
        if PLAIN.fullmatch(word) and "<|" not in word:
            lower = word.lower()
            if lower in whole:
                counts[i] = 1
                continue
            for piece in PIECES.findall(lower):
                if piece in whole:
                    counts[i] += 1
                else:
                    rest.setdefault(piece, []).append(i)
        else:
            rest.setdefault(word, []).append(i)
    asked = list(rest)
    for begin in range(0, len(asked), 20_000):
        some = asked[begin:begin + 20_000]
        for word, n in zip(some, lengths(tokenizer, some), strict=True):
            for i in rest[word]:
                counts[i] += n
    return counts


def _work(part: pa.RecordBatch, texts: list, shared) -> dict:
    file_text, whole = shared.value
    lists, starts = split_words(texts)
    kinds, codes = coded(lists, int(starts[-1]))
    per_kind = count_kinds(kinds, tokenizer_from(file_text), whole)
    n_tokens = sums_per_text(per_kind[codes], starts)
    sizes = np.array([len(x) if x else 0 for x in texts], dtype=np.int64)
    return {"doc_id": part.column("doc_id"), "n_bytes": sizes, "n_tokens": n_tokens}


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every text, as the tokenizer file at ``path`` counts them.

    White space ends every pre-token of this kind of file, and its normaliser joins
    nothing across it, so a text's count is the sum over its words. Each slice of texts
    counts each distinct word once. Null and empty texts have no bytes and no tokens;
    repeated rows count each; an empty table gives no rows; other columns are not read.
    The file's text and the proven words are broadcast; the vocabulary bounds both.
    """
    with open(path, encoding="utf-8") as f:
        file_text = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((file_text, whole_tokens(file_text)))
    return over_slices(docs.select("doc_id", "text"), _work, "doc_id long, n_bytes long, n_tokens long", most=SLICE_BYTES, shared=shared)
