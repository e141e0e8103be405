"""Toxicity: noisy-channel restoring of disguised words, then a score of the restored text.

Disguised words (leetspeak, masked letters, letters set apart, words cut by a mark, drawn-out
or doubled letters) become lattices of possible letters. A Viterbi search under a character
trigram model, counted over all documents, picks the likeliest word. A word whose lattice has
one path stays. A mark inside a word may also be what it seems, the end of one word and the
beginning of another, so that ordinary compounds stay. Letters that the model does not know
stand for themselves. Words set apart in chunks of several letters are not joined.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.quality_model import ftrl, held_out, labelled_sample
from skyledger.llm.words import coded, hashes, over_slices, slices, split_words

# What a disguised letter may stand for; an empty string means nothing at all.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
}
MASKED = "aeiou"
SEPARATORS = "._-~'*/\\"
HIDING = "#%&"  # may hide a vowel, as the asterisk does
KEPT = "-_.#%&"  # may as well be meant
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())

SIZE = 64  # classes: 0 is a word's edge, 1.. are the letters, the last is anything else
OTHER = SIZE - 1
CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_CLASS_OF = np.full(0x110000, OTHER, dtype=np.uint8)
_CLASS_OF[[ord(c) for c in CLASS]] = list(CLASS.values())
_CLASS_OF[[ord(c.upper()) for c in CLASS if len(c.upper()) == 1]] = [k for c, k in CLASS.items() if len(c.upper()) == 1]
_CLASS_OF[ord("\n")] = 0

LEET_COST, MASK_COST, DROP_COST, PAIR_COST, BREAK_COST = 0.7, 1.5, 0.3, 3.0, 1.0
UNKNOWN_COST = 1.0  # of a letter that the model does not know, which stands for itself
PAIRS = 4  # pairs of equal letters in a row that count as a disguise; no plain word has more than three
MEMO, MEMO_LETTERS = 65_536, 64  # restored words that a worker keeps at hand, and the longest of them
RUN = 3  # single letters in a row, or equal letters in a row, that count as a disguise
BITS = 20
SAMPLE = 8_000
EPOCHS = 5
_EDGE = re.compile(r"^[^\w@$!|+(<€£¥*]+|[^\w@*]+$")
_DRAWN = re.compile(r"([^\W\d_])\1\1|(?:([^\W\d_])\2){%d}" % PAIRS)
_PAIRED = re.compile(r"(?:([^\W\d_])\1){%d,}" % PAIRS)
_CUT = re.compile(r"[^\W\d_][-_.#%&]+[^\W\d_]")
_APART = re.compile(r"[^\W_](?:[._\-~'*/\\]+[^\W_]){2,}")
_DISGUISE = re.compile(r"[0-9@$!|+(<€£¥*]")
_SINGLE = re.compile(r"(?:[^\W_]|[@$!|+(<€£¥*])[.,\-]?")  # one letter, or what may stand for one
_LETTER = re.compile(r"[^\W\d_]")


# ---- the character model

def _trigrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter trigrams of all words in a partition, counted; at most one row per trigram."""
    counts = np.zeros(SIZE**3, dtype=np.int64)
    for batch in batches:
        for _, texts in slices(batch):
            lists, starts = split_words(texts)
            kinds, codes = coded(lists, int(starts[-1]))
            if not kinds:
                continue
            joined = (b"\n\n" + b"\n\n".join(kinds) + b"\n\n").decode("utf-8", "replace")
            at = _CLASS_OF[np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)].astype(np.int32)
            edge = at == 0
            # the number of the word that each place belongs to; both edges after a word are its own
            word = np.cumsum(edge[:-2] & edge[1:-1] & ~edge[2:], dtype=np.int32) - 1
            useful = (at[:-2] != OTHER) & (at[1:-1] != OTHER) & (at[2:] != OTHER) & ~(edge[1:-1] & edge[2:])
            code = (at[:-2] * (SIZE * SIZE) + at[1:-1] * SIZE + at[2:])[useful]
            weight = np.bincount(codes, minlength=len(kinds))[word[useful]]
            counts += np.bincount(code, weights=weight, minlength=SIZE**3).astype(np.int64)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["trigram", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of each letter after two others, from every word of every document.

    Partitions count in place and the sums are grouped by trigram; the alphabet bounds
    what reaches the driver.
    """
    rows = docs.select("text").mapInArrow(_trigrams, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    table = np.zeros(SIZE**3)
    got = rows.toArrow()
    table[got.column("trigram").to_numpy()] = got.column("n").to_numpy()
    three = table.reshape(SIZE, SIZE, SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * SIZE)
    p2 = (two + 4 * p1) / (two.sum(axis=1, keepdims=True) + 4)
    p3 = (three + 4 * p2[None]) / (three.sum(axis=2, keepdims=True) + 4)
    return np.log(p3).astype(np.float32)


# ---- restoring

def _options(token: str, i: int, paired: bool = False) -> list[tuple[str, float]]:
    """What the token's place ``i`` may stand for, with costs; ``paired`` says that all letters around it are doubled."""
    c = token[i]
    if c.isalpha():
        cost = 0.0 if c in CLASS else UNKNOWN_COST
        same = i > 0 and token[i - 1] == c
        if not same:
            return [(c, cost)]
        drawn = paired or (i > 1 and token[i - 2] == c) or (i + 1 < len(token) and token[i + 1] == c)
        return [(c, cost + DROP_COST if drawn else cost), ("", DROP_COST if drawn else PAIR_COST)]
    found = [(x, LEET_COST) for x in LEET.get(c, "")]
    if c == "*" or c in HIDING:
        found += [(x, MASK_COST) for x in MASKED]
    if not found or c in SEPARATORS or not c.isalnum():
        found.append(("", DROP_COST if c in SEPARATORS else MASK_COST))
    return found


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place of a token what it may stand for, with costs.

    A mark between letters may stand for itself, unless every letter is set apart.
    """
    paired = {i for m in _PAIRED.finditer(token) for i in range(*m.span())}
    meant = not _APART.fullmatch(token)
    places = []
    for i, c in enumerate(token):
        options = _options(token, i, i in paired)
        places.append([*options, (c, 0.0)] if meant and c in KEPT else options)
    return places


def decode(token: str, model: np.ndarray, breaks: bool = False) -> str:
    """The likeliest letters for a disguised token, by Viterbi; the states are the last two letters.

    A mark that stands for itself ends a word, and the letter after it begins one.
    ``breaks`` lets a new word begin between any two places, for letters set apart.
    """
    states = {(0, 0): (0.0, None)}
    for options in lattice(token):
        following: dict = {}
        for (a, b), (cost, path) in states.items():
            for letter, extra in options:
                if not letter:
                    steps = [((a, b), cost + extra, path)]
                elif letter in KEPT:
                    steps = [((0, 0), cost + extra - (model[a][b][0] if b else 0.0), (letter, path))]
                else:
                    k = CLASS.get(letter, OTHER)
                    steps = [((b, k), cost + extra - model[a][b][k], (letter, path))]
                    if breaks and b:
                        new = cost + extra + BREAK_COST - model[a][b][0] - model[0][0][k]
                        steps.append(((0, k), new, (letter, (" ", path))))
                for key, value, way in steps:
                    if key not in following or value < following[key][0]:
                        following[key] = (value, way)
        states = following
    _, path = min(((cost - model[a][b][0], path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0])
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


_latest: dict = {}


def remembering(model: np.ndarray) -> Callable[..., str]:
    """``decode`` under one model, with the words restored lately at hand: the same ones recur in every slice.

    At most ``MEMO`` words of up to ``MEMO_LETTERS`` letters are kept, for one model at a time.
    """
    if _latest.get("model") is not model:
        table = model.tolist()  # single numbers are looked up faster in lists
        kept = lru_cache(MEMO)(lambda token, breaks: decode(token, table, breaks))

        def known(token: str, breaks: bool = False) -> str:
            return kept(token, breaks) if len(token) <= MEMO_LETTERS else decode(token, table, breaks)

        _latest.update(model=model, known=known)
    return _latest["known"]


def plain(word: str) -> str:
    """Lower case without the punctuation around it."""
    return _EDGE.sub("", word.lower())


def disguised(word: str) -> bool:
    """Whether the lattice of a word, already lower and stripped, has more than one path."""
    if not _LETTER.search(word):
        return False
    return bool(_DISGUISE.search(word) or _DRAWN.search(word) or _CUT.search(word) or _APART.fullmatch(word))


def restored(word: str, model: np.ndarray) -> str:
    core = plain(word)
    return decode(core, model) if disguised(core) else core


def set_apart(words: list[bytes]) -> Iterator[str]:
    """Runs of at least three one-letter words, joined."""
    run: list[str] = []
    for w in words:
        # one code point, perhaps with a comma or a full stop
        c = w.decode("utf-8", "replace") if len(w) <= 5 else ""
        if _SINGLE.fullmatch(c):
            run.append(c[0].lower())
            continue
        if len(run) >= RUN:
            yield "".join(run)
        run = []
    if len(run) >= RUN:
        yield "".join(run)


def _short_runs(lists: list[list[bytes]], kinds: list[bytes], codes: np.ndarray, starts: np.ndarray) -> dict[int, list[str]]:
    """For each text with letters set apart, the joined runs; others are skipped without a look."""
    short = np.array([len(k) <= 5 and bool(_SINGLE.fullmatch(k.decode("utf-8", "replace"))) for k in kinds], dtype=bool)
    flags = short[codes]
    if len(flags) < RUN:
        return {}
    hit = np.flatnonzero(flags[:-2] & flags[1:-1] & flags[2:])
    texts = np.unique(np.searchsorted(starts, hit, side="right") - 1)
    return {int(t): runs for t in texts if (runs := list(set_apart(lists[t])))}


def restored_text(text: str, model: np.ndarray) -> str:
    """A whole text with its disguised words restored; other words stay as they are.

    Joined runs of single letters stand in the place of the run.
    """
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        joined = list(set_apart([w.encode() for w in run]))
        out.extend([decode(joined[0], model, breaks=True)] if joined and len(run) >= RUN else run)
        run.clear()

    for w in text.split():
        if len(w) == 1 or (len(w) == 2 and w[1] in ".,-"):
            run.append(w)
            continue
        close()
        core = plain(w)
        out.append(decode(core, model) if disguised(core) else w)
    close()
    return " ".join(out)


# ---- scoring

def _word_features(words: list[str], bits: int) -> np.ndarray:
    """Five hashed features of each word: itself and its beginnings of four to seven letters.

    Each distinct beginning is hashed once; a word too short for one has the feature of
    the empty word there.
    """
    columns = []
    for n in (0, 4, 5, 6, 7):
        asked = [w[:n] if len(w) >= n else "" for w in words] if n else words
        place = {w: i for i, w in enumerate(dict.fromkeys(asked))}
        hashed = hashes(place, len(place), seed=n + 1) & np.uint64((1 << bits) - 1)
        columns.append(hashed.astype(np.int32)[np.fromiter(map(place.__getitem__, asked), np.int64, count=len(asked))])
    return np.stack(columns, axis=1)


def _restored_kinds(kinds: list[bytes], known: Callable[..., str]) -> tuple[list[str], np.ndarray]:
    """The restored form of each distinct word, and whether it was disguised.

    Words of letters only, perhaps with a mark after them, need no look at their edges;
    drawn-out letters are looked for in all words at once.
    """
    changed = np.zeros(len(kinds), dtype=np.int64)
    if not kinds:
        return [], changed
    words = b"\n".join(kinds).decode("utf-8", "replace").lower().split("\n")
    joined = "\n".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    drawn = set(np.searchsorted(ends, [m.start() for m in _DRAWN.finditer(joined)], side="right").tolist())
    for i, word in enumerate(words):
        if word.isalpha():
            hidden = i in drawn
        else:
            word = words[i] = word[:-1] if word[-1] in ".," and word[:-1].isalpha() else plain(word)
            hidden = i in drawn or disguised(word)
        if hidden and disguised(word):
            words[i] = known(word)
            changed[i] = words[i] != word
    return words, changed


def text_features(texts: list, model: np.ndarray, bits: int = BITS, useful=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (text, feature) of the restored words, and the number of restored words per text.

    With ``useful``, one flag per feature, only words with a useful feature are paired.
    """
    lists, starts = split_words(texts)
    kinds, codes = coded(lists, int(starts[-1]))
    known = remembering(model)
    words, changed = _restored_kinds(kinds, known)
    per_kind = _word_features(words, bits)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    n_restored = np.bincount(owner, weights=changed[codes], minlength=len(texts)).astype(np.int64)
    more_owner, more = [], []
    for t, runs in _short_runs(lists, kinds, codes, starts).items():
        for run in runs:
            for w in known(run, breaks=True).split() + [known(run)]:
                more_owner.append(t)
                more.append(w)
            n_restored[t] += 1
    if useful is not None:
        mine = useful[per_kind].any(axis=1)[codes]
        owner, codes = owner[mine], codes[mine]
    pairs = np.stack([np.repeat(owner, 5), per_kind[codes].ravel()], axis=1)
    if more:
        extra = np.stack([np.repeat(more_owner, 5), _word_features(more, bits).ravel()], axis=1)
        pairs = np.concatenate([pairs, extra])
    return pairs[:, 0], pairs[:, 1], n_restored


def _vectors(part: pa.RecordBatch, texts: list, model, bits: int) -> dict:
    owner, feature, _ = text_features(texts, model.value, bits)
    key = np.unique(owner.astype(np.int64) << 32 | feature)
    cuts = np.searchsorted(key, np.arange(1, len(texts)) << 32)
    sets = np.split((key & 0xFFFFFFFF).astype(np.int32), cuts) if texts else []
    return {"doc_id": part.column("doc_id"), "label": part.column("label"), "i": pa.array(sets, pa.list_(pa.int32()))}


def fit(docs: DataFrame, labels: DataFrame, may_learn, letters, sample: int = SAMPLE, bits: int = BITS):
    """Weights and bias from a bounded sample of labelled rows (``sample``)."""
    rows = labelled_sample(docs, labels, "toxic", may_learn, sample)
    vectors = over_slices(rows, _vectors, "doc_id long, label int, i array<int>", model=letters, bits=bits)
    got = vectors.toArrow().sort_by([("doc_id", "ascending")])
    order = np.random.default_rng(11).permutation(got.num_rows)
    y, i = (got.column(c).combine_chunks() for c in ("label", "i"))
    one = np.float64(1.0)  # a feature is there or not: a view of a single number, not an array per row
    rows = [(y[int(k)].as_py(), ids := i[int(k)].values.to_numpy(), np.broadcast_to(one, len(ids))) for k in order]
    if not rows:
        return np.zeros(1 << bits, np.float32), 0.0
    return ftrl(rows, bits, EPOCHS, alpha=1.0, l1=4.0, l2=0.1)


def _scores(part: pa.RecordBatch, texts: list, letters, weights, bits: int) -> dict:
    w, bias = weights.value
    owner, feature, n_restored = text_features(texts, letters.value, bits, w != 0)
    known = w[feature] != 0
    key = np.unique(owner[known].astype(np.int64) << 32 | feature[known])
    logit = bias + np.bincount(key >> 32, weights=w[key & 0xFFFFFFFF], minlength=len(texts))
    return {
        "doc_id": part.column("doc_id"), "n_restored": n_restored,
        "score": 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35))),
    }


def _models(docs: DataFrame, labels: DataFrame, parts: int, part: int, sample: int) -> dict:
    """The letter model and the weights, broadcast; alphabet and ``BITS`` bound them."""
    context = docs.sparkSession.sparkContext
    letters = context.broadcast(letter_model(docs))
    weights = context.broadcast(fit(docs, labels, ~held_out(F.col("doc_id"), parts, part), letters, sample))
    return {"letters": letters, "weights": weights, "bits": BITS}


def classify(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and n_restored for every document.

    Learns only from labels of rows that are not held out. Null and empty texts score the
    bias alone, equal texts alike; without labels every score is 0.5; an empty table gives
    no rows; other columns are not read.
    """
    scored = over_slices(
        docs.select("doc_id", "text"), _scores, "doc_id long, score double, n_restored long",
        **_models(docs, labels, parts, part, sample),
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_restored",
    )


def _passed(part: pa.RecordBatch, texts: list, threshold: float, **models) -> dict:
    good = pa.array(_scores(part, texts, **models)["score"] < threshold)
    return {name: part.column(i).filter(good) for i, name in enumerate(part.schema.names)}


def without_toxic(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns.

    Each row is judged in place, so nothing is joined back. Without a single label that
    may be learnt from nothing can be judged, and all rows stay.
    """
    usable = labels.filter(~held_out(F.col("doc_id"), parts, part) & F.col("toxic").isNotNull())
    if usable.join(docs.select("doc_id"), "doc_id", "left_semi").isEmpty():
        return docs
    return over_slices(docs, _passed, docs.schema, threshold=threshold, **_models(docs, labels, parts, part, sample))
