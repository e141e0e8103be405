"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import coded, over_slices

MARK = "▁"  # fixed value: the whitespace marker
UNKNOWN_PENALTY = 10.0  # fixed value: how far below the least piece an unknown letter scores
ZIPF_SHIFT = 2.7
LONG = 64  # longer segments are searched one by one
BLOCK_LETTERS = 1 << 18  # letters searched at a time
SEGMENT = re.compile(rb" *[^ ]+| +\Z")


class Pieces(NamedTuple):
    """A vocabulary: its double array, scores by piece id, bytes by piece id, and the ids of single bytes."""

    base: np.ndarray
    check: np.ndarray
    piece_at: np.ndarray  # piece that ends in a state, or -1
    letters: np.ndarray  # code points in pieces, sorted; a letter's code is its place plus one
    scores: np.ndarray
    spelled: list[bytes]
    sizes: np.ndarray  # letters of each piece
    first_byte: int
    depth: int


def double_array(words: dict[str, int], codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value arrays of a trie; the child of state s by code c is base[s] + c if check there is s."""
    root: dict = {}
    for word, value in words.items():
        node = root
        for c in word:
            node = node.setdefault(codes[c], {})
        node[-1] = value
    size = len(codes) * 2 + 2 * sum(map(len, words)) + 16
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    value = np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    free = 1
    queue = deque([(0, root)])
    while queue:
        state, node = queue.popleft()
        value[state] = node.pop(-1, -1)
        if not node:
            continue
        children = sorted(node)
        while taken[free]:
            free += 1
        slot = free
        while True:
            # try to lay the first child on each free slot in turn
            begin = slot - children[0]
            if begin >= 0 and not any(taken[begin + c] for c in children):
                break
            slot = taken.index(0, slot + 1)
        base[state] = begin
        for c in children:
            taken[begin + c] = 1
            check[begin + c] = state
            queue.append((begin + c, node[c]))
    used = size - next(i for i, t in enumerate(reversed(taken)) if t) + len(codes) + 1
    return base[:used].copy(), np.pad(check[:used], (0, max(0, used - size)), constant_values=-1), value[:used].copy()


def load(path: str) -> Pieces:
    """The pieces of a model file, with byte fallback.

    Files with merge ranks in place of scores get log scores by Zipf's law over the order
    of the pieces; files with log-probabilities keep theirs.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(processor.vocab_size())
    spelled = [b""] * len(ids)
    words: dict[str, int] = {}
    first_byte = -1
    for i in ids:
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            first_byte = i if first_byte < 0 else first_byte
            spelled[i] = bytes([int(piece[3:5], 16)])
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            words[piece] = i
            spelled[i] = piece.replace(MARK, " ").encode()
    if first_byte < 0:
        raise ValueError("the vocabulary has no byte pieces")
    if any(MARK in w.lstrip(MARK) for w in words):
        raise ValueError("a piece crosses white space")
    given = np.array([processor.get_score(i) for i in ids], dtype=np.float64)
    if min(given[i] for i in words.values()) < -1000:
        order = np.log(np.arange(len(words)) + ZIPF_SHIFT)
        total = np.log(np.sum(np.exp(-order)))
        for rank, i in enumerate(sorted(words.values())):
            given[i] = -order[rank] - total
    letters = sorted({c for w in words for c in w})
    base, check, value = double_array(words, {c: i + 1 for i, c in enumerate(letters)})
    points = np.array([ord(c) for c in letters], dtype=np.uint32)
    sizes = np.zeros(len(ids), dtype=np.int64)
    for word, i in words.items():
        sizes[i] = len(word)
    return Pieces(base, check, value, points, given, spelled, sizes, first_byte, max(map(len, words)))


def _codes(points: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Codes of code points: white space as the marker, 0 for what is in no piece or looks like the marker."""
    wanted = np.where(points == 0x20, np.uint32(ord(MARK)), points)
    place = np.searchsorted(pieces.letters, wanted)
    known = pieces.letters[np.minimum(place, len(pieces.letters) - 1)] == wanted
    return np.where(known & (points != ord(MARK)), place + 1, 0).astype(np.int32)


def _matches(codes: np.ndarray, room: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """For each length and start, the piece that lies there or -1, and its score.

    All starts walk the double array together. ``room`` is the number of letters left in
    each start's segment. A letter that is no piece itself scores as unknown (id -2).
    """
    n = len(codes)
    found = np.full((pieces.depth, n), -1, dtype=np.int32)
    at, state = np.arange(n), np.zeros(n, dtype=np.int32)
    for d in range(pieces.depth):
        inside = room[at] > d
        at, state = at[inside], state[inside]
        if not len(at):
            break
        code = codes[at + d]
        following = np.minimum(pieces.base[state] + code, len(pieces.check) - 1)
        going = (code > 0) & (pieces.check[following] == state)
        at, state = at[going], following[going]
        found[d, at] = pieces.piece_at[state]
    score = np.where(found >= 0, pieces.scores[found], -np.inf)
    alone = found[0] < 0
    least = min(pieces.scores[i] for i in pieces.piece_at[pieces.piece_at >= 0]) if n else 0.0
    found[0, alone] = -2
    score[0, alone] = least - UNKNOWN_PENALTY
    return found, score


def _search(score: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the last piece of the best path to each place; the place of letter i's end is i.

    Segments advance letter by letter together, the longest first in the arrays, so the
    ones still going are a prefix.
    """
    depth, n = score.shape
    best = np.full(n + 1, -np.inf)
    back = np.zeros(n + 1, dtype=np.int32)
    order = np.argsort(-sizes, kind="stable")
    b, s = begins[order], sizes[order]
    for i in range(int(s[0]) if len(s) else 0):
        going = int(np.searchsorted(-s, -i, side="left"))  # sizes greater than i
        at = b[:going] + i
        so_far = np.where(i == 0, 0.0, best[at - 1])
        for d in range(min(depth, int(s[0]) - i)):
            value = so_far + score[d, at]
            end = np.minimum(at + d, n)
            # a start near its segment's end has no piece this long, so -inf never wins
            better = value > best[end]
            if better.any():
                best[end[better]] = value[better]
                back[end[better]] = d + 1
    return back[:n]


def _long_path(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Ids on the best path of one long segment, start by start; matches are taken in bounded runs of starts."""
    n = len(codes)
    best, back, ids = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
    for begin in range(0, n, BLOCK_LETTERS):
        here = min(n, begin + BLOCK_LETTERS)
        seen = codes[begin:min(n, here + pieces.depth)]
        found, score = _matches(seen, len(seen) - np.arange(len(seen)), pieces)
        starts, lengths = np.nonzero((found[:, :here - begin] != -1).T)
        given, scored = found[lengths, starts].tolist(), score[lengths, starts].tolist()
        for i, d, piece, value in zip((starts + begin).tolist(), lengths.tolist(), given, scored, strict=True):
            value += best[i]
            if value > best[i + d + 1]:
                best[i + d + 1], back[i + d + 1], ids[i + d + 1] = value, d + 1, piece
    path, at = [], n
    while at:
        path.append(ids[at])
        at -= back[at]
    return np.array(path[::-1], dtype=np.int32)


def _short_paths(codes: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids on the best paths of a block of short segments, and how many each has."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    found, score = _matches(codes, np.repeat(ends, sizes) - np.arange(len(codes)), pieces)
    back = _search(score, begins, sizes)
    # walk back from every segment's last letter
    last = np.zeros(len(codes), dtype=bool)
    at, low = ends[sizes > 0] - 1, begins[sizes > 0]
    while len(at):
        last[at] = True
        at = at - back[at]
        on = at >= low
        at, low = at[on], low[on]
    at = np.flatnonzero(last)
    owner = np.repeat(np.arange(len(sizes)), sizes)[at]
    return found[back[at] - 1, at - back[at] + 1], np.bincount(owner, minlength=len(sizes))


def encode_segments(segments: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all segments, one after the other, and how many each has.

    Segments are searched in blocks of bounded letters, a long one by itself.
    """
    texts = [s.decode("utf-8", "replace") for s in segments]
    out_ids, out_counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    begin = held = 0
    for end in range(len(texts) + 1):
        long = end < len(texts) and len(texts[end]) > LONG
        if end > begin and (end == len(texts) or long or held + len(texts[end]) > BLOCK_LETTERS):
            ids, counts = _encode_block(texts[begin:end], pieces)
            out_ids.append(ids)
            out_counts.append(counts)
            begin, held = end, 0
        if long:
            ids, counts = _encode_block([texts[end]], pieces)
            out_ids.append(ids)
            out_counts.append(counts)
            begin = end + 1
        elif end < len(texts):
            held += len(texts[end])
    return np.concatenate(out_ids), np.concatenate(out_counts)


def _encode_block(texts: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of a block of segments; letters that are in no piece become their bytes."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _codes(points, pieces)
    if len(texts) == 1 and len(points) > LONG:
        ids = _long_path(codes, pieces)
        counts = np.array([len(ids)])
    else:
        ids, counts = _short_paths(codes, np.array([len(t) for t in texts], dtype=np.int64), pieces)
    unknown = ids == -2
    if unknown.any():
        # the place of each piece's first letter: known pieces have as many letters as they spell
        letters = np.where(unknown, 1, pieces.sizes[np.maximum(ids, 0)])
        at = np.cumsum(letters) - letters
        raw = [chr(p).encode("utf-8", "surrogatepass") for p in points[at[unknown]]]
        width = np.ones(len(ids), dtype=np.int64)
        width[unknown] = [len(r) for r in raw]
        owner = np.repeat(np.repeat(np.arange(len(texts)), counts), width)
        ids, unknown = np.repeat(ids, width), np.repeat(unknown, width)
        ids[unknown] = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int32) + pieces.first_byte
        counts = np.bincount(owner, minlength=len(texts))
    return ids, counts


def decode(ids, pieces: Pieces) -> bytes:
    """UTF-8 bytes of piece ids: markers are white space, byte pieces their bytes, the prefix goes."""
    joined = b"".join(map(pieces.spelled.__getitem__, ids))
    return joined[1:] if joined[:1] == b" " else joined


def encode_texts(texts: list, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after the other, and where each text's begin.

    White space becomes the marker and one marker goes before the text. No piece crosses
    from a letter to a marker, so the best path of a text is that of its segments (markers,
    then letters), and each distinct segment is searched once. An empty or null text has no
    pieces. A marker in the text itself goes to bytes, so that decoding gives it back.
    """
    lists = [SEGMENT.findall(b" " + x) if x else [] for x in texts]
    total = sum(map(len, lists))
    kinds, place = coded(lists, total)
    flat, counts = encode_segments(kinds, pieces)
    first = np.cumsum(counts) - counts
    n = counts[place]
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    ids = flat[np.repeat(first[place], n) + within]
    per_text = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=per_text[1:])
    return ids, np.concatenate([[0], np.cumsum(n)])[per_text]


def _work(part: pa.RecordBatch, texts: list, shared, with_pieces: bool) -> dict:
    pieces = shared.value
    ids, begins = encode_texts(texts, pieces)
    is_byte = (ids >= pieces.first_byte) & (ids < pieces.first_byte + 256)
    bytes_so_far = np.concatenate([[0], np.cumsum(is_byte)])
    digests, equal = [], []
    for a, b, text in zip(begins[:-1], begins[1:], texts, strict=True):
        mine = ids[a:b]
        digests.append(hashlib.sha256(mine.astype("<i4").tobytes()).hexdigest())
        equal.append(decode(mine.tolist(), pieces) == (text or b""))
    out = {
        "doc_id": part.column("doc_id"), "n_pieces": np.diff(begins),
        "n_byte_pieces": bytes_so_far[begins[1:]] - bytes_so_far[begins[:-1]],
        "pieces_sha256": pa.array(digests, pa.string()), "round_trip": pa.array(equal, pa.bool_()),
    }
    if with_pieces:
        out["pieces"] = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids.astype(np.int32)))
    return out


def encode(docs: DataFrame, path: str, with_pieces: bool = True) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, pieces_sha256, round_trip and, if asked for, pieces of every row.

    pieces_sha256 is of the ids as little-endian 32-bit numbers; round_trip says whether
    decoding them gives the text back. Null and empty texts have no pieces and come back
    as the empty text; repeated rows are encoded each; an empty table gives no rows; other
    columns are not read. Whole texts are encoded, in slices of bounded bytes. The
    vocabulary's arrays are broadcast; the file bounds them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    schema = "doc_id long, n_pieces long, n_byte_pieces long, pieces_sha256 string, round_trip boolean"
    return over_slices(
        docs.select("doc_id", "text"), _work, schema + (", pieces array<int>" if with_pieces else ""),
        shared=shared, with_pieces=with_pieces,
    )


def _decode_work(part: pa.RecordBatch, texts: list, shared) -> dict:
    del texts
    lists = part.column("pieces").to_pylist()
    decoded = [decode(ids, shared.value) if ids else b"" for ids in lists]
    return {"doc_id": part.column("doc_id"), "text": pa.array([d.decode("utf-8", "replace") for d in decoded], pa.string())}


def decoded(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and pieces; null pieces give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path))
    rows = encoded.select("doc_id", "pieces", F.lit("").alias("_none"))
    return over_slices(rows, _decode_work, "doc_id long, text string", text="_none", shared=shared)
