import collections
import re

import duckdb
import numpy as np
import pytest

from skyledger.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top):
    """The contract, word by word."""
    total, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = collections.Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i:i + m]] = max(covered[p[i:i + m]], a)
        found = []
        for p, a in candidates.items():
            if 100 * covered[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def prose(rnd, n_rows, n_words):
    common = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n_rows):
        parts = []
        for _ in range(n_words):
            parts.append(rnd.choice([" ", "  ", "\t", ". ", ", ", "\n", " ", " "]))
            parts.append(rnd.choice([*common, "New York City Hall", "of the", "ÄRGER über", "x y", "Aa aA", f"u{rnd.randrange(99)}"]))
        rows.append((i, "".join(parts), rnd.choice(["en", "de", None, "und"]), "s"))
    return rows


@pytest.mark.parametrize("least, top", [(3, 2000), (3, 7), (12, 2000)])
def test_against_brute_force(make_docs, least, top):
    import random

    rows = prose(random.Random(least), 60, 60)
    assert result(C.mine_phrases(make_docs(rows, extra=True), least, top)) == expected(rows, least, top)


def test_joined_vocabulary_and_levels_of_merging_change_nothing(make_docs, monkeypatch):
    import random

    rows = prose(random.Random(4), 40, 60)
    docs = make_docs(rows)
    monkeypatch.setattr(C, "SLICE_BYTES", 1500)
    monkeypatch.setattr(C, "GROUP_ENTRIES", 64)
    monkeypatch.setattr(C, "LEVEL_BITS", 2)
    assert result(C.mine_phrases(docs, 3, most_bytes=0)) == expected(rows, 3, 2000)


def test_a_phrase_in_a_third_of_all_words(make_docs, invent):
    import random

    rnd = random.Random(8)
    rows = [(i, "hot hot phrase here " * 20 if i % 3 else invent(rnd, 80), "en", "s") for i in range(60)]
    assert result(C.mine_phrases(make_docs(rows), 5)) == expected(rows, 5, 2000)


def test_odd_rows_and_empty_table(make_docs, odd_rows):
    assert result(C.mine_phrases(make_docs(odd_rows, extra=True), 2)) == expected(odd_rows, 2, 2000)
    assert result(C.mine_phrases(make_docs(odd_rows).limit(0))) == []
    assert result(C.mine_phrases(make_docs([(1, None), (2, "")]))) == []


def test_sql_on_a_small_table(make_docs):
    import random

    rows = prose(random.Random(6), 200, 60)
    docs = make_docs(rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert result(C.mine_phrases(docs)) == sorted(con.execute(C.PHRASES_SQL).fetchall())


@pytest.mark.parametrize("n, bits", [(2, 16), (2, 32), (3, 16), (3, 22), (3, 32), (4, 16), (4, 18), (4, 32)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * bits)
    ids = [rng.integers(1, min(1 << bits, 300), 5000).astype(np.uint64) for _ in range(n)]
    ids[0][:100] = (1 << bits) - 1
    ids[-1][:100] = (1 << bits) - 1
    true = collections.Counter(zip(*(x.tolist() for x in ids), strict=True))
    left, right, width = C._halves(ids, bits)
    whole = C.Filter.of(*C._joined(*C.permuted(left, right, width), width))
    top_bits, low_bits = C._bits_of(n, bits)
    for skip in (0, 3, 12):
        parts = []
        for prefix, part in whole.parts(top_bits, skip):
            parts.append(C.Filter.loaded(part.stored(top_bits, low_bits, skip), top_bits, skip, prefix))
        both = C.Filter.merged([*parts, *parts])
        pair = C._parted(both.top, both.low, width)
        back = C._ids(*C.restored(*pair, width), n, bits)
        keys = zip(*(x.tolist() for x in back), strict=True)
        assert dict(zip(keys, both.counts.tolist(), strict=True)) == {k: 2 * v for k, v in true.items()}


def test_large_counts_are_kept():
    top = np.array([5, 9, 70], dtype=np.uint64)
    counts = np.array([254, 255, 2**40])
    back = C.Filter.loaded(C.Filter(top, None, counts).stored(16, 0, 0), 16, 0, 0)
    assert back.top.tolist() == [5, 9, 70] and back.counts.tolist() == counts.tolist()
