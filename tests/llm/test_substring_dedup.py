import collections
import hashlib
import random

import pytest

from skyledger.llm import substring_dedup as S


def expected(rows, window):
    seen = collections.Counter()
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for _, w in split:
        for p in range(len(w) - window + 1):
            seen[tuple(w[p:p + window])] += 1
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] > 1:
                gone[p:p + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("period, cover", S.COVERS.items())
def test_covers_hold_every_difference(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [35, 50])
def test_equal_windows_share_an_aligned_anchor(window):
    period = S.period_for(window)
    length = window - period + 1
    cover = set(S.COVERS[period])
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(window - length + 1))


def test_against_brute_force(make_docs, invent):
    rnd = random.Random(5)
    passages = [invent(rnd, n) for n in (34, 35, 36, 60, 200)]
    rows = []
    for i in range(120):
        parts = [invent(rnd, rnd.randrange(0, 90))]
        for _ in range(rnd.randrange(3)):
            parts += [rnd.choice(passages), invent(rnd, rnd.randrange(0, 40))]
        rows.append((i, " \n".join(parts)))
    # overlapping pieces of one passage, a text inside another, and repeats inside one text
    w = passages[4].split()
    rows += [(200, " ".join(w[:80])), (201, " ".join(w[45:130])), (202, "a " * 50), (203, "b c " * 40), (204, rows[3][1])]
    assert result(S.remove_repeats(make_docs(rows), 35)) == expected(rows, 35)


def test_odd_rows(make_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert result(S.remove_repeats(make_docs(odd_rows, extra=True), 35)) == expected(rows, 35)


def test_empty_table(make_docs):
    assert S.remove_repeats(make_docs([]), 35).count() == 0
    assert S.without_repeats(make_docs([]), 35).count() == 0


def test_texts_without_repeats(make_docs, odd_rows, invent):
    rnd = random.Random(9)
    shared = invent(rnd, 60)
    rows = [*odd_rows, (20, f"first {shared} end", "en", "s1"), (21, f"{shared}\n\nlast  words", "en", "s1")]
    docs = make_docs(rows, extra=True)
    out = S.without_repeats(docs, 50)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.filter("doc_id >= 20").collect()}
    assert texts == {20: "first end", 21: "last words"}
    unchanged = {r.doc_id: r.text for r in out.filter("doc_id in (1, 2, 3, 11)").collect()}
    assert unchanged == {r[0]: r[1] for r in odd_rows if r[0] in (1, 2, 3, 11)}


def test_short_windows_are_refused():
    with pytest.raises(ValueError):
        S.period_for(5)


def test_rows_without_ids_are_as_far_apart_as_any(make_docs, invent):
    """20,000 different texts without an id: no list holds more than one text's places, and the result is the same."""
    rnd = random.Random(12)
    passages = [invent(rnd, 40) for _ in range(50)]
    texts = [f"{invent(rnd, 5, 10**6)} {passages[i % 50]} {invent(rnd, 5, 10**6)}" for i in range(20_000)]
    rows = list(enumerate(texts))
    no_ids = make_docs([(None, t, "en", "s") for t in texts])
    anchors = S.over_slices(S._rows(no_ids).drop("doc_id"), S._anchors, S.ROW, window=35, period=21)
    places = S._repeated(anchors, ["h"], "test-anchors")
    longest, n = places.selectExpr("max(size(places))", "count(*)").first()
    assert longest <= 50 and n == 20_000
    kept = sorted(r["kept_sha256"] for r in S.remove_repeats(no_ids, 35).collect())
    assert kept == sorted(r[3] for r in expected(rows, 35))


def test_many_repeats_of_one_row_without_an_id(make_docs, invent):
    rnd = random.Random(13)
    same = invent(rnd, 120)
    rows = [(None, same, "en", "s")] * 2000 + [(None, invent(rnd, 60), "en", "s") for _ in range(20)]
    found = S.remove_repeats(make_docs(rows), 35)
    assert found.filter("n_removed = 120").count() == 2000 and found.filter("n_removed = 0").count() == 20
