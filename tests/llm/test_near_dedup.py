import random
import re

import numpy as np
import pytest

from skyledger.llm import near_dedup as N
from skyledger.llm.groups import smallest_labels


def shingles(text, size):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if len(w) >= size:
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def expected(rows, percent, size):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both * 100 >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(
        ((d, len(sets[i]), least.get(find(i)), least.get(find(i)) == d) for i, (d, _) in enumerate(rows)), key=str
    )


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def copies(rnd, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("percent, size", [(85, 3), (80, 5)])
def test_against_all_pairs(make_docs, invent, percent, size):
    rnd = random.Random(percent)
    rows = []
    for _ in range(12):
        base = invent(rnd, rnd.randrange(20, 300), 5000)
        rows += [copies(rnd, base, rnd.randrange(0, 14)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(rows)]
    assert result(N.near_groups(make_docs(rows), percent, size)) == expected(rows, percent, size)


def test_hub_of_partly_similar_copies(make_docs, invent, monkeypatch):
    # many copies around one text: some link to it, some only to each other, some to nothing
    monkeypatch.setattr(N, "MEMBERS", 16)
    rnd = random.Random(1)
    base = invent(rnd, 160, 5000)
    second = copies(rnd, base, 7)
    texts = [copies(rnd, base, rnd.randrange(0, 12)) for _ in range(120)]
    texts += [copies(rnd, second, rnd.randrange(0, 5)) for _ in range(60)]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert result(N.near_groups(make_docs(rows), 85, 3)) == expected(rows, 85, 3)


def test_odd_rows(make_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert result(N.near_groups(make_docs(odd_rows, extra=True), 85, 3)) == expected(rows, 85, 3)


def test_kept_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True)
    out = N.keep_one(docs)
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    texts = {t for _, t in kept}
    assert texts == {r[1] for r in odd_rows}  # every distinct text here is its own group
    # blank texts are linked with nothing; of all others one row stays per text
    assert len(kept) == len(texts)


def test_empty_table(make_docs):
    assert N.near_groups(make_docs([])).count() == 0
    assert N.keep_one(make_docs([])).count() == 0


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(2)
    errors = []
    for shared in (50, 200, 600):
        both = rnd.integers(0, 2**63, shared, dtype=np.uint64)
        sets = [np.unique(np.concatenate([both, rnd.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2)]
        table = N.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 144)
        true = shared / (shared + 200)
        errors.append(abs((table[0] == table[1]).mean() - true))
    assert max(errors) < 0.12


def test_signature_is_a_set_of_permutation_ranks():
    # one element: every register is reached, each rank once
    table = N.signatures(np.array([12345], dtype=np.uint64), np.array([0, 1, 1]), 24)
    assert sorted(np.floor(table[0]).astype(int)) == list(range(24))
    assert np.isinf(table[1]).all()


def test_components(spark):
    rnd = random.Random(4)
    nodes = [bytes([i]) for i in range(60)]
    links = [(nodes[i], nodes[i + 1]) for i in range(20)] + [(nodes[30], rnd.choice(nodes[30:50])) for _ in range(30)]
    labels = smallest_labels(
        spark.createDataFrame([(n,) for n in nodes], "node binary"), spark.createDataFrame(links, "a binary, b binary")
    )
    got = {bytes(r.node): bytes(r.component) for r in labels.collect()}
    parent = {n: n for n in nodes}
    for _ in range(60):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_rows_without_ids_are_compared_like_any(make_docs, invent):
    """3,000 rows without an id, half of them in groups of copies: each wanted set is made of one row's text."""
    rnd = random.Random(21)
    base = [invent(rnd, 60, 10**6) for _ in range(150)]
    texts = [f"{base[i % 150]} e{i}" for i in range(1500)] + [invent(rnd, 30, 10**6) for _ in range(1500)]
    with_ids = N.keep_one(make_docs(list(enumerate(texts))), 85, 3).count()
    without = N.keep_one(make_docs([(None, t, "en", "s") for t in texts]), 85, 3).count()
    assert with_ids == without == 1650
