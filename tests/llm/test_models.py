import random

import numpy as np
import pytest

from skyledger.llm import quality_model as Q
from skyledger.llm import queries
from skyledger.llm import toxicity as T

DATA = "/root/testdata/sf0.01"


def area(labels, scores):
    labels, scores = np.array(labels), np.array(scores)
    above = (scores[labels == 1][:, None] > scores[labels == 0][None, :]).mean()
    return above + 0.5 * (scores[labels == 1][:, None] == scores[labels == 0][None, :]).mean()


@pytest.mark.parametrize("name, label, least", [("op4_quality_model", "quality", 0.95), ("op2_toxicity", "toxic", 0.85)])
def test_held_out(spark, name, label, least):
    out = queries.QUERIES[name](spark, DATA)
    rows = out.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    assert out.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = [r for r in rows if r.held_out]
    assert 0 < len(held) < len(rows)
    assert area([r[label] for r in held], [r.score for r in held]) > least
    line = 0.5 if label == "quality" else 0.3
    assert all(r.predicted == int(r.score >= line) and 0 <= r.score <= 1 for r in rows)


def labels_of(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_held_out_labels_are_never_used(spark, make_docs):
    docs = make_docs([(i, f"word{i % 7} good bad {i}", "en", "s") for i in range(60)])
    from pyspark.sql import functions as F

    held = [r.doc_id for r in docs.filter(Q.held_out(F.col("doc_id"), 3, 1)).collect()]
    rows = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - y if i in held else y) for i, y in rows]
    one = Q.classify(docs, labels_of(spark, rows, "quality")).collect()
    two = Q.classify(docs, labels_of(spark, flipped, "quality")).collect()
    assert sorted(one, key=str) == sorted(two, key=str)


@pytest.mark.parametrize("module, label", [(Q, "quality"), (T, "toxic")])
def test_odd_rows(spark, make_docs, odd_rows, module, label):
    docs = make_docs(odd_rows, extra=True)
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (4, 1), (5, 0), (5, 1), (None, 1), (7, None), (99, 1)], f"doc_id long, {label} int"
    )
    rows = module.classify(docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False] * 3


@pytest.mark.parametrize("module, label", [(Q, "quality"), (T, "toxic")])
def test_empty_tables(spark, make_docs, module, label):
    none = labels_of(spark, [], label)
    assert module.classify(make_docs([]), none).count() == 0
    rows = module.classify(make_docs(["some text", None]), none).collect()
    assert [r.score for r in rows] == [0.5, 0.5]


def test_ftrl_finds_a_line():
    rnd = random.Random(1)
    rows = []
    for _ in range(400):
        ids = np.array(sorted(rnd.sample(range(50), 6)))
        rows.append((int(7 in ids), ids, np.ones(6)))
    w, bias = Q.ftrl(rows, 6, epochs=8, alpha=0.5, l1=0.1)
    assert all((w[i].sum() + bias > 0) == bool(y) for y, i, _ in rows)


def test_long_texts_are_scored_whole(spark, make_docs):
    train = [(i, "fine words here " * 5 + ("idiot " if i % 2 else ""), "en", "s") for i in range(80)]
    late = (200, "fine words here " * 20_000 + "idiot", "en", "s")
    labels = labels_of(spark, [(i, i % 2) for i in range(80)], "toxic")
    got = {r.doc_id: r.predicted for r in T.classify(make_docs([*train, late, (201, "fine words here " * 20_000)]), labels).collect()}
    assert (got[200], got[201]) == (1, 0)


@pytest.fixture(scope="module")
def letters(spark):
    return T.letter_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


@pytest.mark.parametrize("hidden, word", [
    ("1d10t", "idiot"), ("tr@sh", "trash"), ("p@th3t1c", "pathetic"), ("$tupid", "stupid"), ("st*pid", "stupid"),
    ("l0ser!!", "loser"), ("s.c.u.m", "scum"), ("m-o-r-o-n", "moron"), ("stuuuupid", "stupid"), ("idiot###", "idiot"),
    ("4.0", "4.0"), ("Of%%%", "of"), ("plain", "plain"),
    ("stu-pid", "stupid"), ("st_upid", "stupid"), ("st.upid", "stupid"), ("st#pid", "stupid"), ("st%pid", "stupid"),
    ("id-i0t", "idiot"), ("ssttuuppiidd", "stupid"), ("mmoorroonn", "moron"),
    ("well-known", "well-known"), ("self-made", "self-made"), ("bookkeeper", "bookkeeper"),
    ("łódź3", "łódźe"), ("идиооот", "идиот"),
])
def test_restored_words(letters, hidden, word):
    assert T.restored(hidden, letters) == word


def test_restored_text(letters):
    assert T.restored_text("you are s t u p i d and an 1d10t, a b", letters) == "you are stupid and an idiot a b"
    assert T.restored_text("", letters) == ""


def test_letter_model_counts_every_word(spark, make_docs):
    model = T.letter_model(make_docs(["abc abc", "abd", None, "", "É é"]))
    a, b, c, d = (T.CLASS[x] for x in "abcd")
    assert model[a, b, c] > model[a, b, d] > model[a, b, a]
    assert np.allclose(np.exp(model).sum(axis=2), 1, atol=1e-3)
    assert T.letter_model(make_docs([])).shape == (T.SIZE,) * 3


def test_viterbi_is_the_best_path(letters):
    """Against trying every path of the lattice."""
    import itertools

    for word in ("1d1ot", "t3$t", "aaab", "b*d"):
        best = None
        for path in itertools.product(*[T._options(word, i) for i in range(len(word))]):
            text = "".join(x for x, _ in path)
            cost, a, b = sum(c for _, c in path), 0, 0
            for x in text:
                cost -= float(letters[a, b, T.CLASS[x]])
                a, b = b, T.CLASS[x]
            cost -= float(letters[a, b, 0])
            best = min(best or (cost, text), (cost, text))
        assert T.decode(word, letters) == best[1]


def test_marks_that_stand_for_themselves(letters):
    """Against every path of the lattice, where a mark may end a word."""
    import itertools

    for word in ("a-b1", "on_1y", "th3-a", "a--b0", "no.w3"):
        best = None
        for path in itertools.product(*T.lattice(word)):
            text = "".join(x for x, _ in path)
            cost, a, b = sum(c for _, c in path), 0, 0
            for x in text:
                if x in T.KEPT:
                    cost -= float(letters[a, b, 0]) if b else 0.0
                    a = b = 0
                else:
                    cost -= float(letters[a, b, T.CLASS[x]])
                    a, b = b, T.CLASS[x]
            cost -= float(letters[a, b, 0])
            best = min(best or (cost, text), (cost, text))
        assert T.decode(word, letters) == best[1]


def test_no_letter_is_lost(letters):
    """Letters that the model does not know stay; so do those of words that are no disguise."""
    for word in ("идиот1", "ηλίθιος0", "œuvre3", "şey4"):
        assert T.restored(word, letters)[:-1] == word[:-1]
    assert not T.disguised("идиот") and not T.disguised("bookkeeper") and not T.disguised("aujourd'hui")


def test_remembered_words_follow_the_model(letters):
    words = ["1d10t", "stu-pid", "x" * 100 + "1"]
    known = T.remembering(letters)
    assert [known(w) for w in words] == [known(w) for w in words] == [T.decode(w, letters) for w in words]
    flat = np.full_like(letters, -3.0)
    assert [T.remembering(flat)(w) for w in words] == [T.decode(w, flat) for w in words]
    assert known("s0s", breaks=True) == T.decode("s0s", letters, breaks=True)


def test_disguised_words_count(spark, make_docs):
    rnd = random.Random(2)
    plain = "the rain on the plain was mild and the stupid moron said so".split()
    rows = [(i, " ".join(rnd.sample([w for w in plain if i % 2 or w not in ("stupid", "moron")], 9)), "en", "s") for i in range(200)]
    hidden = [(1000, "the rain was mild and the $tup1d said so", "en", "s"), (1001, "the plain was mild", "en", "s"),
              (1002, "the m o r o n said so and was mild", "en", "s")]
    labels = [(i, int("stupid" in t or "moron" in t)) for i, t, *_ in rows]
    docs = make_docs(rows + hidden)
    got = {r.doc_id: (r.predicted, r.n_restored) for r in T.classify(docs, labels_of(spark, labels, "toxic")).collect()}
    assert got[1000] == (1, 1) and got[1001] == (0, 0) and got[1002] == (1, 1)
