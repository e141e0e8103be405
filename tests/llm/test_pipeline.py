import collections
import random
import subprocess
import sys

import pytest

import corpus_pipeline as P
from skyledger.llm import mixing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text, size=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def corpus(spark, make_docs, odd_rows, invent, tmp_path_factory):
    """A small folder with planted toxic texts, near copies and shared passages."""
    rnd = random.Random(12)
    rows = []
    for i in range(260):
        text = invent(rnd, rnd.randrange(60, 120), 3000)
        if i % 5 == 0:
            text += " you stupid moron idiot"
        rows.append((i, text, "en", f"s{i % 4}"))
    passage = invent(rnd, 70, 3000)
    rows += [(300 + i, f"{invent(rnd, 80, 3000)} {passage} {invent(rnd, 60, 3000)}", "en", "s1") for i in range(3)]
    copies = rows[1][1].split()
    for i in range(4):
        words = list(copies)
        words[rnd.randrange(len(words))] = f"e{i}"
        rows.append((400 + i, " ".join(words), "en", "s2"))
    rows += [(500 + (i or 0), *r) for i, *r in odd_rows]
    folder = tmp_path_factory.mktemp("corpus")
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(260)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """Every stage's input and output, written between the stages."""
    folder, _ = corpus
    docs, out = P.table(spark, folder, "documents"), []
    for name, step in P.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        step(spark, docs, folder).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((docs, result))
        docs = result
    return out


def test_stages_are_named_and_ordered():
    assert [name for name, _ in P.STAGES] == ["toxicity", "near-copies", "passages", "mixture", "pieces"]
    assert P.ORACLE_SQL is None


def test_all_but_the_last_keep_the_columns(stages):
    for given, result in stages[:-1]:
        assert result.columns == given.columns == COLUMNS


def test_toxic_texts_go_and_clean_ones_stay(stages):
    given, result = (rows_of(df) for df in stages[0])
    toxic = {r for r in given if r[0] < 260 and "stupid" in (r[1] or "")}
    assert len(toxic) == 52 and not toxic & set(result)
    assert collections.Counter(result) == collections.Counter(r for r in given if r not in toxic)


def test_one_of_each_group_stays(stages):
    given, result = (rows_of(df) for df in stages[1])
    sets = [shingles(r[1]) for r in given]
    parent = list(range(len(given)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(given)):
        for j in range(i):
            if given[i][:2] == given[j][:2] or (sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(given):
        groups[find(i)].append(r)
    assert len(result) == len(groups)
    assert {r[0] for r in result} == {min(r[0] for r in g) for g in groups.values()}
    assert not {400, 401, 402, 403} & {r[0] for r in result} and 1 in {r[0] for r in result}


def test_shared_passages_are_cut(stages):
    given, result = (rows_of(df) for df in stages[2])
    size = P.PASSAGE_WORDS
    seen = collections.Counter()
    for r in given:
        w = (r[1] or "").encode().split()
        seen.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    want = collections.Counter()
    for r in given:
        w = (r[1] or "").encode().split()
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        text = b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else r[1]
        want[(*r[:1], text, *r[2:4], len(text) if text is not None else None)] += 1
    assert collections.Counter(result) == want
    cut = [r for r in result if 300 <= r[0] < 303]
    assert len(cut) == 3 and all(len(r[1].split()) == 140 for r in cut)


def test_mixture_repeats_rows(stages):
    given, result = stages[3]
    asked = collections.Counter()
    copies = {(r.doc_id, r.size): r.n_copies for r in mixing.copies(given).collect()}
    for r in rows_of(given):
        asked[r] += copies[(r[0], len((r[1] or "").encode().split()))]
    assert collections.Counter(rows_of(result)) == +asked


def test_pieces_hold_the_texts(spark, stages):
    from skyledger.llm import pieces

    given, result = stages[4]
    assert result.count() == given.count() and result.filter("not round_trip").count() == 0
    back = pieces.decoded(result, P.vocabulary("piece_bpe_32k.model"))
    assert collections.Counter(tuple(r) for r in back.collect()) == collections.Counter((r[0], r[1] or "") for r in rows_of(given))


def test_run_is_the_stages_in_order(spark, corpus, stages):
    got = P.run(spark, corpus[0])
    assert collections.Counter(map(str, got.collect())) == collections.Counter(map(str, stages[4][1].collect()))


def test_empty_table(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_the_rest_works_without_these_folders():
    code = (
        "import sys\n"
        "sys.modules['skyledger.llm'] = None\n"
        "sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'a1_agg_monthly_delay' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names)\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=P.__file__.rsplit("/", 1)[0])


def test_every_operator_is_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(e.oracle_sql()) <= set(names)
