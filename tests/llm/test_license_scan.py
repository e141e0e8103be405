import random
import re

import pytest

from skyledger.llm import license_scan as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"]


def expected(rows):
    """Words and places by plain search; expressions by recursive descent."""
    out = []
    for doc_id, text, *_ in rows:
        lower = (text or "").translate(LOWER)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        base, labels, plain, doubt, places = set(), set(), set(), 1.0, []
        for phrase, label in {**L.NOTICES, **L.BASE}.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
            if at and phrase in L.BASE:
                base.add(L.BASE[phrase])
                places += at
            plain |= {label} if at else set()
        labels |= base | plain
        first = {}
        for i in range(len(words)):
            for phrase, label in {**L.NOTICES, **L.BASE}.items():
                parts = phrase.split()
                if words[i:i + len(parts)] == parts:
                    first.setdefault((label, i + len(parts), -len(parts)), (len(parts), label))
        seen = set()
        for _, (n, label) in sorted(first.items(), key=lambda x: (x[0][1], x[0][2])):
            doubt *= 1.0 if label in seen else 0.5 ** (n - 1)
            seen.add(label)
        free = []
        for hit in re.finditer(r"(?<![^\W])(?<!-)(?:spdx-license-identifier|license-expression|licen[sc]e|\"license\"|licenses):", lower):
            told = descend(re.findall(r"[()]|[a-z0-9.+-]+", lower[hit.end():].split("\n")[0]))
            if told:
                labels |= told[0]
                free.append(told[1])
                doubt *= 1 - L.TAG_WEIGHT
        out.append((
            doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), pytest.approx(1 - doubt, abs=1e-12), all(free) and plain <= L.PERMISSIVE if labels else None,
        ))
    return sorted(out, key=lambda r: str(r[:7]))


def descend(tokens):
    """(labels, permissive) of a whole valid expression, else None."""
    place = 0

    def peek():
        return tokens[place] if place < len(tokens) else None

    def take():
        nonlocal place
        place += 1
        return tokens[place - 1]

    def either():
        labels, free = both()
        while peek() == "or":
            take()
            more, other = both()
            labels, free = labels | more, free or other
        return labels, free

    def both():
        labels, free = one()
        while peek() == "and":
            take()
            more, other = one()
            labels, free = labels | more, free and other
        return labels, free

    def one():
        if peek() == "(":
            take()
            value = either()
            assert take() == ")"
            return value
        label = L._licence(take())
        labels, free = {label}, label in L.PERMISSIVE
        if peek() == "with":
            take()
            labels, free = labels | {peek()}, free or L.EXCEPTIONS[take()]
        return labels, free

    try:
        value = either()
    except (AssertionError, IndexError, KeyError, TypeError, AttributeError):
        return None
    return value if place == len(tokens) and None not in value[0] else None


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: str(r[:7]))


def expression(rnd, deep=3):
    if deep == 0 or rnd.random() < 0.3:
        name = rnd.choice(["MIT", "Apache-2.0", "GPL-2.0+", "GPL-3.0-only", "LicenseRef-Own", "BSD-3-Clause"])
        return f"{name} WITH Classpath-exception-2.0" if name.startswith("GPL") and rnd.random() < 0.5 else name
    both = f"{expression(rnd, deep - 1)} {rnd.choice(['AND', 'OR', 'and', 'or'])} {expression(rnd, deep - 1)}"
    return f"({both})" if rnd.random() < 0.6 else both


def test_against_plain_search(make_docs):
    rnd = random.Random(4)
    parts = [*L.NOTICES, *L.BASE, "under the", "mit", "license", "version 2", "Cc By Nc", "çc by nc", "words", "gnu general"]
    rows = []
    for i in range(150):
        glue = [rnd.choice([" ", "\n", " -- ", ", ", "_"]) for _ in range(12)]
        rows.append((i, "".join(rnd.choice(parts) + g for g in glue)))
    for i in range(150, 260):
        rows.append((i, f"some text\n// SPDX-License-Identifier: {expression(rnd)}\nunder the MIT license\nLicense: {expression(rnd)}\n"))
    assert result(L.scan_licenses(make_docs(rows, extra=True))) == expected(rows)


@pytest.mark.parametrize("text, tokens", [
    (" MIT OR Apache-2.0", "mit or apache-2.0"), (" (MIT AND GPL-2.0+) OR foo", "( mit and gpl-2.0+ )"), (" MIT. Or not", "mit"),
    (" see below", ""), (" (MIT", ""), (" GPL-2.0 WITH Classpath-exception-2.0 AND MIT", "gpl-2.0 with classpath-exception-2.0 and mit"),
    (" MIT WITH nothing", "mit"), (" MIT AND (", "mit"), ("\nMIT", ""), ("", ""), (" ) MIT", ""), (" \"ISC\",", "isc"),
])
def test_the_longest_expression_is_read(text, tokens):
    assert " ".join(L.read_expression(text.lower(), 0)) == tokens


def test_operators_bind_with_and_or():
    assert L.to_postfix("a or b and c with d or e".split()) == "a b c d with and or e or".split()
    labels, free = L.evaluate(L.to_postfix("gpl-3.0-only or ( mit and isc )".split()))
    assert labels == {"gpl-3", "mit", "isc"} and free
    assert not L.evaluate(L.to_postfix("gpl-3.0-only and ( mit or isc )".split()))[1]
    deep = ["("] * 3000 + ["mit"] + [")"] * 3000
    assert L.evaluate(L.to_postfix(deep)) == ({"mit"}, True)


def test_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (50, "cc by nc " * 20_000), (50, "cc by nc"), (50, "cc by nc"), (51, "CC BY-NC 4.0."), (52, "cc by nc")]
    assert result(L.scan_licenses(make_docs(rows, extra=True))) == expected(rows)
    assert result(L.scan_licenses(make_docs(rows).limit(0))) == []


def test_places_of_notices(make_docs):
    row = L.scan_licenses(make_docs([(1, "It is under the MIT license; not the GNU General Public License, version 3")])).first()
    assert list(zip(row["places"], row["found"], strict=True)) == [(2, "mit"), (3, "mit"), (8, "gpl"), (8, "gpl-3")]
    assert row["labels"] == "gpl,gpl-3,mit" and row["permissive"] is False
