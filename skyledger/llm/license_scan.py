"""License scans: Aho-Corasick finds notices and identifier tags, a shunting-yard parser evaluates expressions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import over_slices

# Fixed values of the contract: phrases whose places are counted.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Words that notices of public licences consist of.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license": "mit",
    "mit licensed": "mit",
    "licensed under the apache license": "apache",
    "apache license 2 0": "apache-2",
    "apache software license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3",
    "3 clause bsd license": "bsd-3",
    "bsd 3 clause": "bsd-3",
    "2 clause bsd license": "bsd-2",
    "bsd 2 clause": "bsd-2",
    "under the bsd license": "bsd",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "version 2 of the gnu general public license": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "version 3 of the gnu general public license": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu library general public license": "lgpl-2",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license v 2": "mpl-2",
    "eclipse public license": "epl",
    "eclipse public license v 2": "epl-2",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license": "bsl-1",
    "artistic license 2 0": "artistic-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "do what the fuck you want to public license": "wtfpl",
    "cc0 1 0": "cc0",
    "cc zero": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

# Public licence identifiers, lower-cased, with their labels.
IDENTIFIERS = {
    "mit": "mit", "mit-0": "mit-0", "x11": "x11", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "wtfpl": "wtfpl",
    "0bsd": "0bsd", "bsd-2-clause": "bsd-2", "bsd-3-clause": "bsd-3", "bsd-4-clause": "bsd-4",
    "apache-1.1": "apache-1.1", "apache-2.0": "apache-2", "bsl-1.0": "bsl-1", "python-2.0": "python-2", "postgresql": "postgresql",
    "artistic-2.0": "artistic-2", "cc0-1.0": "cc0", "cc-by-3.0": "cc-by", "cc-by-4.0": "cc-by",
    "cc-by-sa-3.0": "cc-by-sa", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-nc-sa-4.0": "cc-by-nc-sa", "cc-by-nc-nd-4.0": "cc-by-nc-nd",
    "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2-or-later",
    "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3-or-later",
    "lgpl-2.0-only": "lgpl-2", "lgpl-2.1": "lgpl-2.1", "lgpl-2.1-only": "lgpl-2.1", "lgpl-2.1-or-later": "lgpl-2.1-or-later",
    "lgpl-3.0": "lgpl-3", "lgpl-3.0-only": "lgpl-3", "lgpl-3.0-or-later": "lgpl-3-or-later",
    "agpl-3.0": "agpl-3", "agpl-3.0-only": "agpl-3", "agpl-3.0-or-later": "agpl-3-or-later",
    "gfdl-1.3-only": "gfdl", "mpl-1.1": "mpl-1", "mpl-2.0": "mpl-2", "epl-1.0": "epl-1", "epl-2.0": "epl-2",
    "cddl-1.0": "cddl", "eupl-1.2": "eupl", "ofl-1.1": "ofl", "openssl": "openssl",
}
EXCEPTIONS = {  # True: code that merely uses the work is free of its terms
    "classpath-exception-2.0": True, "gcc-exception-3.1": True, "llvm-exception": True, "openjdk-assembly-exception-1.0": True,
    "linux-syscall-note": True, "autoconf-exception-3.0": False, "bison-exception-2.2": False, "font-exception-2.0": True,
}
PERMISSIVE = frozenset(
    "mit mit-0 x11 isc zlib unlicense wtfpl 0bsd bsd bsd-2 bsd-3 bsd-4 apache apache-1.1 apache-2 bsl-1 python-2 postgresql "
    "artistic-2 cc0 cc-by public-domain".split()
)
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", "\"license\":", "licenses:")
TAG_WEIGHT = 0.95

# what is no word character, after lower-casing, becomes a blank
_WORDS = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
_TOKEN = re.compile(r"[ \t\"']*([()]|[a-z0-9.+-]+)")
_BINDS = {"or": 1, "and": 2, "with": 3}
_built: dict = {}


def _automata():
    """Automata of the notices, by words, and of the tags; each Python worker builds them once."""
    if not _built:
        import ahocorasick

        notices, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase in {**NOTICES, **BASE}:
            # notices before base ones: a phrase of both is reported once and counts for both
            label, base = NOTICES.get(phrase, BASE.get(phrase)), BASE.get(phrase)
            notices.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, label, base))
        for tag in TAGS:
            tags.add_word(tag, len(tag))
        notices.make_automaton()
        tags.make_automaton()
        _built.update(notices=notices, tags=tags)
    return _built["notices"], _built["tags"]


# ---- expressions

def read_expression(text: str, at: int) -> list[str]:
    """Tokens of the longest expression that begins at ``at``, on one line; empty if there is none."""
    tokens, good, depth, operand, after_with = [], 0, 0, True, False
    while found := _TOKEN.match(text, at):
        token, at = found[1], found.end()
        plain = token.rstrip(".")
        if operand and token == "(" and not after_with:
            depth += 1
        elif operand and (plain in EXCEPTIONS if after_with else _licence(plain) is not None):
            operand = after_with = False
            tokens.append(plain)
            good = len(tokens) if not depth else good
            if plain != token:
                break
            continue
        elif not operand and token == ")" and depth:
            depth -= 1
        elif not operand and token in _BINDS and not (token == "with" and tokens[-1] in (*EXCEPTIONS, ")")):
            operand, after_with = True, token == "with"
        else:
            break
        tokens.append(token)
        good = len(tokens) if not depth and not operand else good
    return tokens[:good]


def _licence(token: str) -> str | None:
    """Label of a licence identifier."""
    if token in IDENTIFIERS:
        return IDENTIFIERS[token]
    if token.endswith("+") and token[:-1] in IDENTIFIERS:
        return f"{IDENTIFIERS[token[:-1]]}-or-later"
    return token if token.startswith("licenseref-") and len(token) > 11 else None


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, operators by how they bind (with, and, or), to the left."""
    out, waiting = [], []
    for token in tokens:
        if token in _BINDS:
            while waiting and _BINDS.get(waiting[-1], 0) >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        elif token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            out.append(token)
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """Labels in an expression, and whether some choice it offers asks for permissive terms only."""
    labels, stack = set(), []
    for token in postfix:
        if token in _BINDS:
            right, left = stack.pop(), stack.pop()
            stack.append(left and right if token == "and" else left or right)
        elif token in EXCEPTIONS:
            labels.add(token)
            stack.append(EXCEPTIONS[token])
        else:
            label = _licence(token)
            labels.add(label)
            stack.append(label in PERMISSIVE)
    return labels, stack[-1]


# ---- texts

def _scan(part: pa.RecordBatch, texts: list) -> dict:
    notices, tags = _automata()
    columns = {name: [] for name in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permissive", "places", "found",
    )}
    for text in texts:
        words = (text or b"").translate(_WORDS).split()
        spaced = f" {b' '.join(words).decode('latin-1')} "
        places, found, base_places, base, labels, doubt = [], [], [], set(), set(), 1.0
        at = word = 0
        for end, (length, n, label, base_label) in notices.iter(spaced):
            begin = end - length + 1
            word += spaced.count(" ", at, begin) if begin >= at else -spaced.count(" ", begin, at)
            at = begin
            places.append(word)
            found.append(label)
            doubt *= 0.5 ** (n - 1) if label not in labels else 1.0
            labels.add(label)
            if base_label:
                base_places.append(word)
                base.add(base_label)
        labels |= base
        expressions, free = [], []
        lower = (text or b"").translate(_LOWER).decode("latin-1")
        for end, length in tags.iter(lower):
            before = lower[end - length:end - length + 1] if end >= length else ""
            if before.isalnum() or before in ("-", "_"):
                continue
            tokens = read_expression(lower, end + 1)
            if tokens:
                told, permissive = evaluate(to_postfix(tokens))
                labels |= told
                doubt *= 1 - TAG_WEIGHT
                expressions.append(" ".join(tokens))
                free.append(permissive)
        columns["n_words"].append(len(words))
        columns["n_base"].append(len(base_places))
        columns["first_word"].append(min(base_places, default=None))
        columns["last_word"].append(max(base_places, default=None))
        columns["base_labels"].append(",".join(sorted(base)))
        columns["labels"].append(",".join(sorted(labels)))
        columns["score"].append(1.0 - doubt)
        columns["expressions"].append(expressions)
        columns["permissive"].append(all(free) and PERMISSIVE.issuperset(found) if labels else None)
        columns["places"].append(places)
        columns["found"].append(found)
    kinds = {"score": pa.float64(), "permissive": pa.bool_(), "base_labels": pa.string(), "labels": pa.string()}
    lists = {"expressions": pa.list_(pa.string()), "places": pa.list_(pa.int64()), "found": pa.list_(pa.string())}
    out = {name: pa.array(values, kinds.get(name) or lists.get(name) or pa.int64()) for name, values in columns.items()}
    return out | {"doc_id": part.column("doc_id")}


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>, permissive boolean, places array<long>, found array<string>"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """What every document says of its licences.

    Texts are lower-cased in A-Z; words are runs of letters, digits and characters beyond
    ASCII. n_base, first_word, last_word and base_labels tell of the places where the words
    of a base phrase stand one after the other. ``found`` and ``places`` list all notices
    and the words they begin at; ``expressions`` the licence expressions after identifier
    tags, the longest valid one each; ``labels`` all labels, base ones included, in order
    and comma-joined. ``score`` is 1 less the doubt that is left: a label's first notice of n words
    halves it n - 1 times, a tag leaves a twentieth. ``permissive`` says whether all
    notices are permissive and each expression offers a permissive choice; null without a
    label.

    Null and empty texts have no words, no label and a score of 0; repeated rows are each
    judged, null ids kept; an empty table gives no rows; other columns are not read. A row
    is judged on its own, so nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return over_slices(rows, _scan, SCHEMA)
