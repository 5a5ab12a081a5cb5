"""License scans: identifier tags and notice phrases by one Aho-Corasick pass, expressions by shunting-yard.

A text (A-Z lower-cased) is seen as its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by
one space, so that a phrase is found whatever stands between its words.  One
automaton holds all notice phrases and the words of the identifier tags; each hit
must begin and end at a word's border.  All places count, overlapping ones too.

After a tag (``SPDX-License-Identifier:`` and the like) the rest of the line is
read as a licence expression: identifiers, ``AND``, ``OR``, ``WITH`` (any case) and
parentheses, by a shunting-yard parser with WITH before AND before OR.  Reading
stops where the expression can't go on: at another character, or at two
identifiers side by side.  What is no expression is labelled ``spdx-invalid``.

Burden, from 0 (public domain) to 6 (all rights reserved), is the fixed table's
value of a label; an unknown identifier has 5.  ``OR`` leaves the choice (the
smaller), ``AND`` binds to both (the larger), ``WITH`` a known linking exception
lowers strong copyleft to weak.  All findings of a text bind, so its score is
the largest burden over 6, and 0 without findings.

Defined results: NULL or empty texts have 0 words and no findings.  Rows are
independent; repeated rows give repeated results.  An empty table gives no rows.
Only the id and text columns are read.  A text must fit a task's memory some ten
times over; there is no other limit on texts, places or expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notice phrases and their labels.
NOTICES = {
    "affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "gnu gpl": "gpl",
    "lesser general public license": "lgpl",
    "licensed under the apache license": "apache-2.0",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "proprietary and confidential": "proprietary",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "public-domain",
}

# Words of the tags that an expression follows.
TAGS = ("spdx license identifier", "license expression")

# Burden of a label, 0 to 6.
BURDEN = {
    "public-domain": 0, "cc0": 0,
    "apache-2.0": 1, "bsd": 1, "isc": 1, "mit": 1,
    "cc-by": 2, "epl": 2, "lgpl": 2, "mpl": 2,
    "cc-by-sa": 3, "gpl": 3,
    "agpl": 4,
    "cc-by-nc": 5, "cc-by-nd": 5,
    "proprietary": 6, "reserved": 6,
}
UNKNOWN = 5
MOST = 6

# Beginnings of expression identifiers and the label they belong to (the longest counts).
FAMILIES = {
    "0bsd": "bsd", "agpl": "agpl", "apache-2.0": "apache-2.0", "bsd": "bsd", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc",
    "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc0": "cc0", "epl": "epl", "gpl": "gpl", "isc": "isc",
    "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "public-domain",
}

# Exceptions that let other works link to strong copyleft.
LINKING = ("classpath-exception", "gcc-exception", "linux-syscall-note", "gpl-cc", "font-exception", "openssl-exception")

INVALID = "spdx-invalid"
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9.+:-]+)")

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True
_NEWLINE = 10


def family(identifier: str) -> str:
    """The label of an expression's identifier; the identifier itself, lower-cased, if unknown."""
    name = identifier.lower()
    known = [f for f in FAMILIES if name == f or name.startswith((f + "-", f + "+"))]
    return FAMILIES[max(known, key=len)] if known else name


def read_expression(data: bytes) -> list[str] | None:
    """The tokens of the expression that ``data`` begins with, in postfix order; None if it is none."""
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether the last thing read is one
    at = 0
    while found := _TOKEN.match(data, at):
        token = found[1].decode()
        word = token.lower()
        if token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if "(" not in stack:
                break
            if not operand:
                return None
            while (top := stack.pop()) != "(":
                out.append(top)
        elif word in _STRENGTH:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _STRENGTH[stack[-1]] >= _STRENGTH[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        else:
            if operand:
                break
            out.append(token)
            operand = True
        at = found.end()
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[int, list[str]]:
    """(burden, labels) of an expression in postfix order."""
    stack: list[tuple[int, str]] = []
    labels = []
    for k, token in enumerate(postfix):
        if token == "with":
            exception, (burden, name) = stack.pop()[1].lower(), stack.pop()
            linking = burden == BURDEN["gpl"] and exception.startswith(LINKING)
            stack.append((BURDEN["lgpl"] if linking else burden, name))
        elif token in _STRENGTH:
            (a, _), (b, _) = stack.pop(), stack.pop()
            stack.append((min(a, b) if token == "or" else max(a, b), ""))
        else:
            label = family(token)
            stack.append((BURDEN.get(label, UNKNOWN), token))
            if postfix[k + 1 : k + 2] != ["with"]:  # else it names an exception
                labels.append(label)
    return stack[0][0], sorted(set(labels))


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase, label in (NOTICES | BASE).items():
        out.add_word(f" {phrase} ", ("base" if phrase in BASE else "notice", label, phrase.count(" ") + 1, len(phrase) + 2))
    for tag in TAGS:
        out.add_word(f" {tag} ", ("tag", "", tag.count(" ") + 1, len(tag) + 2))
    out.make_automaton()
    return out


def _find(automaton, col) -> tuple[np.ndarray, list[tuple]]:
    """(words per text, findings as (row, kind, label, first word, words, expression, burden)) of a text column."""
    data, offsets = C.text_buffer(col)
    rows = len(offsets) - 1
    # Between texts: a line break no phrase can hold, then a space; after each, a space that ends its last word.
    lengths = np.diff(offsets)
    begin = offsets[:-1] + 3 * np.arange(rows)
    wide = np.full(len(data) + 3 * rows, 32, np.uint8)
    wide[C.spread(begin + 2, lengths)] = data
    lower = C._LOWER[wide]
    inside = _INSIDE[lower]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    kept[begin] = kept[begin + 1] = True
    flat = np.where(inside, lower, 32)
    flat[begin] = _NEWLINE
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    starts = np.flatnonzero(start)
    text_at = np.searchsorted(starts, begin)
    n_words = np.diff(np.concatenate([text_at, [len(starts)]]))
    start_kept = np.cumsum(kept)[starts] - 1  # place of each word in the flat text
    found = []
    for last, (kind, label, size, length) in automaton.iter(flat[kept].tobytes().decode("latin-1")):
        word = int(np.searchsorted(start_kept, last - length + 2))
        row = int(np.searchsorted(begin, starts[word], side="right")) - 1
        first = word - int(text_at[row])
        if kind != "tag":
            found.append((row, kind, label, first, size, None, BURDEN[label]))
            continue
        stop = int(starts[word + size - 1])
        while inside[stop]:
            stop += 1
        line = wide[stop : int(begin[row] + 2 + lengths[row])].tobytes()
        line = re.match(rb"[^\n\r]*", line)[0].lstrip(b" \t:=\"'")
        postfix = read_expression(line)
        if postfix is None:
            found.append((row, kind, INVALID, first, size, None, UNKNOWN))
        else:
            burden, labels = evaluate(postfix)
            found += [(row, kind, name, first, size, " ".join(postfix), burden) for name in labels]
    return n_words, found


FINDING = "struct<kind:string,label:string,first:long,words:int,expression:string,burden:int>"


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, findings`` for every row.

    A finding has kind (base, notice or tag), label, its first word (from 0), its
    number of words, the expression in postfix order (tags) and the burden.
    """
    fields = ["kind", "label", "first", "words", "expression", "burden"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = C.held(("licenses",), _automaton)
        for batch in batches:
            for piece in C.slices(batch, text_col):
                n_words, found = _find(automaton, piece.column(text_col))
                found.sort(key=lambda f: (f[0], f[3], f[4], f[2]))
                counts = np.bincount([f[0] for f in found], minlength=piece.num_rows)
                inner = pa.StructArray.from_arrays([pa.array([f[k + 1] for f in found], t) for k, t in enumerate(types)], names=fields)
                findings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([piece.column(id_col), pa.array(n_words.astype(np.int64)), findings], names=["id", "n_words", "findings"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_words long, findings array<{FINDING}>").withColumnRenamed("id", id_col)


@query("op12_license_scan")
def op12_license_scan(spark, sf_dir):
    found = scan_licenses(C.documents(spark, sf_dir))
    base = F.filter("findings", lambda f: f.kind == "base")
    labels = lambda items: F.array_join(F.array_sort(F.array_distinct(F.transform(items, lambda f: f.label))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda f: f.first)).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f.first)).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("findings")).alias("labels"),
        (F.coalesce(F.array_max(F.transform("findings", lambda f: f.burden)), F.lit(0)) / MOST).alias("score"),
    )
