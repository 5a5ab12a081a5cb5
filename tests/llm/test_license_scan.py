import random
import re

import pytest

from panelcast.llm import license_scan as L
from panelcast.llm import registry

SCHEMA = "doc_id long, text string, n_words string, id string, findings string, score double"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_places(text, phrases):
    ws = words_of(text)
    out = []
    for phrase, label in phrases.items():
        p = phrase.split()
        out += [(i, len(p), label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    return sorted(out)


TEXTS = [
    None, "", " ", "CC BY", "cc-by", "(CC) BY-NC 4.0", "ccby", "cc by cc by", "cc byé", "é cc by", "xcc by", "CC\x00BY", "cc\nby 1",
    "GNU Lesser General Public License", "general public", "license", "all rights reserved. All Rights Reserved",
    "MIT License", "commit license", "the MIT License text", "license: general public license license",
    "all rights " * 3 + "reserved", "word " * 50_000 + "cc by", "a" * 100_000, "Apache License, Version 2.0", "cc0", "日本 cc by 日本",
]


def test_phrases_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [w for p in [*L.BASE, *L.NOTICES] for w in p.split()] + ["é", "x1"]
    texts = TEXTS + ["".join(rng.choice(vocabulary).upper() + rng.choice([" ", "  ", "-", ", ", "\n", "é"]) for _ in range(60)) for _ in range(150)]
    texts += [" ".join(rng.choice(list(L.BASE | L.NOTICES)) for _ in range(6)) for _ in range(100)]
    rows = [(k, t, "n", "i", None, 0.5) for k, t in enumerate(texts)] + [(None, "cc by", "n", "i", None, 0.5)] * 2
    got = L.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for k, t in enumerate(texts):
        r = by_id[k]
        assert r.n_words == len(words_of(t))
        assert sorted((f.first, f.words, f.label) for f in r.findings if f.kind == "base") == brute_places(t, L.BASE), t
        assert sorted((f.first, f.words, f.label) for f in r.findings if f.kind == "notice") == brute_places(t, L.NOTICES), t
    assert [(f.first, f.label) for f in by_id[None].findings] == [(0, "cc-by")]


@pytest.mark.parametrize(
    ("text", "postfix", "burden", "labels"),
    [
        ("MIT", ["MIT"], 1, ["mit"]),
        ("MIT OR GPL-2.0-only", ["MIT", "GPL-2.0-only", "or"], 1, ["gpl", "mit"]),
        ("MIT AND GPL-2.0-or-later */", ["MIT", "GPL-2.0-or-later", "and"], 3, ["gpl", "mit"]),
        ("MIT OR GPL-3.0 AND AGPL-3.0", ["MIT", "GPL-3.0", "AGPL-3.0", "and", "or"], 1, ["agpl", "gpl", "mit"]),
        ("(MIT or GPL-3.0) and AGPL-3.0+", ["MIT", "GPL-3.0", "or", "AGPL-3.0+", "and"], 4, ["agpl", "gpl", "mit"]),
        ("GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0", "Classpath-exception-2.0", "with"], 2, ["gpl"]),
        ("GPL-2.0 WITH other-exception OR MPL-2.0", ["GPL-2.0", "other-exception", "with", "MPL-2.0", "or"], 2, ["gpl", "mpl"]),
        ("AGPL-3.0 WITH Classpath-exception-2.0", ["AGPL-3.0", "Classpath-exception-2.0", "with"], 4, ["agpl"]),
        ("LicenseRef-own AND MIT", ["LicenseRef-own", "MIT", "and"], 5, ["licenseref-own", "mit"]),
        ("MIT This file is free", ["MIT"], 1, ["mit"]),
        ("((MIT))) x", ["MIT"], 1, ["mit"]),
        ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"], 5, ["cc-by-nc"]),
        ("MITX", ["MITX"], 5, ["mitx"]),
    ],
)
def test_expressions(text, postfix, burden, labels):
    assert L.read_expression(text.encode()) == postfix
    assert L.evaluate(postfix) == (burden, labels)


@pytest.mark.parametrize("text", ["", "OR MIT", "MIT OR", "(MIT", "()", "MIT AND OR GPL", "*/", "(MIT OR) GPL", "WITH"])
def test_what_is_no_expression(text):
    assert L.read_expression(text.encode()) is None


def test_expression_equals_recursive_descent():
    """Random expressions, against an evaluation by splitting at the weakest operator."""
    rng = random.Random(6)

    def make(depth):
        """(text, burden) of a random expression."""
        kind = rng.choice(["id", "or", "and", "with", "group"]) if depth else "id"
        if kind in ("id", "with"):
            name, burden = rng.choice([("MIT", 1), ("GPL-2.0", 3), ("AGPL-3.0", 4), ("CC0-1.0", 0), ("own", 5)])
            if kind == "with":
                return f"{name} with GCC-exception-3.1", 2 if burden == 3 else burden
            return name, burden
        a, b = make(depth - 1), make(depth - 1)
        if kind == "group":
            return f"( {a[0]} )", a[1]
        joined = f"({a[0]}) {kind.upper()} ({b[0]})"
        return joined, (min if kind == "or" else max)(a[1], b[1])

    for _ in range(300):
        text, burden = make(4)
        assert L.evaluate(L.read_expression(text.encode()))[0] == burden, text
    flat = ["MIT", "GPL-2.0", "AGPL-3.0", "own"]
    value = {"MIT": 1, "GPL-2.0": 3, "AGPL-3.0": 4, "own": 5}
    for _ in range(300):  # without parentheses: AND binds first
        ids = [rng.choice(flat) for _ in range(5)]
        ops = [rng.choice(["AND", "OR"]) for _ in range(4)]
        text = " ".join(x for pair in zip(ids, [*ops, ""]) for x in pair).strip()
        want = min(max(value[i] for i in part.split(" AND ")) for part in text.split(" OR "))
        assert L.evaluate(L.read_expression(text.encode()))[0] == want


def test_tags_in_texts(spark):
    texts = {
        1: "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;",
        2: "# spdx-license-identifier: GPL-2.0 WITH Linux-syscall-note",
        3: "SPDX-License-Identifier:\nMIT",
        4: "License-Expression: MIT AND CC-BY-4.0\r\nSPDX-License-Identifier: AGPL-3.0-only <b>",
        5: "SPDX License Identifier",
        6: 'license_expression = "ISC"',
    }
    df = spark.createDataFrame([(k, t, "n", "i", None, 0.5) for k, t in texts.items()], SCHEMA)
    got = {r.doc_id: [(f.label, f.first, f.burden) for f in r.findings] for r in L.scan_licenses(df).collect()}
    assert got == {
        1: [("apache-2.0", 0, 1), ("mit", 0, 1)],
        2: [("gpl", 0, 2)],
        3: [(L.INVALID, 0, 5)],
        4: [("cc-by", 0, 2), ("mit", 0, 2), ("cc-by", 4, 2), ("agpl", 8, 4)],
        5: [(L.INVALID, 0, 5)],
        6: [("isc", 0, 1)],
    }


def test_query(spark, tmp_path):
    texts = [*TEXTS, "SPDX-License-Identifier: MIT OR GPL-2.0\nAll rights reserved", "Licensed under CC BY-NC 4.0."]
    rows = [(k, t, "n", "i", None, 0.5) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["op12_license_scan"][0](spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        places = brute_places(texts[r.doc_id], L.BASE)
        assert (r.n_words, r.n_base) == (len(words_of(texts[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == ((min(p[0] for p in places), max(p[0] for p in places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[2] for p in places}))
        labels = {x for x in r.labels.split(",") if x}
        assert labels >= {p[2] for p in places} and r.labels == ",".join(sorted(labels)) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[len(TEXTS)].labels == "gpl,mit,reserved" and by_id[len(TEXTS)].score == 1
    assert by_id[len(TEXTS) + 1].labels == "cc-by,cc-by-nc" and by_id[0].score == 0


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
