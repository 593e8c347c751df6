import random

import numpy as np

from tests.llm.helpers import documents
from vitrine.llm import license_scan as L
from vitrine.llm.queries import op2_license_scan

SF = "/root/testdata/sf0.01"


def brute(text, scanner):
    """Every region of window and two strides, at every start, held exactly."""
    shingles, out = L.text_shingles(text), {}
    for t, (name, _, wanted) in enumerate(scanner.templates):
        size = next(n for n, _ in scanner.classes if n >= len(wanted)) + 2 * scanner.stride[t]
        hit = np.flatnonzero(np.isin(shingles, wanted))
        best = max((len(set(shingles[(i := int(h)):i + size].tolist()) & set(wanted.tolist())) for h in hit),
                   default=0) / len(wanted)
        if best >= L.CONTAINMENT:
            out[name] = best
    return out


def test_scan_equals_brute_force(spark):
    scanner = L.Scanner(L.TEMPLATES)
    got = {}
    for r in op2_license_scan(spark, SF).collect():
        got.setdefault(r.doc_id, {})[r.template] = r.containment
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: m for r in docs if (m := brute(r.text, scanner))}
    assert got == want and len(want) > 10


def test_edited_templates_are_found_and_located(spark):
    rnd = random.Random(3)
    filler = lambda n: " ".join(rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(n))
    rows, want = [], {}
    for i, (name, _, text) in enumerate(L.TEMPLATES * 8):
        words = text.split()
        if len(words) > 40:  # one changed word costs five shingles
            words[rnd.randrange(8, len(words) - 8)] = "CHANGED"
        before = rnd.randrange(0, 30_000 if i % 11 == 0 else 60)
        rows.append((i, f"{filler(before)} {' '.join(words)} {filler(40)}"))
        want[i] = (name, before)
    got = {(r.doc_id, r.template): r for r in L.scan(documents(spark, rows)).collect()}
    found = [got.get((i, name)) for i, (name, _) in want.items()]
    assert all(found)
    assert all(abs(r.start_word - want[r.doc_id][1]) <= 1 for r in found)


def test_bands_keep_their_promise():
    assert 1 - (1 - L.LEAST_LIKENESS ** L.ROWS) ** L.BANDS > 0.998
    rng = np.random.default_rng(7)
    scanner = L.Scanner(L.TEMPLATES)
    hits = 0
    for _ in range(300):  # two sets of likeness 0.4545
        both = rng.integers(0, 1 << 63, 50).astype(np.uint64)
        a = np.concatenate([both, rng.integers(0, 1 << 63, 30).astype(np.uint64)])
        b = np.concatenate([both, rng.integers(0, 1 << 63, 30).astype(np.uint64)])
        ka, kb = (scanner._bands(scanner._hashes(x).min(1, keepdims=True))[:, 0] for x in (a, b))
        hits += bool((ka == kb).any())
    assert hits >= 294


def test_edge_rows(spark):
    line = L.TEMPLATES[0][2]
    df = documents(spark, [(1, None), (2, ""), (3, "a b"), (None, line), (4, line), (4, line),
                           (5, "x " * 60000 + L.TEMPLATES[6][2])]).withColumnRenamed("lang", "template")
    got = sorted(((r.doc_id, r.template, r.containment) for r in L.scan(df).collect()), key=str)
    assert got == [(4, "mit-line", 1.0), (4, "mit-line", 1.0), (5, "mit-grant", 1.0), (None, "mit-line", 1.0)]
    assert L.scan(df.limit(0)).count() == 0


def test_lines_listed_apart_from_the_templates(spark):
    """The statements that close documents, looked for as plain text."""
    lines = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
             "All rights reserved.": "LicenseRef-All-Rights-Reserved", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, spdx) for r in docs for line, spdx in lines.items() if r.text and line in r.text}
    assert {spdx for _, spdx in want} == set(lines.values())
    assert want <= {(r.doc_id, r.license) for r in op2_license_scan(spark, SF).collect()}


def test_templates_of_any_length(spark):
    templates = [("one", "L1", "Proprietary"), ("two", "L2", "Public domain."), ("four", "L4", "No rights are reserved"),
                 ("none", "L0", " ... ")]
    rows = [(1, "proprietary"), (2, "in the PUBLIC -- domain, public domain"), (3, "no rights are"),
            (4, "x " * 20000 + "no rights are reserved"), (5, "public x domain"), (6, None), (7, "...")]
    got = sorted(map(tuple, L.scan(documents(spark, rows), templates).collect()))
    assert got == [(1, "one", "L1", 1.0, 0, 1), (2, "two", "L2", 1.0, 2, 4), (4, "four", "L4", 1.0, 20000, 20004)]
    both = L.scan(documents(spark, [(1, f"{L.TEMPLATES[0][2]} Public domain")]), [*templates, L.TEMPLATES[0]])
    assert {r.template for r in both.collect()} == {"two", "mit-line"}
