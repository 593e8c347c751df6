"""Every stage of the pipeline against brute force on its own input."""
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as C
from tests.llm import test_jaccard_join as TJ
from tests.llm import test_native as TN
from tests.llm import test_packing as TP
from tests.llm import test_rows as TR
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (input rows, output rows)"""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, step in C.STAGES:
        got = step(spark, docs, SF)
        if name != "packing":
            assert got.columns == docs.columns
        path = str(tmp_path_factory.mktemp("stage") / name)
        got.write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_quality_rules(stages):
    before, after = stages["quality_rules"]
    verdicts = TN.brute_host_rules([(r.doc_id, r.text, r.source) for r in before])
    kept = {v[0] for v in verdicts if v[-1]}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept) and 0 < len(after) < len(before)


def test_jaccard_join(stages):
    before, after = stages["jaccard_join"]
    groups = TJ.brute([(r.doc_id, r.text) for r in before])
    kept = {d for d, _, c in groups if d == c}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept) and len(after) < len(before)


def test_secrets(stages):
    before, after = stages["secrets"]
    rows = [(r.doc_id, r.text) for r in before]
    base = [TN.brute_base(t) for _, t in rows]
    got = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for (d, t), b, m in zip(rows, base, TN.brute_more(rows, base)):
        out, at = "", 0
        for s, _, e in sorted(b + m):
            if e > at:
                out += (t[at:s] + "[SECRET]") if s >= at else ""
                at = e
        want = out + t[at:]
        assert got[d].text == want
        assert not b or got[d].n_chars == len(want)
    assert any("[SECRET]" in r.text for r in after)


def test_mixing(stages):
    before, after = stages["mixing"]
    want = TR.brute_mix([(r.doc_id, r.text, r.lang, r.source) for r in before], C.MIX_SHARE, C.MIX_EPOCHS)
    times = Counter()
    for (d, *_), k in want.items():
        times[d] += k
    assert Counter(r.doc_id for r in after) == times and max(times.values()) == 2
    assert set(after) <= set(before)


def test_packing(stages):
    before, after = stages["packing"]
    docs = [(r.doc_id, TP.reference_ids(r.text)) for r in before]
    total = Counter()
    for d, ids in docs:
        total[d] += len(ids)
    got, windows = Counter(), defaultdict(int)
    by_id = dict(docs)
    for r in after:
        got[r.doc_id] += r.length
        windows[r.sequence_id] += r.length
        ids = by_id[r.doc_id][r.start:r.start + r.length]
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
    assert got == total and max(windows.values()) <= 2048


def test_edge_rows_pass_all_stages(spark):
    rows = TN.EDGE + [(20, None, None, None), (20, None, None, None)]
    docs = documents(spark, rows).withColumnRenamed("lang", "_spans").selectExpr("*", "_spans AS lang")
    docs = docs.selectExpr("*", "1 AS _verdict", "2 AS _mixed", "3 AS _text_key", "4 AS ids")
    assert C.STAGES[0][1](spark, docs, SF).count() == 0  # none has 50 words that don't repeat
    for name, step in C.STAGES[1:]:
        docs = step(spark, docs, SF)
    assert docs.count() > 0
    empty = documents(spark, [(1, "x")]).limit(0)
    for name, step in C.STAGES:
        empty = step(spark, empty, SF)
    assert empty.count() == 0
