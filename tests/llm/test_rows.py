"""Mixing, WARC, chat and quality trees against plain recomputation in Python."""
import base64
import gzip
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.helpers import documents, write_docs
from vitrine.llm import chat, mixing, quality_trees as Q, warc
from vitrine.llm.queries import op4_mixing, op7_warc, op8_chat, op9_quality

SF = "/root/testdata/sf0.001"


# ---- mixing

def brute_deal(budget, children):
    """{name: (cap, weight)} -> {name: share}, by repeated redistribution."""
    got, left = dict.fromkeys(children, 0.0), budget
    open_ = {c for c, (cap, w) in children.items() if w > 0 and cap > 0}
    while open_ and left > 1e-6:
        total = sum(children[c][1] for c in open_)
        parts = {c: min(left * children[c][1] / total, children[c][0] - got[c]) for c in open_}
        for c, x in parts.items():
            got[c] += x
        left -= sum(parts.values())
        open_ = {c for c in open_ if got[c] < children[c][0] - 1e-9}
    return got


def brute_mix(rows, share, epochs, seed=mixing.SEED):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    tree, members = defaultdict(lambda: defaultdict(lambda: defaultdict(float))), defaultdict(list)
    for d, t, lang, source in rows:
        t = t or ""
        dom = f"domain{int(md5(source or '')[0], 16) % 4}"
        n = len([w for w in t.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ")
                 .replace("\r", " ").replace("\n", " ").split(" ") if w])
        tree[dom][lang][source] += n
        members[(dom, lang, source)].append((d, n, f"{'' if d is None else d}:{md5(t)}"))
    cap = lambda x: sum(cap(y) for y in x.values()) if isinstance(x, dict) else x * epochs
    total = cap(tree) / epochs
    out = Counter()
    got1 = brute_deal(total * share, {k: (cap(v), mixing.DOMAIN_WEIGHTS[k]) for k, v in tree.items()})
    for dom, langs in tree.items():
        got2 = brute_deal(got1[dom], {k: (cap(v), mixing.LANG_WEIGHTS.get(k, 1.0)) for k, v in langs.items()})
        for lang, sources in langs.items():
            got3 = brute_deal(got2[lang], {k: (cap(v), 1.0) for k, v in sources.items()})
            for source, tokens in sources.items():
                take = int(got3[source] + 1e-6)
                if not tokens or not got3[source]:
                    continue
                full, rest = divmod(take, int(tokens))
                mine = members[(dom, lang, source)]
                for e in range(full):
                    out.update((d, dom, lang, source, n, e) for d, n, _ in mine)
                keyed = defaultdict(list)
                for d, n, i in mine:
                    keyed[md5(f"{seed}:{full}:{i}")].append((d, n))
                before = 0
                for k in sorted(keyed):
                    size = sum(n for _, n in keyed[k])
                    if before < rest and 2 * before + size <= 2 * rest:
                        out.update((d, dom, lang, source, n, full) for d, n in keyed[k])
                    before += sum(n for _, n in keyed[k])
    return out


def test_mixing_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text", "lang", "source").collect()]
    got = Counter(map(tuple, op4_mixing(spark, SF).collect()))
    assert got == brute_mix(rows, mixing.SHARE, mixing.MAX_EPOCHS)


def test_mixing_meets_its_budget(spark):
    sf = "/root/testdata/sf0.01"
    tokens = op4_mixing(spark, sf).agg(F.sum("n_tokens")).first()[0]
    words = sum(len((r.text or "").split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert 0.95 < tokens / (0.6 * words) < 1.05


def test_mixing_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)],
        "domain string, lang string, source string, tokens long")
    got = {r.source: r.got for r in mixing.leaf_budgets(leaves, 800.0, {}, 1).collect()}
    assert got == pytest.approx({"s1": 10, "s2": 190, "s3": 200, "s4": 400})
    short = leaves.where("source != 's2' and source != 's3'")
    got = {r.source: r.got for r in mixing.leaf_budgets(short, 800.0, {}, 1).collect()}
    assert got == pytest.approx({"s1": 10, "s4": 790})


def test_mixing_edge_rows(spark):
    rows = [(1, "a b c", None, None), (1, "a b c", None, None), (None, "x y", "en", "s"), (2, None, "en", "s"),
            (3, "", "en", "t"), (4, "w " * 500, "en", "s")]
    df = documents(spark, rows)
    got = Counter((r.doc_id, r.m.domain, r.m.lang, r.m.source, r.m.n_tokens, r.m.epoch)
                  for r in mixing.mix(df.withColumn("_leaf", F.lit(1)), "m", 0.7, 2).collect())
    assert got == brute_mix(rows, 0.7, 2)
    assert mixing.mix(df.limit(0), "m").count() == 0


# ---- WARC

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("file", T.StringType())])


def brute_warc(rows):
    first = {}
    for p, html in rows:
        if p is not None:
            first[html or ""] = min(first.get(html or "", p), p)
    out = Counter()
    for p, html in rows:
        raw = (html or "").encode()
        f = first.get(html or "")
        revisit = f is not None and p != f
        out[(p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
             "revisit" if revisit else "response", f if revisit else None)] += 1
    return out


def test_warc_against_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert Counter(map(tuple, op7_warc(spark, SF).collect())) == brute_warc(rows)
    edge = [(1, "http://a.org/x", "same", "f"), (2, "http://a.org/x", "same", None), (3, None, None, None),
            (4, "", "", None), (None, "http://b.org", "same", None), (None, "q", "only null", None),
            (5, "http://A.org:80/é?q=1#f\r\nX: y", "é漢🙂" * 30000, None), (1, "http://a.org/x", "same", "f"),
            (6, "no scheme", "\r\n\r\nWARC/1.1\r\n", None)]
    spark.createDataFrame(edge, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(map(tuple, op7_warc(spark, str(tmp_path)).collect()))
    assert got == brute_warc([(p, h) for p, _, h, _ in edge])
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert op7_warc(spark, f"{tmp_path}/none").count() == 0


def test_archives_are_plain_warc_files_and_lookup_finds_all_captures(spark, tmp_path):
    rows = [(i, f"http://www.h{i % 7}.example.org/p/{i % 50}", f"<p>{i}</p>", None) for i in range(2000)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    captures = warc.write_archives(pages, str(tmp_path), file_bytes=20_000)
    files = [f for f in os.listdir(tmp_path) if f.endswith(".warc.gz")]
    assert len(files) > 3
    text = gzip.open(f"{tmp_path}/{files[0]}").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.count(b"WARC/1.1") > 1
    directory = warc.write_index(captures, str(tmp_path), block_lines=16)
    assert directory.count() >= 2000 // 16
    keys = pages.select(warc.url_key(F.col("url")).alias("url_key")).distinct()
    assert "org,example,h3,www)/p/3" in {r.url_key for r in keys.collect()}
    found = warc.lookup(keys, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, captures.collect()))
    one = keys.where("url_key = 'org,example,h3,www)/p/3'")
    got = warc.read_records(warc.lookup(one, str(tmp_path)), str(tmp_path)).collect()
    assert {(r.id, bytes(r.payload)) for r in got} == {
        (i, f"<p>{i}</p>".encode()) for i in range(2000) if i % 7 == 3 and i % 50 == 3}
    nothing = spark.createDataFrame([("zz)",)], "url_key string")
    assert warc.lookup(nothing, str(tmp_path)).count() == 0


# ---- chat

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                      T.StructField("position", T.StringType())])


def brute_chat(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is None, turn or 0, (role or "").strip(" ") or "unknown",
                         (text or "").replace("<|", "< |"), turn))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: t[:4])
        for p in {t[2] for t in turns} - {"system"}:
            dialogue, spans = "", []
            for _, _, who, text, _ in turns:
                if who == "system":
                    dialogue += f"<|system|>\n{text}<|end|>\n"
                elif who == p:
                    dialogue += "<|assistant|>\n"
                    spans.append((len(dialogue), len(dialogue) + len(text) + 7))
                    dialogue += f"{text}<|end|>\n"
                else:
                    dialogue += f"<|user|>\n{who}: {text}<|end|>\n"
            out[(c, p)] = dialogue, spans
    return out


def rebuilt(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r.conv_id, r.perspective)].append(r)
    done = {}
    for k, rs in out.items():
        rs.sort(key=lambda r: r.position)
        assert [r.position for r in rs] == list(range(1, len(rs) + 1))
        text = ""
        for r in rs:
            assert r.start == len(text)
            text += r.segment
            assert r.end == len(text)
        done[k] = text, [(r.mask_start, r.mask_end) for r in rs if r.mask_start is not None]
    return done


def test_chat_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert rebuilt(op8_chat(spark, SF).collect()) == brute_chat(rows)


def test_chat_many_parties_and_edges(spark):
    rows = [(1, i, f"p{i % 5}", f"line {i} 🙂") for i in range(700)] + [
        (2, None, "a", "late"), (2, 0, None, None), (2, 0, " ", "x <|end|> y"), (2, 0, "a", "b"),
        (2, 0, "a", "b"), (None, 1, "a", "null conv"), (None, 2, "b", "c"), (3, 0, "system", "only")]
    df = spark.createDataFrame([(*r, "z") for r in rows], TURNS)
    assert rebuilt(chat.rotate(df).collect()) == brute_chat(rows)
    assert chat.rotate(df.limit(0)).count() == 0


# ---- quality trees

def test_flattened_trees_equal_a_walk_and_learn():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit(x[:2000], y[:2000], trees=40)
    p = model.scores(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.95
    for row, want in zip(x[2000:2050], p):
        total = model.start
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + bool(row[f[at]] > t[at])
            total += leaf[at - len(f)]
        assert 1 / (1 + np.exp(-total)) == pytest.approx(want)


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op9_quality(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r.quality for r in labels)
    assert right / len(labels) >= 0.9, (right, len(labels))


def test_quality_edge_rows(spark, tmp_path):
    d = write_docs(spark, [(1, None), (2, ""), (None, "x"), (3, "a " * 50000), (3, "b")], tmp_path)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty.write.parquet(f"{d}/labels.parquet")
    rows = op9_quality(spark, d).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    null = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert Q.train(docs, null).start == pytest.approx(np.log(0.999 / 0.001))  # one kind only
    assert Q.score(docs.limit(0), Q.train(docs, null)).count() == 0
