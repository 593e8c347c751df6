import hashlib
import random

import pytest

from tests.llm.helpers import documents, write_docs
from vitrine.llm import substring_dedup as S
from vitrine.llm.queries import op11_substring_dedup

SF = "/root/testdata/sf0.01"


def split(text):
    return (text or "").encode().split()


def brute(rows):
    """Every window in a dictionary of first starts."""
    known = {}
    place = lambda doc_id, i: (doc_id is not None, doc_id or 0, i)
    for doc_id, text in rows:
        words = split(text)
        for i in range(len(words) - S.WINDOW + 1):
            key, at = tuple(words[i:i + S.WINDOW]), place(doc_id, i)
            known[key] = min(known.get(key, at), at)
    out = []
    for doc_id, text in rows:
        words = split(text)
        gone = set()
        for i in range(len(words) - S.WINDOW + 1):
            if known[tuple(words[i:i + S.WINDOW])] < place(doc_id, i):
                gone.update(range(i, i + S.WINDOW))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted(map(tuple, S.digest(S.dedup(df)).collect()), key=repr)


def test_whole_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op11_substring_dedup(spark, SF).collect()), key=repr)
    assert got == brute([tuple(r) for r in rows])
    assert sum(r[2] for r in got) > 1000


def awkward(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    hot = text(30)
    rows = [(i, f"{text(rnd.randrange(30))} {hot} {text(rnd.randrange(30))}") for i in range(120)]
    rows += [(None, hot), (500, hot), (500, hot), (500, f"{hot} {hot}"), (501, None), (502, ""), (503, " \t\n"),
             (504, "a b " * 400), (505, "spam " * 1000), (506, "spam\x0bspam\x0c" * 30), (507, "é ü " * 25),
             (508, text(20_000)), (509, text(19)), (510, text(20)), (-3, hot.replace(" ", "\n\r "))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [True, False])
def test_awkward_texts_on_both_ways(spark, monkeypatch, hot):
    rows = awkward(5)
    monkeypatch.setattr(S, "LANE_BYTES", 60_000)
    monkeypatch.setattr(S, "PASS_BYTES", 15_000)
    monkeypatch.setattr(S, "parallelism", lambda spark: 1)
    monkeypatch.setattr(S, "HOT_STRINGS", 20 if hot else 1 << 40)
    assert run(documents(spark, rows).repartition(7)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert run(documents(spark, [])) == []
    from pyspark.sql import functions as F
    df = documents(spark, awkward(6))
    for name in ("digest", "start", "bucket", "_id", "gone", "minimiser"):
        df = df.withColumn(name, F.lit("x"))
    assert run(df) == brute(awkward(6))


def test_strings_hold_many_windows(spark):
    rnd = random.Random(9)
    text = " ".join(str(rnd.randrange(10**9)) for _ in range(20_000))
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401
    given = pa.record_batch([pa.array([1]), pa.array([7]), pa.array([text.encode()])], names=["doc_id", "digest", "text"])
    rows = []
    for batch in S._strings(3, 2)(iter([given])):
        batch = batch.filter(pa.compute.is_valid(batch.column("packed")))
        rows += S._Row.of(batch.append_column("hot", pa.nulls(batch.num_rows, pa.list_(pa.int32()))))
    words = [n for r in rows for p in (0, 1) for n in r.part(p)["words"].tolist()]
    windows = sum(words) - len(words) * (S.WINDOW - 1)
    assert windows == 20_000 - S.WINDOW + 1 and windows > 6 * len(words)
    assert {r.lane for r in rows} == {0, 1, 2}


def test_words_and_hashes():
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"ab\xc3\xa9\x00\x85") for _ in range(rnd.randrange(1, 9))) for _ in range(3000)]
    words += [b"x" * (S.CHUNK + 5), b"x" * (S.CHUNK + 6), b"x" * S.CHUNK, b"y"] * 2
    text = b"\t" + b"".join(w + rnd.choice([b" ", b"\r\n", b"\x0b"]) for w in words)
    bytes_ = S.np.frombuffer(text, S.np.uint8)
    begin, end = S.word_spans(bytes_)
    assert [text[b:e] for b, e in zip(begin, end)] == words == text.split()
    high, low = S.word_codes(bytes_, begin, end)
    for codes in (high, low):  # equal exactly where the words are
        seen = {}
        assert all(seen.setdefault(int(c), w) == w for c, w in zip(codes, words))
        assert len(seen) == len(set(words))
    runs = S.rolled(high, 20, S._BASES[0])
    assert int(runs[7]) == sum(int(h) * pow(int(S._BASES[0]), 19 - j, 1 << 64)
                               for j, h in enumerate(high[7:27])) % (1 << 64)


def test_repeated_run_of_the_query(spark, tmp_path):
    rows = [(i, t) for i, t in awkward(7)]
    path = write_docs(spark, rows, tmp_path)
    assert sorted(map(tuple, op11_substring_dedup(spark, path).collect()), key=repr) == brute(rows)
