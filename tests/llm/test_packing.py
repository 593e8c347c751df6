import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import documents
from vitrine.llm.packing import pack
from vitrine.llm.queries import op1_packing, tokenizer_path
from vitrine.llm.tokens import encoder

SF = "/root/testdata/sf0.001"


@lru_cache(None)
def _tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def reference_ids(text):
    return _tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def test_word_encoder_equals_whole_text_encoding():
    t = Tokenizer.from_file(tokenizer_path())
    rnd = random.Random(5)
    alphabet = ("abcXYZ 019.,'!?-_#$%&|<>\t\n\x0b\x0c\r\x1c\x1f\x85\xa0\xad\xb5\xaa\xbd\xdf\xe9\xc9"
                "Σσς́İ漢字🙂 　‍")
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["it's we'll I'D 'S <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "", " ", "ÀÉß Ünïcode²"]
    enc = encoder(tokenizer_path())
    for x in texts:
        assert np.frombuffer(enc.encode(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def check_pieces(rows, docs):
    """Every id of every document lies in exactly one piece; windows are gapless."""
    by_sequence = defaultdict(list)
    want = sorted((d, len(ids), tuple(ids)) for d, ids in docs)
    pieces = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        pieces[(r.doc_id, r.doc_tokens)].append(r)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == rs[0].sequence_tokens <= rs[0].tier
    assert sum(r.length for r in rows) == sum(n for _, n, _ in want)
    for d, n, ids in want:
        covered = np.zeros(n, int)
        for r in pieces[(d, n)]:
            covered[r.start:r.start + r.length] += 1
        assert (covered >= 1).all()
    return by_sequence


def test_round_trip_on_documents(spark):
    rows = op1_packing(spark, SF).collect()
    docs = [(r.doc_id, reference_ids(r.text))
            for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    by_sequence = check_pieces(rows, docs)
    ids = dict(docs)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    short = [s for s, rs in by_sequence.items() if rs[0].sequence_tokens not in (256, 512, 1024, 2048)]
    assert len(short) <= 1  # one input partition, one padded tail


def test_step_groups_hold_equal_tokens(spark):
    rows = op1_packing(spark, SF).select("sequence_id", "tier", "step_group").distinct().collect()
    steps = defaultdict(list)
    for r in rows:
        steps[r.step_group].append(r.tier)
    assert all(len(set(t)) == 1 and sum(t) <= 16 * 2048 for t in steps.values())
    for tier in {r.tier for r in rows}:
        part = [s for s in steps.values() if s[0] == tier and sum(s) < 16 * 2048]
        assert len(part) <= 1


def test_edge_rows(spark):
    df = documents(spark, [(1, None), (2, ""), (None, "a b"), (3, "x y z"), (3, "x y z"),
                           (4, "word " * 9000)]).coalesce(1)
    df = df.withColumnRenamed("n_chars", "ids").withColumnRenamed("lang", "start")
    rows = pack(df, tokenizer_path()).collect()
    docs = [(1, [1]), (2, [1]), (None, reference_ids("a b")), (3, reference_ids("x y z")),
            (3, reference_ids("x y z")), (4, reference_ids("word " * 9000))]
    at = defaultdict(int)
    for r in rows:
        at[r.doc_id] += r.length
    assert at == {1: 1, 2: 1, None: 3, 3: 8, 4: 9001}
    assert sum(r.length for r in rows) == sum(len(i) for _, i in docs)
    assert pack(df.limit(0), tokenizer_path()).count() == 0


def test_short_ways_of_new_words_give_the_tokenizers_ids(monkeypatch):
    from vitrine.llm import tokens
    monkeypatch.setattr(tokens, "MEMORY_ENTRIES", 3)  # most words are new again and again
    words = tokens.WordEncoder(tokenizer_path())
    split = []
    monkeypatch.setattr(words, "pieces", lambda w, found=words.pieces: split.append(w) or found(w))
    plain = ["Word", "word,", "ÉLAN.", "ñandú", "l'", "a-", "!"]
    odd = ["it's", "we're,", "x7", "a.b.", "..", "'s", "a«", "ª", "ß.", "µ", "日本", "é́a.", "a<|b", "\x7fa"]
    for text in [*plain, *odd, " ".join(plain + odd + plain)]:
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids), text
    # a word of letters, alone or with one mark behind it, is not searched for its pieces
    assert not {w.lower() for w in plain[:-1]} & {*split}
    assert len(words.by_word) <= 3 and len(words.by_piece) <= 3
