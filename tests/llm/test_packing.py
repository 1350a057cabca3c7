import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, length long"


def whole(text):
    t = Tokenizer.from_file(PATH)
    return t.encode(text, add_special_tokens=False).ids + [1]


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_encoder_equals_the_tokenizer(text):
    got = np.frombuffer(P.encoder(PATH).encode(text), "<u4").tolist()
    assert got + [1] == whole(text)


def test_literal_special_tokens_take_their_own_id():
    for text in ("a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n", "<|endoftext", "<|<|endoftext|>|>", "é<|endoftext|>é"):
        got = np.frombuffer(P.encoder(PATH).encode(text), "<u4").tolist()
        assert got + [1] == whole(text)
    assert whole("a<|endoftext|>b")[1] == 50256


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_split_block_is_whole_and_within_capacity(sizes):
    sizes = np.array(sizes, np.int64)
    window, offset = P.split_block(sizes, 100)
    for w in set(window.tolist()):
        spans = sorted((offset[i], sizes[i]) for i in np.flatnonzero(window == w))
        at = 0
        for o, n in spans:
            assert o == at
            at += n
        assert at <= 100


def test_differencing_by_hand():
    best, groups = P._difference(np.array([8, 7, 6, 5, 4], np.int64), 2)
    # 8-7 and 6-5 leave 4, 1, 1; 4-1 leaves 3, 1; so the sides end two apart: 7+5+4 against 8+6
    assert best == 16 and sorted(map(sorted, groups)) == [[0, 2], [1, 3, 4]]
    assert P._difference(np.array([5, 5, 5, 5], np.int64), 2)[0] == 10


def test_every_id_lies_in_one_piece(spark):
    rnd = random.Random(4)
    texts = {i: " ".join(rnd.choice(["alpha", "beta!", "don't", "naïve", "  ", "1234", "日本"]) for _ in range(rnd.randrange(900)))
             for i in range(60)}
    texts.update({100: None, 101: "", 102: "word " * 9000, 103: "<|endoftext|> is text"})
    rows = [(i, t, "x", 5) for i, t in texts.items()] + [(7, texts[7], "again", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = P.pack_documents(df, PATH).toPandas()
    assert (out.groupby("sequence_id").length.sum() <= 2048).all()
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all()
    for i, t in texts.items():
        ids = whole(t or "")
        g = out[out.doc_id == i].sort_values("start")
        copies = 2 if i == 7 else 1
        assert g.length.sum() == copies * len(ids) and (g.doc_tokens == len(ids)).all()
        for r in g.itertuples():
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
    used = out.groupby("sequence_id").length.sum()
    assert used.sum() / (2048 * len(used)) > 0.93
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_pieces_can_carry_their_ids(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 1)], SCHEMA)
    r = P.cut_documents(df, PATH).first()
    assert np.frombuffer(bytes(r.ids), "<u4").tolist() == whole("a b c") and r.length == r.doc_tokens == 4


def test_a_million_blanks_in_a_row():
    for text in ("a" + " " * 1_100_000 + "b", "\n" * 1_100_000, "x <|endoftext|>" + "\n " * 600_000 + "y"):
        assert np.frombuffer(P.encoder(PATH).encode(text), "<u4").tolist() + [1] == whole(text)
