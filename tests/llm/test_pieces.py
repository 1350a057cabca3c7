import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXT = st.one_of(st.text(), st.text(alphabet=" \n\tabehinorst.", max_size=80), st.lists(st.sampled_from(
    ["the", " ", "  ", "ing", "straße", "über", "日本語", "😀", "\n", "function", "==", "1234", "▁", "é"]), max_size=25).map("".join))


def ids(texts):
    return [np.frombuffer(b, "<i4").tolist() for b in P.load(PATH).encode(texts)]


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_equal_the_model_and_decode_back(texts):
    got = ids(texts)
    assert got == [SP.encode(t) for t in texts]
    assert P.load(PATH).decode([np.array(g, "<i4").tobytes() for g in got]) == [t.replace("▁", " ") for t in texts]


def test_documents_equal_the_model(spark):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:120]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, None, ""), (901, "", ""), (902, "ab " * 50000, ""), (0, texts[0], "again")]
    got = P.round_trip(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()
    want = {i: None if t is None else SP.encode(t) for i, t, _ in rows}
    assert len(got) == len(rows)
    assert all(r.ids == want[r.doc_id] and r.same in (True, None) for r in got)
    back = P.decode(P.encode(spark.createDataFrame(rows[:5], "doc_id long, text string, ids string"), PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts[:5]))
    assert P.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_ids_do_not_depend_on_what_is_remembered(monkeypatch):
    """Generations of three words: words that come back are encoded as the first time."""
    monkeypatch.setattr(P, "_CACHE", 3)
    model = P.Model(PATH)
    texts = ["the cat sat on the mat", "on the straße", "", "a b c d e f g", "the mat sat", "cat über 日本語", "a cat"] * 3
    got = [np.frombuffer(b, "<i4").tolist() for t in texts for b in model.encode([t])]
    assert got == [SP.encode(t) for t in texts]
    assert len(model.known) + len(model.older) <= 2 * (3 + 8)
