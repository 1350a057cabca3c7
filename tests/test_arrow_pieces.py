"""Arrow maps take bounded pieces of their batches."""

import pyarrow as pa

from quarry.functions.arrow import pieces
from quarry.operators import tokenizer


def test_pieces_are_bounded_and_whole():
    rows = [b"x" * 2000] * 5000 + [b"y" * 9_000_000] + [b"z"] * 10
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["t"])
    cut = list(pieces([batch, batch.slice(0, 0)]))
    assert [v for p in cut for v in p.column(0).to_pylist()] == rows
    assert all(p.nbytes <= 1 << 22 or p.num_rows == 1 for p in cut) and len(cut) < 40


def test_decode_in_pieces(spark):
    model = tokenizer.BpeModel(vocab={7: b"h", 3: b"\xc3", 9: b"\xa9", 1: b""}, merges=[], specials=[])
    rows = [(i, ids) for i, ids in enumerate([[7, 3, 9], [], None, [3], [1, 7, 1]] * 50)]
    got = tokenizer.decode(spark.createDataFrame(rows, "k int, ids array<int>").coalesce(1), model).orderBy("k").collect()
    assert [r.text for r in got] == ["hé", "", None, "�", "h"] * 50
    known, spelled = tokenizer._token_arrays("k", type("B", (), {"value": model.vocab}))
    sliced = pa.array([r[1] for r in rows], pa.list_(pa.int32())).slice(1, 4)
    assert tokenizer._joined(sliced, known, spelled).to_pylist() == [b"", None, b"\xc3", b"h"]
