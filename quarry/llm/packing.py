"""Packing by Karmarkar-Karp multiway differencing into near-equal windows.

Documents become token ids (plus an end id) and are cut every ``capacity``
ids; a full piece is a window by itself.  What remains of a document is cut
every ``piece`` ids (windows of several small pieces come out far more even
than windows of one or two large ones) and these pieces are dealt by
hash into blocks of bounded size, and each block is split into as many windows
as its tokens need at least: the two partial partitions with the largest
imbalance are merged, largest sums against smallest, until one partition is left.
Whenever its largest window exceeds the capacity the window count rises and
the block is split anew.

Only piece lengths travel to the blocks; ids are made where the text is read.
Blocks hash on (doc_id, start), so a document of any length is spread over
them and no group grows with the data.

Cases: null text counts as empty (the end id alone); repeated rows are packed
as documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import blocks_for, settled

_LOADED: dict = {}


class _Ids:
    """Encoder of one byte-level BPE file: its vocabulary, run by the faster of the two public engines.

    The vocabulary is read by ``tokenizers``; a token's id is its merge rank, so
    the same ids come from ``tiktoken``, at several times the speed (the tests
    hold both against each other).  A text that ``tiktoken`` cannot split (a run
    of about a million blanks exhausts its pattern's stack) goes to ``tokenizers``.
    A special token's literal text in a document takes the token's own id, as
    ``tokenizers`` does by default.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = self.whole = Tokenizer.from_file(path)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        shown = sorted(ByteLevel.alphabet())  # bytes are shown as themselves where printable, else from U+0100 up, in order
        plain = [c for c in shown if ord(c) < 256]
        byte = {c: ord(c) for c in plain}
        byte.update(zip((c for c in shown if ord(c) >= 256), (b for b in range(256) if chr(b) not in byte)))
        ranks = {bytes(byte[c] for c in token): i for token, i in tokenizer.get_vocab().items() if token not in special}
        self.engine = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian bytes."""
        try:
            return self.engine.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except ValueError:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encoder(path: str) -> _Ids:
    """The worker's encoder of one byte-level vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = _Ids(path)
    return _LOADED[path]


def _cuts(n: int, capacity: int, piece: int):
    """Starts and lengths of a document's pieces: full windows, then at most ``piece`` ids each."""
    full = n // capacity * capacity
    for at in range(0, full, capacity):
        yield at, capacity
    for at in range(full, n, piece):
        yield at, min(piece, n - at)


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1,
                  with_ids: bool = True, piece: int = 512) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, ids_crc32 and, if asked for, ids (little-endian bytes)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(tokenizer)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                ids = enc.encode(text or "") + end
                for at, size in _cuts(len(ids) // 4, capacity, piece):
                    part = ids[4 * at:4 * (at + size)]
                    rows.append((doc, at, size, len(ids) // 4, zlib.crc32(part), part if with_ids else None))
                if len(rows) >= 4096:
                    yield frame(rows)
                    rows = []
            yield frame(rows)

    def frame(rows):
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])
        out["doc_id"] = pd.array([None if pd.isna(d) else int(d) for d in out["doc_id"]], dtype="Int64")
        return out if with_ids else out.drop(columns="ids")

    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def _difference(sizes: np.ndarray, windows: int) -> tuple[int, list]:
    """Largest sum and the items of each window, by multiway differencing.

    A partial partition is its sums that are not zero, sorted downwards, and a
    tree number for each; tree t below ``n`` is item t, any other a pair.
    """
    n = len(sizes)
    by_size = np.argsort(-sizes, kind="stable")
    # unions come first: the largest items, one to a window, always have the largest imbalance
    top = by_size[:windows]
    heap = [(-int(sizes[i]), int(i), sizes[i:i + 1], np.array([i])) for i in by_size[windows:]]
    gap = int(sizes[top[0]]) - (int(sizes[top[-1]]) if len(top) == windows else 0)
    heap.append((-gap, -1, sizes[top], top))
    heapq.heapify(heap)
    pairs: list = []
    stamp = itertools.count(n)
    while len(heap) > 1:
        _, _, a, ta = heapq.heappop(heap)
        _, _, b, tb = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:  # sorted downwards against sorted upwards: the smallest of a meet the smallest left of b
            low, lift = len(a) - over, len(b) - over
            fresh = np.arange(n + len(pairs), n + len(pairs) + over)
            pairs += zip(ta[low:].tolist(), tb[lift:][::-1].tolist())
            sums = np.concatenate([a[:low], a[low:] + b[lift:][::-1], b[:lift]])
            trees = np.concatenate([ta[:low], fresh, tb[:lift]])
        else:
            sums, trees = np.concatenate([a, b]), np.concatenate([ta, tb])
        order = np.argsort(-sums, kind="stable")
        sums, trees = sums[order], trees[order]
        gap = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-gap, next(stamp), sums, trees))
    _, _, sums, trees = heap[0]
    return int(sums[0]), [_leaves(int(t), pairs, n) for t in trees]


def _leaves(tree: int, pairs: list, n: int) -> list:
    out, todo = [], [tree]
    while todo:
        t = todo.pop()
        if t < n:
            out.append(t)
        else:
            todo += pairs[t - n][::-1]
    return out


def split_block(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each item: near-equal windows of at most ``capacity``."""
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if sizes.max() > capacity:
        raise ValueError("an item is larger than a window")
    windows = -(-int(sizes.sum()) // capacity)
    while True:
        largest, windowed = _difference(sizes, windows)
        if largest <= capacity:
            break
        windows += max(1, windows // 128)
    window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for w, items in enumerate(windowed):
        at = 0
        for i in items:
            window[i], offset[i] = w, at
            at += int(sizes[i])
    return window, offset


def pack(pieces: DataFrame, capacity: int = 2048, per_block: int = 1024) -> DataFrame:
    """``pieces`` with sequence_id and offset; needs doc_id, start and length, carries every other column.

    ``pieces`` is read twice: pass a settled table.
    """
    rest = pieces.filter(F.col("length") < capacity)
    blocks = blocks_for(rest.count(), per_block)
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", sequence_id long, offset long"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values(["doc_id", "start"], kind="stable")
        window, offset = split_block(order["length"].to_numpy(np.int64), capacity)
        return order.assign(sequence_id=(order["block"].to_numpy(np.int64) * 2**24 + window) * 2, offset=offset)

    packed = dealt.groupBy("block").applyInPandas(run, schema).drop("block")
    alone = (pieces.filter(F.col("length") >= capacity)
                   .withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long")))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = settled(cut_documents(docs, tokenizer, capacity, end_id, with_ids=False))
    return pack(pieces, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
