"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid end to end and indexed by a suffix
array; all pieces of the vocabulary are binary-searched in it at once, every
occurrence becomes an edge (start, end, piece), the edges are sorted by
position and relaxed from left to right.

The vocabulary is a byte-pair one, so relaxing by best total score would give
other ids than merging does.  An edge is therefore relaxed only when it is
*compatible* with the piece that ends where it starts: merging the two pieces'
text alone gives back just these two.  A row of pieces is the result of
merging exactly when all neighbours are compatible, so each position is
reached by one piece at most and the last position yields the exact ids.

Pieces never cross a word mark, which makes words independent; a word met
before is taken from a bounded table.  Characters that no piece covers become
byte pieces.  The text is read whole, as it is (identity normalisation, one
word mark put in front), and decoding gives it back.

Cases: null gives null ids; an empty text gives no ids; repeated rows get equal
ids; an empty table gives an empty result.  A word mark (U+2581) in the text
decodes to a blank, as in the model itself.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_SEPARATOR = 0x110000
_SLICE, _CACHE, _DOCS = 1 << 18, 400_000, 1 << 21
_PAIRS = 21  # bits of the table of pairs met last
_LEVELS = 64  # positions of a word that are relaxed in all words at once
_UNREACHED, _LOW, NEVER = -(1 << 40), (1 << 32) - 1, float("-inf")
_LOADED: dict = {}


class Model:
    """Pieces and scores of one model file, and what has been encoded so far."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id, self.byte, self.out = {}, {}, {}, []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.out.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.out.append(b"")
            else:
                self.id[p], self.score[p] = i, sp.get_score(i)
                self.out.append(p.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces cross word marks")
        self.piece = {i: p for p, i in self.id.items()}
        self.single = np.array(sorted(ord(p) for p in self.id if len(p) == 1), np.uint32)
        apart = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in self.id))
        self.split = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|[{apart}]" if apart else "")).findall
        names = sorted(self.id)
        self.ids = np.array([self.id[p] for p in names], np.int64)
        self.size = np.array([len(p) for p in names])
        self.longest = int(self.size.max())
        codes = np.zeros((len(names), 3 * -(-self.longest // 3)), np.int64)
        for row, p in enumerate(names):
            codes[row, :len(p)] = [ord(c) for c in p]
        self.chunks = (codes[:, 0::3] << 42) | (codes[:, 1::3] << 21) | codes[:, 2::3]
        self.spelled = pa.array(self.out, pa.large_binary())
        self.known, self.older, self.built = {}, {}, {}
        self.pairs, self.fits = np.full(1 << _PAIRS, -1), np.zeros(1 << _PAIRS, bool)
        self.judged = {}

    def steps(self, piece: str) -> list:
        """(score of the next merge, first part, last part) while a piece is merged from its characters.

        Empty if merging does not give the piece back; the last row's score is minus infinity.
        """
        if piece not in self.built:
            parts, out = list(piece), []
            while True:
                best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
                out.append((best[0] if best else NEVER, parts[0], parts[-1]))
                if best is None:
                    break
                i = -best[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.built[piece] = out if len(parts) == 1 else []
        return self.built[piece]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of pieces a and b gives these two (a = -1: nothing before).

        Both sides merge on their own until a pair across the border is next (the
        best score first, leftmost of equals): then they are not compatible.
        """
        if b < -1:
            return True
        right = self.steps(self.piece[b])
        if a < 0:
            return bool(right)
        left = self.steps(self.piece[a])
        if not left or not right:
            return False
        i = j = 0
        while True:
            mine, across, other = left[i][0], self.score.get(left[i][2] + right[j][1], NEVER), right[j][0]
            if max(mine, across, other) == NEVER:
                return True
            if mine >= max(across, other):
                i += 1
            elif across >= other:
                return False
            else:
                j += 1

    def fitting(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs: a table holds the last pair of each slot, a dictionary all pairs judged."""
        keys = (np.maximum(before, -1) + 1 << 32) | np.maximum(piece, -1) + 1
        at = (keys * 0x9E3779B97F4A7C1).view(np.uint64) >> np.uint64(64 - _PAIRS)
        out, missed = self.fits[at], np.flatnonzero(self.pairs[at] != keys)
        if len(missed):
            new, back = np.unique(keys[missed], return_inverse=True)
            found = np.array([self._judge(k) for k in new.tolist()])[back]
            out[missed] = found
            slots, first = np.unique(at[missed], return_index=True)
            self.pairs[slots], self.fits[slots] = keys[missed[first]], found[first]
        return out

    def _judge(self, key: int) -> bool:
        ok = self.judged.get(key)
        if ok is None:
            ok = self.judged[key] = not key & _LOW or self.compatible((key >> 32) - 1, (key & _LOW) - 1)
        return ok

    def _suffixes(self, chunk: np.ndarray) -> np.ndarray:
        """Positions sorted by their first ``longest`` characters: three at once, then by prefix doubling."""
        _, rank = np.unique(chunk, return_inverse=True)
        step = 3
        while step < self.longest:
            after = np.concatenate([rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)])[:len(rank)]
            _, rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)
            step *= 2
        return np.argsort(rank, kind="stable")

    def _ranges(self, chunk: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of ``order`` whose suffixes start with each piece, by binary search for three characters at a time."""
        chunk = np.concatenate([chunk, np.zeros(self.chunks.shape[1] * 3, np.int64)])
        lo, hi = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(order))
        for i in range(self.chunks.shape[1]):
            rows = np.flatnonzero((self.size > 3 * i) & (lo < hi))
            least = self.chunks[rows, i]
            open_chars = np.maximum(3 * (i + 1) - self.size[rows], 0)
            most = least | ((1 << 21 * open_chars) - 1)
            if i == 0:
                keys = chunk[order]
                lo[rows], hi[rows] = np.searchsorted(keys, least), np.searchsorted(keys, most, "right")
            else:
                a, b = lo[rows], hi[rows]
                lo[rows] = self._first(chunk, order, a, b, least, 3 * i)
                hi[rows] = self._first(chunk, order, a, b, most + 1, 3 * i)
        return lo, np.maximum(lo, hi)

    @staticmethod
    def _first(chunk: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray, offset: int) -> np.ndarray:
        """First place of [lo, hi) whose three characters at ``offset`` are not below ``key``, else hi."""
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            below = open_ & (chunk[order[np.minimum(mid, len(order) - 1)] + offset] < key)
            lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo

    def _encode_slice(self, words: list) -> None:
        text = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
        length = np.array([len(w) for w in words])
        close = np.cumsum(length + 1) - 1
        begin = close - length
        text[close] = _SEPARATOR
        c = np.concatenate([text, [0, 0]]).astype(np.int64)
        chunk = (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
        order = self._suffixes(chunk)
        lo, hi = self._ranges(chunk, order)
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        start, piece, size = order[at], np.repeat(self.ids, n), np.repeat(self.size, n)
        lost = np.flatnonzero(~np.isin(text, self.single) & (text != _SEPARATOR))
        start = np.concatenate([start, lost])
        piece = np.concatenate([piece, -2 - text[lost].astype(np.int64)])
        end = start + np.concatenate([size, np.ones(len(lost), np.int64)])
        last, back = self._relax(start, end, piece, begin, length)
        if (last[close] == _UNREACHED).any():
            raise ValueError("no row of compatible pieces covers a word")
        ends = np.flatnonzero(self._path(back, begin, close))
        ids, stop = last[ends], np.searchsorted(ends, close, "right")
        lost = np.flatnonzero(ids < -1)
        if len(lost):
            spelled = [[self.byte[b] for b in chr(-2 - c).encode("utf-8", "surrogatepass")] for c in ids[lost].tolist()]
            count = np.ones(len(ids), np.int64)
            count[lost] = [len(x) for x in spelled]
            upto = np.concatenate([[0], np.cumsum(count)])
            ids, stop = np.repeat(ids, count), upto[stop]
            for i, x in zip(upto[lost].tolist(), spelled):
                ids[i:i + len(x)] = x
        coded, stop = ids.astype("<i4").tobytes(), (4 * stop).tolist()
        self.known.update((w, coded[a:b]) for w, a, b in zip(words, [0, *stop], stop))

    def _relax(self, start, end, piece, begin, length) -> tuple:
        """Piece that ends at each position and where it starts.

        Edges are sorted by their position in the word: each of the first positions is
        relaxed in all words at once, the rest of long words edge by edge.
        """
        last, back = np.full(begin[-1] + length[-1] + 2, _UNREACHED), np.zeros(begin[-1] + length[-1] + 2, np.int64)
        last[begin] = -1
        level = np.minimum(start - np.repeat(begin, length + 1)[start], _LEVELS).astype(np.uint8)
        by = np.argsort(level, kind="stable")
        cuts = np.searchsorted(level[by], np.arange(_LEVELS + 1))
        for a, b in zip(cuts, cuts[1:]):
            rows = by[a:b]
            rows = rows[last[start[rows]] != _UNREACHED]
            if len(rows):
                rows = rows[self.fitting(last[start[rows]], piece[rows])]
                last[end[rows]], back[end[rows]] = piece[rows], start[rows]
        rows = by[cuts[-1]:]
        if len(rows):
            rows, last, back, seen = rows[np.argsort(start[rows], kind="stable")], last.tolist(), back.tolist(), {}
            for s, e, p in zip(start[rows].tolist(), end[rows].tolist(), piece[rows].tolist()):
                before = last[s]
                if before == _UNREACHED:
                    continue
                ok = seen.get((before, p))
                if ok is None:
                    ok = seen[before, p] = self.compatible(before, p)
                if ok:
                    last[e], back[e] = p, s
            last, back = np.array(last), np.array(back)
        return last, back

    @staticmethod
    def _path(back: np.ndarray, begin: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Marks the ends of the pieces that cover each word."""
        path = np.zeros(len(back), bool)
        for _ in range(_LEVELS):
            path[close] = True
            close = back[close]
            begin, close = begin[close > begin], close[close > begin]
        if len(close):
            steps, far = back.tolist(), []
            for first, at in zip(begin.tolist(), close.tolist()):
                while at > first:
                    far.append(at)
                    at = steps[at]
            path[far] = True
        return path

    def learn(self, words: set) -> None:
        """Encodes every word not met before, in slices of bounded size.

        Known words are held in two generations of about _CACHE words: a full
        one becomes the older one, and what is met again moves on from there,
        so words that recur stay known and words met once go.
        """
        if len(self.known) > _CACHE:
            self.known, self.older = {}, self.known
        known, older, fresh = self.known, self.older, []
        for w in words:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    fresh.append(w)
        if len(self.judged) > 4 * _CACHE:
            self.judged = {}
        part, size = [], 0
        for w in sorted(fresh):
            part.append(w)
            size += len(w) + 1
            if size > _SLICE:
                self._encode_slice(part)
                part, size = [], 0
        if part:
            self._encode_slice(part)

    def encode(self, texts: list) -> list:
        """Ids of each text as little-endian bytes."""
        words = [self.split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn({w for ws in words for w in ws})
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in words]

    def decode(self, coded: list) -> list:
        """The text of each row of ids (as bytes), without the blank put in front."""
        ids = np.frombuffer(b"".join(coded), "<i4")
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.out)):
            raise ValueError("ids outside the model")
        taken = self.spelled.take(pa.array(ids))
        ends = np.cumsum([0] + [len(c) // 4 for c in coded])
        at = np.frombuffer(taken.buffers()[1], np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        whole = bytes(taken.buffers()[2]) if len(ids) else b""
        texts = [whole[i:j].decode("utf-8", "replace") for i, j in zip(at, at[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]


def load(path: str) -> Model:
    """The worker's copy of one model."""
    if path not in _LOADED:
        _LOADED[path] = Model(path)
    return _LOADED[path]


def _ids(coded: list, missing: list) -> pa.Array:
    """Arrow lists of ids from their bytes; null where the text is missing."""
    ends = np.cumsum([0] + [len(c) // 4 for c in coded], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<i4")), mask=pa.array(missing, pa.bool_()))


def _coded(docs: DataFrame, model: str, check: bool) -> DataFrame:
    """(doc_id, ids) of every row and, with check, whether decoding gives the text back.

    Texts are matched together, and results handed on, up to a bounded size.
    """

    def run(batches):
        m = load(model)
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(size // _DOCS)) + 1).tolist(), len(size)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                texts = part.column("text").to_pylist()
                coded = m.encode([t or "" for t in texts])
                columns = [part.column("doc_id"), _ids(coded, [t is None for t in texts])]
                if check:
                    columns.append(pa.array([None if t is None else d == t.replace(MARK, " ") for d, t in zip(m.decode(coded), texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "same"][:len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", same boolean" if check else ""))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` rows as (doc_id, ids)."""
    return _coded(docs, model, False)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows with ids."""

    def run(ids: pd.Series) -> pd.Series:
        m = load(model)
        texts = m.decode([b"" if i is None else np.asarray(i, "<i4").tobytes() for i in ids])
        return pd.Series([None if i is None else t for i, t in zip(ids, texts)], dtype=object)

    return rows.select("doc_id", F.pandas_udf(run, "string")("ids").alias("text"))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_ids and whether decoding gives the text back."""
    return _coded(docs, model, True).select("doc_id", "ids", F.size("ids").alias("n_ids"), "same")
