"""Toxicity scores on text restored by noisy-channel decoding.

1. A character 4-gram model is counted over the words of *all* documents (a
   fixed alphabet, so the table has at most 28^4 entries however large the
   corpus is).
2. A token with a look-alike sign, a repeated letter, or letters spaced out
   one by one is a lattice of what may have been written; Viterbi picks the
   most probable reading under the character model.  A plain token has one
   reading, itself, so only the others are decoded (once per distinct token
   and worker).
3. Words of the restored text, doubled letters squeezed, feed a logistic
   regression.  Document frequencies of every word over all labelled rows
   choose the words (every one whose G2 is at least ``least_g2``); the weights are fitted on at most
   ``fit_rows`` labelled rows, taken in order of a hash.  A chosen word that none of these rows
   holds takes its smoothed log odds over all labelled rows.

Cases: null and empty texts score as the intercept alone; labels null or of
unlisted documents are ignored; without both classes every score is the
smoothed share of toxic labels; repeated rows score alike; an empty table
gives an empty result.  Long texts are read whole.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc32_mod

SYMBOLS, ORDER = 28, 4
# Signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
_SIGN_COST, _KEEP_COST, _JOIN_COST, _SPLIT_COST = -1.5, -4.0, -0.5, -2.0
_SPACED = re.compile(r"(?<!\w)\w(?:([ ._*-])\w)(?:\1\w){2,}(?!\w)")
_RUN = re.compile(r"(.)\1*", re.S)
_LETTERS = re.compile(r"[^\W\d_]+")
_SIGN = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_DOUBLE = re.compile(r"(.)\1+")
_SLICE = 1 << 20
_CACHE = 300_000
_HELD = 64  # characters from which a token's reading is not kept
_FLUSH = 4096
SMALL_LABELS = 1_000_000  # label rows (16 bytes each) up to which they are broadcast


def _symbol(ch: str) -> int:
    base = unicodedata.normalize("NFD", ch)[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27 if ch.isalpha() else 0


_TABLE = np.array([_symbol(chr(i)) for i in range(0x250)] + [0], np.int32)


def _symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _TABLE[np.minimum(codes, 0x250)]


def _gram_counts(texts: list, into: np.ndarray) -> None:
    """Adds the 4-gram counts of all texts, joined and read in slices of bounded size."""
    part, size = [], 0
    for t in texts:
        for at in range(0, len(t), _SLICE):
            part.append(t[at:at + _SLICE])
            size += len(part[-1])
            if size >= _SLICE:
                into += _slice_counts("\n".join(part))
                part, size = [], 0
    if part:
        into += _slice_counts("\n".join(part))


def _slice_counts(text: str) -> np.ndarray:
    s = np.concatenate([np.zeros(ORDER, np.int32), _symbols(text.lower()), np.zeros(1, np.int32)])
    keep = s != 0
    keep[1:] |= s[:-1] != 0  # one boundary between words
    s = s[keep]
    if not len(s):
        return np.zeros(SYMBOLS ** ORDER, np.int64)
    s = np.concatenate([np.zeros(ORDER - 1, np.int32), s])
    g = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
    return np.bincount(g, minlength=SYMBOLS ** ORDER)


def character_model(docs: DataFrame) -> np.ndarray:
    """log p(char | 3 before) as a 28^4 array, counted over all documents."""

    def count(batches):
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for pdf in batches:
            _gram_counts([t for t in pdf["text"] if t], total)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"gram": hit, "n": total[hit]})

    rows = docs.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    c = np.zeros(SYMBOLS ** ORDER)
    c[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    c = c.reshape((SYMBOLS,) * ORDER)
    p = (c.sum((0, 1, 2)) + 1.0) / (c.sum() + SYMBOLS)
    for axes in ((0, 1), (0,), ()):  # interpolate: each order leans on the one below
        n = c.sum(axes) if axes else c
        p = (n + 4.0 * p) / (n.sum(-1, keepdims=True) + 4.0)
    return np.log(p).astype(np.float32)


def _lattice(token: str, joined: bool) -> list:
    """Per run of equal characters, the (reading, channel cost) pairs."""
    return list(_steps(token, joined))


def _steps(token: str, joined: bool):
    for m in _RUN.finditer(token):
        ch, n = m.group(1), m.end() - m.start()
        if joined and ch in " ._*-":
            yield [("", _JOIN_COST), (" ", _SPLIT_COST)]
        elif ch.isalpha():
            yield [(ch, 0.0)] if n == 1 else [(ch * 2, 0.0), (ch, -2.0)] if n == 2 else [(ch, -0.5), (ch * 2, -1.0)]
        else:
            ways = [(m.group(0), _KEEP_COST)]
            for letter in LOOKALIKES.get(ch, ""):
                ways.append((letter, _SIGN_COST - 0.5 * (n > 1)))
                if n > 1:
                    ways.append((letter * 2, _SIGN_COST - 1.0))
            yield ways


def decode(token: str, model: np.ndarray, joined: bool = False) -> str:
    """Most probable reading of a token (ties: first in lattice order).

    The state of the search is the last three characters read, so the cost is linear
    in the token; what all states agree on leaves the search every ``_FLUSH`` steps.
    """
    best, parts = {(0, 0, 0): (0.0, None)}, []
    for i, ways in enumerate(_steps(token, joined), 1):
        after: dict = {}
        for state, (score, path) in best.items():
            for out, cost in ways:
                s, total = state, score + cost
                for x in map(_symbol_of, out):
                    if x or s[2]:
                        total += model[s[0], s[1], s[2], x]
                        s = (s[1], s[2], x)
                if s not in after or total > after[s][0]:
                    after[s] = (total, (path, out))
        best = after
        if not i % _FLUSH:
            read = [_read(path) for _, path in best.values()]
            same = next((j for j, outs in enumerate(zip(*read)) if len(set(outs)) > 1), len(read[0]))
            parts += read[0][:same]
            for (state, (score, _)), outs in zip(list(best.items()), read):
                path = None
                for out in outs[same:]:
                    path = (path, out)
                best[state] = (score, path)
    score, path = max(((v[0] + model[s[0], s[1], s[2], 0], v[1]) for s, v in best.items()), key=lambda x: x[0])
    return "".join(parts + _read(path))


def _read(path: tuple | None) -> list:
    parts = []
    while path:
        path, out = path
        parts.append(out)
    return parts[::-1]


def _symbol_of(ch: str) -> int:
    i = ord(ch)
    return int(_TABLE[i]) if i < 0x250 else 0


def _odd(token: str) -> bool:
    """Has more than one reading: a sign beside letters, or a letter three times running."""
    return any(c.isalpha() for c in token) and (
        any(c in LOOKALIKES for c in token) or any(len(m.group(0)) > 2 for m in _RUN.finditer(token)))


class Restorer(dict):
    """token -> its restored reading; holds at most a fixed number of tokens, long ones never."""

    def __init__(self, model: np.ndarray):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> str:
        if len(self) >= _CACHE:
            self.clear()
        core = token.strip(".,;:?\"'()[]")
        tail = core.rstrip("!")
        out = decode(tail, self.model) if _odd(tail) else decode(core, self.model) if _odd(core) else token
        if len(token) < _HELD:
            self[token] = out
        return out

    def text(self, text: str) -> str:
        """The whole text, lower-cased and restored."""
        low = _SPACED.sub(lambda m: decode(m.group(0), self.model, True), text.lower())
        return " ".join(self[t] for t in low.split())

    def words(self, text: str | None) -> set:
        """Distinct words of the restored text, doubled letters squeezed."""
        if not text:
            return set()
        low = text.lower()
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
        single = codes[np.concatenate([[True], codes[1:] != codes[:-1]])].tobytes().decode("utf-32-le", "surrogatepass")
        words = set(_LETTERS.findall(single))
        # a repeated letter reads as itself once squeezed; only signs and spacing can change a word
        odd = [self[t] for t in set(low.split()) if _SIGN.search(t)]
        odd += [decode(m.group(0), self.model, True) for m in _SPACED.finditer(low)]
        for t in odd:
            words.update(_DOUBLE.sub(r"\1", w) for w in _LETTERS.findall(t))
        return words


def _fit(rows: np.ndarray, cols: np.ndarray, width: int, y: np.ndarray, times: np.ndarray, l2: float = 0.02, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps on 0/1 features, given as the (row, column) places of
    the ones; the last weight is the intercept.  Steps are solved by conjugate gradients, so the
    cost follows the ones and not the square of ``width``."""
    n = len(y)
    rows = np.concatenate([rows, np.arange(n)])
    cols = np.concatenate([cols, np.full(n, width)])
    ridge = np.full(width + 1, l2)
    ridge[-1] = 1e-6

    def ahead(v):
        return np.bincount(rows, v[cols], n)

    def back(v):
        return np.bincount(cols, v[rows], width + 1)

    def loss(w):
        z = ahead(w)
        return float(times @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ (w * w))

    w = np.zeros(width + 1)
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(ahead(w), -30, 30)))
        grad = back((p - y) * times) + ridge * w
        curve = times * (p * (1 - p) + 1e-9)
        scale = back(curve) + ridge
        step, r = np.zeros_like(w), grad.copy()
        q = r / scale
        d, rq = q, r @ q
        for _ in range(500):
            if rq <= 1e-20 * (1 + grad @ grad):
                break
            h = back(curve * ahead(d)) + ridge * d
            a = rq / (d @ h)
            step += a * d
            r -= a * h
            q = r / scale
            rq, last = r @ q, rq
            d = q + rq / last * d
        after = loss(w - step)
        while after > now + 1e-9 * abs(now) and np.abs(step).max() > 1e-9:
            step /= 2
            after = loss(w - step)
        w, now = w - step, after
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 10_000, least_g2: float = 12.0) -> dict:
    """Model from all documents (characters) and the given labels (words).

    ``labels`` has doc_id and toxic; a document with contrary labels counts as toxic.
    """
    spark = docs.sparkSession
    model = character_model(docs)
    shared = spark.sparkContext.broadcast(model)
    known = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))

    listed, n1, n0 = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)),
                               F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    out = {"model": shared, "words": {}, "bias": float(np.log((n1 + 0.5) / (n0 + 0.5)))}
    if not n1 or not n0:
        return out

    def words(batches):
        restore = Restorer(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "words": [list(restore.words(t)) for t in pdf["text"]]})

    def restored(some: DataFrame, count: int) -> DataFrame:
        some = F.broadcast(some) if count <= SMALL_LABELS else some
        return docs.select("doc_id", "text").join(some, "doc_id").select("toxic", "text") \
                   .mapInPandas(words, "toxic int, words array<string>")

    rows = restored(known, listed)
    df = (rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
              .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")))

    def part(have, all_):
        return have * F.log((have + 1e-9) / (F.lit(float(all_)) * (F.col("a") + F.col("b")) / float(n1 + n0)))

    miss_a, miss_b = float(n1) - F.col("a"), float(n0) - F.col("b")
    none = float(n1 + n0) - F.col("a") - F.col("b")
    g2 = (part(F.col("a"), n1) + part(F.col("b"), n0)
          + miss_a * F.log((miss_a + 1e-9) / (float(n1) * (none + 1e-9) / float(n1 + n0)))
          + miss_b * F.log((miss_b + 1e-9) / (float(n0) * (none + 1e-9) / float(n1 + n0))))
    best = df.withColumn("g2", g2).filter(F.col("g2") >= least_g2).orderBy(F.desc("g2"), "word").select("word", "a", "b").collect()
    if not best:
        return out
    index = {r.word: i for i, r in enumerate(best)}
    chosen = spark.sparkContext.broadcast(index)

    def places(words: pd.Series) -> pd.Series:
        return pd.Series([sorted(chosen.value[w] for w in ws if w in chosen.value) for ws in words], dtype=object)

    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = (restored(picked, min(fit_rows, listed))
              .select("toxic", F.pandas_udf(places, "array<int>")("words").alias("places"))
              .groupBy("toxic", "places").agg(F.count(F.lit(1)).alias("n")).orderBy("toxic", "places").collect())
    rows = np.repeat(np.arange(len(sample)), [len(r.places) for r in sample])
    cols = np.array([i for r in sample for i in r.places], np.int64)
    w = _fit(rows, cols, len(best), np.array([r.toxic for r in sample], np.float64), np.array([r.n for r in sample], np.float64))
    for i in np.setdiff1d(np.arange(len(best)), cols):
        w[i] = np.log((best[i].a + 0.5) / (n1 + 1.0)) - np.log((best[i].b + 0.5) / (n0 + 1.0))
    out["words"], out["bias"] = {t: float(w[i]) for t, i in index.items()}, float(w[-1])
    return out


def score(docs: DataFrame, trained: dict) -> DataFrame:
    """(doc_id, score) of every document row."""
    shared, weights, bias = trained["model"], trained["words"], trained["bias"]

    def run(texts: pd.Series) -> pd.Series:
        restore = _RESTORERS.setdefault(id(shared.value), Restorer(shared.value))
        z = [bias + sum(weights[w] for w in sorted(restore.words(t) & weights.keys())) for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -30, 30))))

    return docs.select("doc_id", F.pandas_udf(run, "double")("text").alias("score"))


_RESTORERS: dict = {}


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document row.

    Labels of documents whose crc32(doc_id) mod ``folds`` is 0 are never learned from.
    """
    kept = labels.filter(crc32_mod(F.col("doc_id"), folds) != 0)
    out = score(docs, train(docs, kept))
    return out.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score is below one half; all their columns stay."""
    bad = toxicity(docs, labels).filter("predicted = 1").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti")
