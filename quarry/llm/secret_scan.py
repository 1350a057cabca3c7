"""Secrets found by exact patterns and a linear-chain conditional random field.

Tokens are runs of characters that keys and passwords are written in.  The
field tags each B (a secret begins), I (goes on) or O from hashed features: the
token's shape, the words and signs beside it, and the file (document) it is in.
A plain word (under 6 characters, or under 20 and no digit) can only be O unless
an assignment sign or a cue word stands before it, so the chain falls into runs of
other tokens that follow one another closely, and Viterbi decodes each run
exactly; texts and tokens are read whole.

Weights are fitted by maximum likelihood (forward-backward, AdaGrad) on at most
``fit_runs`` runs taken in order of a hash of the text, tagged by the exact
patterns.  For training, runs are split every ``_PIECE`` tokens (before a token
that does not go on a secret), so the sample is bounded in tokens too.  Half of
it are pieces with a match, out of all documents; only the pieces without a match
come from a share of the documents that falls with their number.  Spans of the exact patterns always stay; the
field adds spans that none of them overlaps.

Cases: null text counts as empty; repeated rows get equal spans; without any
match to learn from nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The exact kinds in order and their patterns.
KINDS = ("assign", "access", "hex")
ADDED = "crf"
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
_CUED = re.compile(r"""(?:[:=]|\b(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|pin|credentials?)(?:\x20is)?(?=[\x20"']))["']?\x20*["']?([A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_-])""")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_CLASSES = re.compile("([a-z]+)|([A-Z]+)|([0-9]+)|.")
BUCKETS, TAGS = 1 << 13, "OBI"
_PIECE = 64  # tokens of a training piece, twice that at most
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def base_spans(text: str) -> list:
    """(kind, start, end) of the exact patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _runs(text: str) -> list:
    """Runs of neighbouring tokens that are not plain words: lists of (start, end)."""
    cued, runs = iter([m.span(1) for m in _CUED.finditer(text)]), []
    other = next(cued, None)

    def add(span):
        if runs and span[0] - runs[-1][-1][1] <= 2:
            runs[-1].append(span)
        else:
            runs.append([span])

    for m in _RUN.finditer(text):
        if m.end() - m.start() < 20 and not _DIGIT.search(m.group()):
            continue
        while other and other[0] < m.end():
            if other[1] <= m.start():
                add(other)
            other = next(cued, None)
        add(m.span())
    while other:
        add(other)
        other = next(cued, None)
    return runs


def _features(text: str, start: int, end: int, file: tuple) -> list:
    token = text[start:end]
    n = end - start
    kinds = Counter(m.lastindex or 0 for m in _CLASSES.finditer(token))
    spread = -sum(c / len(token) * math.log2(c / len(token)) for c in Counter(token).values())
    before, after = text[max(0, start - 32):start], text[end:end + 16]
    words = _WORD.findall(before.lower())
    shape = _CLASSES.sub(lambda m: "a" if m.group(1) else "A" if m.group(2) else "9" if m.group(3) else m.group(), token)[:8]
    named = ["bias", f"len{min(n, 64) // 4}", f"bits{int(spread * 2)}", f"shape{shape}", f"low{min(kinds[1], 6)}", f"up{min(kinds[2], 6)}",
             f"dig{min(kinds[3], 6)}", f"sign{min(kinds[0], 4)}", f"dots{min(token.count('.'), 4)}", f"head{token[:3]}",
             f"w1{words[-1] if words else ''}", f"w2{words[-2] if len(words) > 1 else ''}", f"pre{before[-1:]}", f"pre2{before[-2:]}",
             f"post{after[:1]}", f"hex{not token.strip('0123456789abcdef')}", f"num{token.isdigit()}", *file]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in named]


def _file(text: str, runs: list) -> tuple:
    low = text.lower()
    return (f"fkey{any(k in low for k in _KEYWORDS)}", f"fmany{min(8, sum(map(len, runs)))}", f"flen{len(text).bit_length()}")


def _tagged(text: str) -> list:
    """(features, tags) of each run of a text, tagged by the exact patterns."""
    runs, base = _runs(text), base_spans(text)
    file, out, at = _file(text, runs), [], 0
    for run in runs:
        feats, tags, last = [], [], None
        for s, e in run:
            while at < len(base) and base[at][2] <= s:
                at += 1
            hit = base[at] if at < len(base) and base[at][1] < e else None
            tags.append(0 if hit is None else 2 if hit == last else 1)
            last = hit
            feats.append(_features(text, s, e, file))
        out.append((feats, tags))
    return out


def _scores(w: np.ndarray, feats: list) -> np.ndarray:
    return w[np.array(feats)].sum(1)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


START = np.array([0.0, 0.0, -1e4])  # a run does not open with I


def fit(data: list, epochs: int = 4, rate: float = 0.2, l2: float = 1e-5) -> dict:
    """Weights by stochastic maximum likelihood over (features, tags) runs, in the order given."""
    w, t = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    t[0, 2] = -1e4  # I follows B or I only
    gw, gt = np.full((BUCKETS, 3), 1e-2), np.full((3, 3), 1e-2)
    for _ in range(epochs):
        for feats, tags in data:
            e = _scores(w, feats)
            n = len(e)
            a, b = np.zeros((n, 3)), np.zeros((n, 3))
            a[0] = START + e[0]
            for i in range(1, n):
                a[i] = _lse(a[i - 1][:, None] + t, 0) + e[i]
            for i in range(n - 2, -1, -1):
                b[i] = _lse(t + (e[i + 1] + b[i + 1])[None], 1)
            z = _lse(a[-1], 0)
            node = np.exp(a + b - z)
            node[np.arange(n), tags] -= 1
            index = np.array(feats)
            grad = np.repeat(node, index.shape[1], 0)
            flat = index.ravel()
            g = grad + l2 * w[flat]
            np.add.at(gw, flat, g * g)
            np.add.at(w, flat, -rate * g / np.sqrt(gw[flat]))
            for i in range(1, n):
                edge = np.exp(a[i - 1][:, None] + t + (e[i] + b[i])[None] - z)
                edge[tags[i - 1], tags[i]] -= 1
                gt += edge * edge
                t -= rate * edge / np.sqrt(gt)
                t[0, 2] = -1e4
    return {"w": w.astype(np.float32), "t": t}


def viterbi(model: dict, feats: list) -> list:
    """Most probable tags of one run."""
    e = _scores(model["w"], feats)
    best, back = START + e[0], []
    for i in range(1, len(e)):
        step = best[:, None] + model["t"]
        back.append(step.argmax(0))
        best = step.max(0) + e[i]
    tags = [int(best.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def spans_of(text: str | None, model: dict | None) -> list:
    """All spans of one whole text: exact ones and those the field adds."""
    text = text or ""
    base = base_spans(text)
    if model is None:
        return base
    runs, added, at = _runs(text), [], 0
    file = _file(text, runs)
    ordered = sorted(base, key=lambda s: s[1])
    for run in runs:
        tags = viterbi(model, [_features(text, s, e, file) for s, e in run])
        open_ = None
        for (s, e), tag in zip(run, tags):
            if tag == 2 and open_:
                open_[1] = e
            elif tag:
                open_ = [s, e]
                added.append(open_)
            else:
                open_ = None
    out = []
    for s, e in added:
        while at < len(ordered) and ordered[at][2] <= s:
            at += 1
        if not any(b[1] < e and b[2] > s for b in ordered[at:at + 4]):
            out.append((ADDED, s, e))
    order = (*KINDS, ADDED)
    return sorted(base + out, key=lambda s: (s[1], order.index(s[0])))


def _pieces(text: str, plain: bool):
    """(features, tags) of the training pieces of a text; those without a match only if ``plain``."""
    if not plain and not base_spans(text):
        return
    for feats, tags in _tagged(text):
        at = 0
        while at < len(tags):
            end = min(at + _PIECE, len(tags))
            while end < min(at + 2 * _PIECE, len(tags)) and tags[end] == 2:
                end += 1
            mine = tags[at:end]
            if mine[0] == 2:  # a secret longer than a piece: a run does not open with I
                mine = [1, *mine[1:]]
            if plain or any(mine):
                yield feats[at:end], mine
            at = end


def train(docs: DataFrame, fit_runs: int = 6000) -> dict | None:
    """The field's weights, from pieces of the texts with the smallest hashes."""

    def run(batches):
        for pdf in batches:
            for h, plain, t in zip(pdf["h"], pdf["plain"], pdf["text"]):
                rows = []
                for i, (feats, tags) in enumerate(_pieces(t, plain)):
                    rows.append((h, i, [x for f in feats for x in f], len(feats), tags, any(tags)))
                    if len(rows) >= 256:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    def frame(rows):
        return pd.DataFrame(rows, columns=["h", "i", "feats", "size", "tags", "hit"])

    texts = docs.filter("text is not null").select(F.xxhash64("text").alias("h"), "text")
    plain = F.pmod(F.col("h"), F.lit(1 << 20)) < (1 << 20) * min(1.0, 8.0 * fit_runs / max(1, docs.count()))
    schema = "h long, i int, feats array<int>, size int, tags array<int>, hit boolean"
    rows = texts.withColumn("plain", plain).mapInPandas(run, schema).dropDuplicates(["h", "i", "hit"]).persist()
    half = fit_runs // 2
    data = [r for hit in (True, False) for r in rows.filter(F.col("hit") == hit).orderBy("h", "i").limit(half).collect()]
    rows.unpersist()
    if not any(r.hit for r in data):
        return None
    data.sort(key=lambda r: (r.h, r.i))
    return fit([(np.array(r.feats).reshape(r.size, -1).tolist(), r.tags) for r in data])


def find_secrets(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, found): every document row's spans (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, shared.value)] for t in texts], dtype=object)

    return docs.select("doc_id", F.pandas_udf(run, SPANS)("text").alias("found"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document row."""
    base = F.filter("found", lambda s: s["kind"] != ADDED)
    return find_secrets(docs, train(docs)).select("doc_id", *[_count(k) for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"),
                                                  _joined(F.col("found")).alias("spans"))
