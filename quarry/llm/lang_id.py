"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts the character trigrams (letters and word ends) of every
labelled text, per language.  A language *contains* a trigram when its share
there is at least ``keep`` of the trigram's largest share in any language.
One Bloom filter holds all languages: each of its ``slots`` is a bit mask of
languages, a trigram sets its languages' bits in ``hashes`` slots, and the AND
of those slots returns all languages containing a trigram at once.

Prediction reads whole texts: per language it counts the trigrams whose mask
has its bit, takes off the hits that the filter's fill makes likely by chance,
and the largest corrected share decides (ties: first in order of names).

Cases: null texts and texts without a letter give ``und`` with score 0;
without any labelled text every other document gives ``und`` too; repeated
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc32_mod

_OTHER = re.compile(r"[\W\d_]+")
_SLICE = 1 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))
WORD_BITS = 63  # languages per mask


def trigrams(text: str) -> np.ndarray:
    """Packed trigrams (21 bits a character) of the lower-cased letters, one blank between words."""
    s = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


def _parts(text: str):
    for at in range(0, len(text), _SLICE):
        yield trigrams(text[at:at + _SLICE])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows that have a lang."""

    def run(batches):
        for pdf in batches:
            for lang, texts in pdf.groupby("lang", sort=False)["text"]:
                held, size = [], 0
                for t in texts:
                    for g in _parts(t) if t else ():
                        held.append(g)
                        size += len(g)
                        if size > 4 * _SLICE:
                            yield frame(lang, held)
                            held, size = [], 0
                if held:
                    yield frame(lang, held)

    def frame(lang, held):
        gram, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"lang": lang, "gram": gram, "n": n})

    rows = docs.filter(F.col("lang").isNotNull()).select("lang", "text")
    return rows.mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _slots(grams: np.ndarray, slots: int, hashes: int) -> list:
    g = grams.view(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for i in range(hashes):
            x = g * _MIX[i]
            x ^= x >> np.uint64(32)
            out.append(((x * _MIX[(i + 1) % 4]) >> np.uint64(20)) % np.uint64(slots))
    return out


def train(docs: DataFrame, slots: int = 1 << 20, hashes: int = 3, keep: float = 0.25) -> dict:
    """The filter (slots x mask words), its languages and each one's chance of a false hit."""
    counts = gram_counts(docs).persist()
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    words = max(1, -(-len(langs) // WORD_BITS))
    table = np.zeros((slots, words), np.int64)
    if langs:
        pairs = [x for l in langs for x in (F.lit(l), F.lit(float(totals[l])))]
        number = [x for i, l in enumerate(langs) for x in (F.lit(l), F.lit(i))]
        share = counts.withColumn("share", F.col("n") / F.element_at(F.create_map(*pairs), F.col("lang")))
        best = share.groupBy("gram").agg(F.max("share").alias("best"))
        held = (share.join(best, "gram").filter(F.col("share") >= keep * F.col("best"))
                     .select("gram", F.element_at(F.create_map(*number), F.col("lang")).alias("i")))

        def bits(batches):
            for pdf in batches:
                i = pdf["i"].to_numpy(np.int64)
                for s in _slots(pdf["gram"].to_numpy(np.int64), slots, hashes):
                    yield pd.DataFrame({"slot": s.astype(np.int64), "word": i // WORD_BITS, "bit": np.left_shift(1, i % WORD_BITS)})

        rows = held.mapInPandas(bits, "slot long, word long, bit long").groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas()
        table[rows["slot"].to_numpy(np.int64), rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    counts.unpersist()
    fill = [float(((table[:, i // WORD_BITS] >> (i % WORD_BITS)) & 1).mean()) for i in range(len(langs))]
    return {"table": table, "langs": langs, "chance": [f ** hashes for f in fill], "hashes": hashes}


def decide(text: str | None, model: dict) -> tuple[str, float]:
    """(language, score) of one whole text."""
    langs, table = model["langs"], model["table"]
    hits, n = np.zeros(len(langs)), 0
    for g in _parts(text) if text and langs else ():
        slot = _slots(g, len(table), model["hashes"])
        n += len(g)
        for w in range(table.shape[1]):
            column = table[:, w]
            mask = column[slot[0]]
            for s in slot[1:]:
                mask = mask & column[s]
            for i in range(w * WORD_BITS, min(len(langs), (w + 1) * WORD_BITS)):
                hits[i] += np.count_nonzero(mask & (1 << i % WORD_BITS))
    chance = np.array(model["chance"])
    true = np.clip((hits - n * chance) / np.maximum(1 - chance, 1e-9), 0, None)
    if not n or not any(c.isalpha() for c in text) or not true.sum():
        return "und", 0.0
    i = int(true.argmax())
    rest = np.delete(true, i).max(initial=0.0)
    return langs[i], float(true[i] / (true[i] + rest))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score) of every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots x 8 bytes a mask word, whatever the corpus

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decide(t, shared.value) for t in texts], columns=["lang_pred", "score"])

    found = F.pandas_udf(run, "lang_pred string, score double")("text")
    return docs.select("doc_id", found.alias("p")).select("doc_id", "p.lang_pred", "p.score")


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows with crc32(doc_id) mod ``folds`` other than ``held``."""
    model = train(docs.filter(crc32_mod(F.col("doc_id"), folds) != held))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
