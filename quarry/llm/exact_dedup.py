"""Exact duplicates through a cuckoo-filter index of live digests.

A text's digest is its SHA-256.  :class:`CuckooIndex` holds the live digests of
one shard: buckets of four slots, each slot a 16-bit print and the number of a
stored record (full digest, document that stays, copies seen).  A print that
matches is only a hint; the lookup verifies it against the record's whole
digest.  Digests are inserted and deleted in place; when an insertion finds no
slot after ``KICKS`` moves the table doubles and is filled again from the stored
digests, so nothing is ever dropped and no bucket has a cap.

On Spark every task folds its own rows into an index first (flushed at
``FLUSH`` records, so memory stays bounded) and hands on one row per digest;
those meet in shards by digest, where a second index gives the document that
stays.  A text held by a third of all rows is thus one row per task before any
shuffle.  Joining the groups back is a plain left join on the digest with
unique keys on one side; Spark's skew join splits a hot digest.

Cases: null text counts as empty, and empty texts equal each other; texts are
compared whole and unchanged; of equal texts the largest doc_id stays, repeated
rows of that doc_id all stay (they are the same document); a row without doc_id
loses to any with one, and where no row has one ``keep_id`` is null and all
stay; further columns, whatever their names, take no part; an empty table gives
an empty result.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import blocks_for, settled

FLUSH = 200_000      # records of a task's first index
PER_SHARD = 250_000  # rows that meet in a shard, on average
_ENTRY = "digest binary, keep_id long, n long"
_INDEXED, _DELETED, _INSERTED = 0, 1, 2


class CuckooIndex:
    """Live digests with the document that stays and the number of copies."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 1024):
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.digests: list[bytes | None] = []
        self.keep: list[int | None] = []
        self.n = array("q")
        self._free: list[int] = []
        self.resizes = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._prints = array("H", bytes(2 * self.SLOTS * buckets))
        self._record = array("L", bytes(array("L").itemsize * self.SLOTS * buckets))

    def __len__(self) -> int:
        return len(self.digests) - len(self._free)

    def _place(self, digest: bytes) -> tuple[int, int]:
        word = int.from_bytes(digest[:8], "little")
        return (word >> 48) or 1, word & self._mask

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self._mask)

    def _slot(self, digest: bytes) -> int:
        """Slot that holds the digest, -1 if none does; a print alone does not count."""
        mark, bucket = self._place(digest)
        prints, record = self._prints, self._record
        for b in (bucket, self._other(bucket, mark)):
            for s in range(b * self.SLOTS, (b + 1) * self.SLOTS):
                if prints[s] == mark and self.digests[record[s]] == digest:
                    return s
        return -1

    def find(self, digest: bytes) -> int:
        """Record number of a live digest, -1 if it is not live."""
        s = self._slot(digest)
        return self._record[s] if s >= 0 else -1

    def insert(self, digest: bytes, keep_id: int | None, n: int = 1) -> None:
        """Add a digest that is not live."""
        if self._free:
            r = self._free.pop()
            self.digests[r], self.keep[r], self.n[r] = digest, keep_id, n
        else:
            r = len(self.digests)
            self.digests.append(digest)
            self.keep.append(keep_id)
            self.n.append(n)
        if not self._settle(r):
            self._resize()

    def _settle(self, r: int) -> bool:
        mark, bucket = self._place(self.digests[r])
        prints, record, k = self._prints, self._record, self.SLOTS
        for b in (bucket, self._other(bucket, mark)):
            for s in range(b * k, (b + 1) * k):
                if not prints[s]:
                    prints[s], record[s] = mark, r
                    return True
        b = self._other(bucket, mark)
        for turn in range(self.KICKS):  # the newcomer takes a slot, its holder moves on
            s = b * k + (turn + mark) % k
            prints[s], mark = mark, prints[s]
            record[s], r = r, record[s]
            b = self._other(b, mark)
            for s in range(b * k, (b + 1) * k):
                if not prints[s]:
                    prints[s], record[s] = mark, r
                    return True
        return False  # the record without a slot is still stored; resizing finds it there

    def _resize(self) -> None:
        buckets = self._mask + 1
        gone = set(self._free)
        while True:
            buckets *= 2
            self.resizes += 1
            self._empty(buckets)
            if all(self._settle(r) for r in range(len(self.digests)) if r not in gone):
                return

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out; whether it was live."""
        s = self._slot(digest)
        if s < 0:
            return False
        r = self._record[s]
        self._prints[s] = 0
        self.digests[r] = self.keep[r] = None
        self._free.append(r)
        return True

    def add(self, digest: bytes, keep_id: int | None, n: int) -> None:
        """Count copies; a larger doc_id takes the place of the live entry."""
        r = self.find(digest)
        if r < 0:
            self.insert(digest, keep_id, n)
        elif keep_id is not None and (self.keep[r] is None or keep_id > self.keep[r]):
            n += self.n[r]
            self.delete(digest)
            self.insert(digest, keep_id, n)
        else:
            self.n[r] += n

    def batches(self, size: int = 1 << 16):
        """Live entries as Arrow batches."""
        gone = set(self._free)
        live = [r for r in range(len(self.digests)) if r not in gone]
        for lo in range(0, len(live), size):
            part = live[lo:lo + size]
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.digests[r] for r in part], pa.binary()), pa.array([self.keep[r] for r in part], pa.int64()),
                 pa.array([self.n[r] for r in part], pa.int64())], ["digest", "keep_id", "n"])


def _fold(flush: int | None):
    """Arrow map that folds (digest, keep_id, n, op) rows into an index and gives its entries."""
    def run(batches):
        index = CuckooIndex()
        for batch in batches:
            for digest, keep_id, n, op in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if op == _DELETED:
                    index.delete(digest)
                else:
                    index.add(digest, keep_id, n)
            if flush and len(index) > flush:
                yield from index.batches()
                index = CuckooIndex()
        yield from index.batches()
    return run


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row, null text as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def _entries(rows: DataFrame, op: int) -> DataFrame:
    """One entry per digest and task, folded before any shuffle."""
    ready = rows.select("digest", F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("n"),
                        F.lit(_INSERTED).alias("op"))
    return ready.mapInArrow(_fold(FLUSH), _ENTRY).withColumn("op", F.lit(op))


def _sharded(entries: DataFrame, rows: int) -> DataFrame:
    shards = max(blocks_for(rows, PER_SHARD), int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return entries.repartition(shards, "digest").sortWithinPartitions("op").mapInArrow(_fold(None), _ENTRY)


def live_index(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n): one row per distinct text of ``digests``' rows."""
    return _sharded(_entries(rows, _INSERTED), rows.count())


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """Index after withdrawing the texts of ``deleted`` (all their copies) and adding those of ``inserted``.

    Both are tables with doc_id and text.  A text in both is withdrawn first
    and added anew; deleting a text that is not live changes nothing.
    """
    old = index.select("digest", "keep_id", "n", F.lit(_INDEXED).alias("op"))
    new = settled(_entries(digests(inserted), _INSERTED).union(_entries(digests(deleted), _DELETED)).union(old))
    return _sharded(new, new.count())


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    rows = settled(digests(docs))
    groups = live_index(rows).filter("n > 1 or keep_id is null").withColumnRenamed("digest", "shared")
    both = rows.join(settled(groups), F.col("digest") == F.col("shared"), "left")
    keep = F.when(F.col("shared").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return both.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                       F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
