"""Bounded pieces of Arrow batches for maps that build Python objects or wide arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Bytes of input that a map turns into objects at a time; what it builds is a small multiple of that.
PIECE_BYTES = 1 << 22


def pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices of at most ``most_bytes`` (a larger row comes alone).

    A batch holds up to 10,000 rows, whatever they weigh, in each of an
    executor's Python workers; with slices a worker's own memory follows
    ``most_bytes`` and not the number of rows in a task.
    """
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            if part.num_rows > 1 and part.nbytes > most_bytes:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
            else:
                yield part
