"""Arrow batches in bounded pieces."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute

CHARACTERS = 4_000_000


def pieces(
    batches: Iterable[pa.RecordBatch], characters: int = CHARACTERS
) -> Iterator[tuple[list, ...]]:
    """The columns of rows whose last column, a text, adds up to about `characters`.

    Lists of Python values, so that what is held at once does not grow with the batch;
    a single longer text is a piece of its own.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(-1)), 0).to_pylist()
        start = held = 0
        for end, size in enumerate(sizes, 1):
            held += size
            if held >= characters or end == len(sizes):
                part = batch.slice(start, end - start)
                yield tuple(c.to_pylist() for c in part.columns)
                start, held = end, 0
