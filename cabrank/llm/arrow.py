"""Shared helpers: columns computed from Arrow batches, byte-bounded slices, written stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.session import fresh_dir

# Text that one call of a batch function sees; a single longer text is a slice of its own.
SLICE_BYTES = 2 * 1024 * 1024

# A-Z to a-z, all other bytes as they are (UTF-8 has no ASCII byte inside other characters).
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]: A-Z lowered first, every byte outside them a blank.
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def col(name: str):
    """A column by its exact name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of ``df`` that do not clash with ``names``, which replace them."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def put(df: DataFrame, **columns) -> DataFrame:
    """``df`` with columns added at the end; an input column of the same name is replaced."""
    kept = [col(name) for name in without(df, list(columns))]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that no later loss recomputes it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null as empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts add up to ``limit`` bytes, or one row beyond it."""
    lengths = batch.column(column).cast(pa.binary())
    lengths = [0 if x is None else x for x in pa.compute.binary_length(lengths).to_pylist()]
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def append(
    df: DataFrame,
    inputs: Sequence[str],
    compute: Callable[..., list[pa.Array]],
    added: T.StructType,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with the columns that ``compute`` makes of the ``inputs``, the first a text.

    ``compute`` gets one Arrow array for each input, for rows of bounded text, and returns one
    array for each field of ``added``. Only ``keep`` (default: all) of the other columns pass
    through; input columns named like an added one are replaced.
    """
    kept = [c for c in without(df, added.fieldNames()) if keep is None or c in keep]
    sent = kept + [c for c in inputs if c not in kept]
    schema = T.StructType([df.schema[c] for c in kept] + list(added.fields))
    at = [sent.index(c) for c in inputs]
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"c{i}" for i in range(n_kept + len(added.fields))]
        for batch in batches:
            for part in slices(batch, at[0]):
                made = compute(*[part.column(i) for i in at])
                yield pa.RecordBatch.from_arrays(part.columns[:n_kept] + made, names=names)
            pa.default_memory_pool().release_unused()  # a reused worker would keep it

    narrow = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(sent)])
    plain = T.StructType(
        [T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(schema.fields)]
    )
    return narrow.mapInArrow(run, plain).toDF(*schema.fieldNames())
