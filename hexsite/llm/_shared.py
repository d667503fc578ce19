"""What the operators share: the shared folder, cutting lineage, files on any file system, words of bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from hexsite.sources.shared import shared_dir, stored  # noqa: F401

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A-Z in lower case; bytes outside [0-9A-Za-z\x80-\xff] become spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_atomically(uri: str, content: bytes) -> None:
    """Write under a name of this attempt's own, then rename: a retried or doubled task leaves one whole file."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as out:
        out.write(content)
    fs.move(own, path)


def give_back() -> None:
    """Memory that this process has freed goes back to the system; Arrow has a pool of its own."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass


def released(run):
    """A task's function that gives its memory back to the system when it ends: Python workers live on between tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most so many rows in an Arrow batch of this session: texts are long, and an executor's memory is small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= rows:
        spark.conf.set(key, str(rows))


def partitions(parts: int, most: int = 20_000) -> int:
    """Partitions for so many parts: beyond ``most``, a task takes several of them, one after the other."""
    return max(1, min(parts, most))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each, so that working memory doesn't follow the batch."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def words(text: bytes) -> list[bytes]:
    """Maximal runs of [0-9A-Za-z] and non-ASCII bytes, A-Z lower-cased."""
    return text.translate(FOLD).split()


def hash_words(found: list[bytes], cache: dict[bytes, int], most: int = 400_000) -> np.ndarray:
    """64-bit hashes of words. The cache is emptied when it holds ``most`` words."""
    from xxhash import xxh64_intdigest

    try:
        return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    except KeyError:
        if len(cache) > most:
            cache.clear()
        for w in set(found).difference(cache):
            cache[w] = xxh64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def annotate(df: DataFrame, text: str, keep: list[str], fields: dict[str, pa.DataType], make, *, gather: int = 0) -> DataFrame:
    """Rows of ``df`` as ``keep`` (a struct of those columns) and new columns computed from the text.

    ``gather``: the function sees about so many bytes of texts at once, where a pass over them has a cost of its own.

    ``make()`` runs once a task and gives a function from a list of UTF-8 texts (null: empty) to one list or
    array for each of ``fields``. The struct keeps new names from clashing with the table's own.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructField, StructType

    inside = text in keep
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep")
    source = df.select(kept) if inside else df.select(kept, F.col(f"`{text}`").alias("text"))
    schema = StructType([source.schema["keep"], *[StructField(k, from_arrow_type(t)) for k, t in fields.items()]])
    at = keep.index(text) if inside else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in gathered(batches, gather) if gather else batches:
            rows = batch.column(0)
            texts = utf8(rows.field(at) if inside else batch.column(1))
            for a, b in slices(texts, max(gather, 2 << 20)):
                out = f(texts[a:b])
                arrays = [rows.slice(a, b - a), *[x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out, fields.values(), strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["keep", *fields])

    small_batches(df.sparkSession)
    return source.mapInArrow(released(run), schema)
