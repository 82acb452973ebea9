"""Helpers shared by the text operators: reading, writing, Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.session import work_path

#: Rows of one Arrow batch sent to a Python worker; texts may be long.
ARROW_ROWS = 512
#: Bytes of text that a worker handles at a time.
CHUNK_BYTES = 4 << 20
#: A key in more than documents / HOT is broadcast in ``joined``.
HOT = 1_000
#: Most rows that ``joined`` broadcasts.
MOST_HOT = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, is
    computed once and outlives executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(rows: DataFrame, other: DataFrame, keys: list[str], frequent) -> DataFrame:
    """``rows`` joined with the unique ``keys`` of ``other``, whose ``frequent``
    ones are broadcast, so that no key fills a task.  They are counted first;
    more than MOST_HOT are joined by shuffle, where each has a small share."""
    hot = other.where(frequent)
    if hot.limit(MOST_HOT + 1).count() > MOST_HOT:
        return rows.join(other, keys)
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(other.where(~frequent), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def vector_sums(df: DataFrame, keys: str, dtype: str = "<f8") -> DataFrame:
    """Sums of the column ``vector`` (numbers of ``dtype``, as bytes) for each value
    of the column ``keys``, as doubles; a task holds one sum for each of its keys."""

    def run(batches):
        held: dict = {}
        for batch in batches:
            for k, v in zip(batch.column(keys).to_pylist(), batch.column("vector")):
                v = np.frombuffer(v.as_buffer(), dtype)
                if k in held:
                    held[k] += v
                else:
                    held[k] = v.astype("<f8")
        for k, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], batch.schema.field(keys).type), pa.array([v.tobytes()])], names=[keys, "vector"])

    return df.select(keys, "vector").repartition(keys).mapInArrow(run, df.select(keys, "vector").schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def per_worker(key, make: Callable):
    """An object kept for the life of a Python worker, such as a tokenizer."""
    store = sys.__dict__.setdefault("_text_operator_objects", {})
    if key not in store:
        store[key] = make()
    return store[key]


def crc_bucket(col: str, mod: int):
    """crc32 of the id written as text, modulo ``mod`` (folds of the contracts)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


def text_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text; a
    single longer text stays whole."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def word_places(texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of texts (a list or Arrow array; None is empty) at ASCII white space:
    the distinct words, which of them stands at each place, and where each text's
    places begin (and the last end).  No Python object is made."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = words.flatten()
    some = pc.not_equal(pc.binary_length(flat), 0)  # white space at either end leaves an empty part
    place = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))]
    begins = place[np.r_[0, np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))]]
    coded = flat.filter(some).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), begins


def split_words(texts) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``word_places`` with the distinct words as byte strings."""
    words, which, begins = word_places(texts)
    return words.cast(pa.binary()).to_pylist(), which, begins


def with_text_columns(df: DataFrame, text: str, make: Callable[[], Callable], fields: list[T.StructField], also: list[str] = (), limit: int = CHUNK_BYTES) -> DataFrame:
    """Append columns computed from ``text`` by a Python function.

    ``make()`` runs once per task and returns a function from a list of texts
    (None for null) to one Arrow array or list per field.  With ``also``,
    it gets tuples of the text and those columns instead.  All other columns pass
    through untouched; one with the name of a computed column is replaced."""
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *fields])
    arrow = [_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema.fields]

    def run(batches):
        compute = make()
        for whole in batches:
            for batch in text_slices(whole, text, limit):
                texts = batch.column(text).to_pylist()
                made = compute(list(zip(texts, *(batch.column(c).to_pylist() for c in also))) if also else texts)
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *made], names=names)

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)
