"""Line deduplication with levelled sorted runs of line hashes.

The lines' keys are hashed to 128 bits in one pass over the texts.  Documents
are then taken in batches of ascending id: a batch's keys, reduced to the
smallest id that holds each, are merge-anti-joined with the runs of the earlier
batches, and the new keys become a run of level 0, sorted by hash, together with
their owner.  When a level has ``FANOUT`` runs they are compacted to one run of
the next level.  A line stays where its document owns its key; so only keys and
their owners are shuffled, and no list of the documents that hold a line is
ever built, however common the line is.

The number of batches is fixed, not their size: each batch reads the runs
before it, so that the work grows with the input.

Defined cases: a null or empty text is one empty line; keys below
``min_chars`` code points always stay; repeated lines within the owner stay;
rows with one id count as one document, and rows with a null id as one document
that comes last; an empty table gives an empty result; other columns are not
read."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm._common import text_slices, with_text_columns, written
from chainwatch.session import work_path

#: Batches of documents, and runs of a level that are compacted to one.
BATCHES, FANOUT = 6, 3
WHITE = b" \t\n\x0b\x0c\r"
#: Stands for a null id: after all others.
LAST = (1 << 63) - 1


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's key, None if the key is too short to count."""
    key = line.strip(WHITE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(key, owner): the distinct keys of each document."""

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, "text"):
                keys, owners = [], []
                for owner, t in zip(b.column("owner").to_pylist(), b.column("text").to_pylist()):
                    own = {line_key(x, min_chars) for x in (t or "").encode().split(b"\n")} - {None}
                    keys += own
                    owners += [owner] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], names=["key", "owner"])

    return docs.select(_owner(id), F.col(text).alias("text")).mapInArrow(run, "key binary, owner bigint")


def _owner(id: str):
    return F.coalesce(F.col(id).cast("bigint"), F.lit(LAST)).alias("owner")


class Runs:
    """Levelled sorted runs of (key, owner) in the shared folder."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def read(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.schema("key binary, owner bigint").parquet(*paths) if paths else None

    def add(self, run: DataFrame, level: int = 0) -> None:
        path = work_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged = self.spark.read.schema("key binary, owner bigint").parquet(*self.levels[level])
            self.levels[level] = []
            self.add(merged.repartition("key"), level + 1)


def line_owners(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 10, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(key, owner): every line key with the smallest id that holds it."""
    spark = docs.sparkSession
    keys = written(line_keys(docs, id, text, min_chars), "line-keys")
    shares = [k / batches for k in range(1, batches)]
    cuts = docs.select(F.percentile_approx(_owner(id), shares, 10_000)).first()[0] if shares else []
    bounds = [None, *sorted(set(cuts or [])), None]
    runs = Runs(spark, fanout)
    for low, high in zip(bounds, bounds[1:]):
        batch = keys
        batch = batch if low is None else batch.where(F.col("owner") > low)
        batch = batch if high is None else batch.where(F.col("owner") <= high)
        batch = batch.groupBy("key").agg(F.min("owner").alias("owner"))
        seen = runs.read()
        runs.add(batch if seen is None else batch.join(seen.select("key").hint("merge"), "key", "left_anti"))
    return runs.read()


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 10, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row per document: ``id``, n_lines, n_dropped, kept_text."""
    owners = line_owners(docs, id, text, min_chars, batches, fanout)
    own = owners.groupBy("owner").agg(F.collect_list("key").alias("own"))
    rows = docs.select(id, F.col(text).alias("text"), _owner(id)).join(own, "owner", "left")

    def make():
        def compute(batch):
            lines_n, dropped_n, texts = [], [], []
            for t, own in batch:
                lines, own = (t or "").encode().split(b"\n"), set(own or ())
                kept = [x for x in lines if (k := line_key(x, min_chars)) is None or k in own]
                lines_n.append(len(lines))
                dropped_n.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode())
            return lines_n, dropped_n, texts

        return compute

    fields = [T.StructField("n_lines", T.LongType(), False), T.StructField("n_dropped", T.LongType(), False), T.StructField("kept_text", T.StringType(), False)]
    return with_text_columns(rows, "text", make, fields, also=["own"]).select(id, "n_lines", "n_dropped", "kept_text")
