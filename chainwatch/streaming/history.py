"""The customers' histories as a versioned table, beside a stream's checkpoint.

Each micro-batch adds one delta folder with the customers that it saw: their
token count and last ``W - 1`` tokens (``tail``) and, under ``retain="batch"``, the
carried tokens and the batch's own, in pieces of at most a chunk (``body``), as the
original's history row holds them.  A customer's row is that of the latest version.
The folders that count are named by the stream's commit log, so a batch's delta
appears together with its outputs or not at all.  After ``COMPACT`` deltas the
latest rows are rewritten as one folder; folders that no recent commit names are
deleted.

A lookup reads the tails of the live folders and keeps the batch's own customers
(by broadcast while they are few enough, by a shuffle join beyond); customers are
joined null-safe.  Nothing here is Python per row, and a customer's tokens never meet
in one task: only ``W - 1`` of them are carried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MarkovConfig
from ..operators.ordering import MAX_BROADCAST_KEYS, join_keys
from ..operators.sequences import build_sequences, sequence_tails
from ..sources.commits import CommitLog, Files

#: Deltas after which the latest rows are rewritten as one folder.
COMPACT = 16


def commit_log(spark: SparkSession, checkpoint: str) -> CommitLog:
    return CommitLog(spark, f"{checkpoint.rstrip('/')}/chainwatch/commits")


class HistoryTable:
    def __init__(self, spark: SparkSession, checkpoint: str, cfg: MarkovConfig, key: str, retain: str = "tail", compact: int = COMPACT):
        if retain not in ("batch", "tail"):
            raise ValueError(f"retain={retain!r}")
        self.spark, self.cfg, self.key, self.retain, self.compact_after = spark, cfg, key, retain, compact
        self.folder = f"{checkpoint.rstrip('/')}/chainwatch/history"
        self.files = Files(spark, self.folder)

    def _paths(self, folders: list[str], part: str) -> list[str]:
        return [f"{self.folder}/{f}/{part}" for f in folders if part in self.files.names(f)]

    def tails(self, folders: list[str], keys: DataFrame | None = None, n_keys: int | None = None) -> DataFrame | None:
        """(key, n_seen, tail, version) of each customer, or of those in ``keys``."""
        paths = self._paths(folders, "tail")
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        if keys is not None:
            few = n_keys is not None and n_keys <= MAX_BROADCAST_KEYS
            rows = join_keys(rows, F.broadcast(keys) if few else keys, [self.key], "left_semi")
        latest = rows.groupBy(self.key).agg(F.max_by(F.struct("n_seen", "tail", "version"), "version").alias("_r"))
        return latest.select(self.key, "_r.*")

    def write(self, version: int, long: DataFrame, folders: list[str]) -> list[str]:
        """Write the delta of a batch's rows (key, pos, token; carried ones included)
        and return the folders that then make up the table."""
        name = f"delta-{version}"
        tail = sequence_tails(long, self.key, self.cfg.window - 1, chunk=self.cfg.chunk)
        tail = tail.select(self.key, F.col("n_tokens").alias("n_seen"), "tail", F.lit(version).cast("bigint").alias("version"))
        tail.write.mode("overwrite").parquet(f"{self.folder}/{name}/tail")
        if self.retain == "batch":
            body = build_sequences(long, self.key, self.cfg).select(self.key, "first_pos", "tokens")
            body.withColumn("version", F.lit(version).cast("bigint")).write.mode("overwrite").parquet(f"{self.folder}/{name}/body")
        folders = [*folders, name]
        return self.compacted(version, folders) if len(folders) > self.compact_after else folders

    def compacted(self, version: int, folders: list[str]) -> list[str]:
        """The latest rows of ``folders`` as one folder."""
        name = f"base-{version}"
        latest = self.tails(folders)
        latest.select(self.key, "n_seen", "tail", "version").write.mode("overwrite").parquet(f"{self.folder}/{name}/tail")
        bodies = self._paths(folders, "body")
        if bodies:
            kept = self.spark.read.parquet(f"{self.folder}/{name}/tail").select(self.key, "version")
            join_keys(self.spark.read.parquet(*bodies), kept, [self.key, "version"], "left_semi").write.mode("overwrite").parquet(f"{self.folder}/{name}/body")
        return [name]

    def drop_unused(self, entries: list[dict]) -> None:
        """Delete folders that none of the given commits names."""
        live = {f for e in entries for f in e.get("history", [])}
        for name in self.files.names():
            if name not in live:
                self.files.delete(name)

    def read(self, folders: list[str]) -> DataFrame | None:
        """(key, first_pos, tokens, n_seen): the stored history, by pieces."""
        latest = self.tails(folders)
        if latest is None:
            return None
        bodies = self._paths(folders, "body")
        if not bodies:
            return latest.select(self.key, (F.col("n_seen") - F.size("tail") + 1).alias("first_pos"), F.col("tail").alias("tokens"), "n_seen")
        body = self.spark.read.parquet(*bodies)
        return join_keys(body, latest.select(self.key, "version", "n_seen"), [self.key, "version"]).select(self.key, "first_pos", "tokens", "n_seen")
