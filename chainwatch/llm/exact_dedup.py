"""Exact deduplication by content sort, in DataFrame operations only.

White space runs of a text become one space; the normalised texts are ordered
by sampled splitters (``repartitionByRange``), each partition is sorted
externally, and a window over the sorted rows compares neighbouring texts in
full: a run of equal texts is a group.

* The splitters are drawn from a short sort key (the first characters and a
  hash of the whole text), so that the sample taken to the driver stays small.
  The rows are ordered by that key and then by the whole text.
* A text that more than ``hot`` rows share is cut into sub-groups by a salt in
  the sort key, one for each ``hot`` rows; each sub-group's head (its smallest
  id) is then compared with the other heads of the same text.  Only texts with
  more than ``rows / MAX_HOT_TEXTS`` rows can be hot, so the list of their
  hashes, which is broadcast, never exceeds MAX_HOT_TEXTS.
* What the sort finds is written once, without the texts, to the shared folder.

Defined cases: null text counts as empty, and empty texts are equal to each
other; null ids come after all others, and a group of null ids only keeps one
of them with ``keep_id`` null; of repeated rows with one id, one stays; an
empty table gives an empty result; other columns are passed through by
``drop_exact`` and not read by ``exact_groups``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainwatch.llm._common import written

#: Rows of one text beyond which it is salted, at least.
HOT_ROWS = 1_000
#: Most texts that can be hot.
MAX_HOT_TEXTS = 10_000
#: Characters of the sort key that the splitters are drawn from.
KEY_CHARS = 16


def normalised(text):
    """The text column (null: empty) with each white space run replaced by a space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _content_sorted(docs: DataFrame, id: str, text: str, hot_rows: int) -> DataFrame:
    """The rows of ``docs`` as a struct _doc, with the place of each in its run
    of equal texts _norm: _first (of its sub-group), _head (smallest id), _size."""
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))
    id, norm = F.col("_doc")[id], normalised(F.col("_doc")[text])
    least = max(hot_rows, docs.count() // MAX_HOT_TEXTS)
    hot = rows.groupBy(F.xxhash64(norm).alias("_hot")).agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    salt = 1 + F.pmod(F.xxhash64(F.coalesce(id, F.lit(0))), F.ceil(F.col("_n") / least))
    rows = rows.withColumns({"_hash": F.xxhash64(norm), "_prefix": F.substring(norm, 1, KEY_CHARS)})
    rows = rows.join(F.broadcast(hot), F.col("_hash") == F.col("_hot"), "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    order = ["_prefix", "_hash", "_salt"]
    by_id = Window.partitionBy(*order, "_norm").orderBy(F.col("_id").asc_nulls_last())
    whole = by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the normalised text is made again after the shuffle rather than carried along
    ranged = rows.select("_doc", *order).repartitionByRange(*order).withColumns({"_norm": norm, "_id": id})
    return ranged.withColumns(
        {"_first": F.row_number().over(by_id) == 1, "_head": F.first("_id").over(by_id), "_size": F.count("*").over(whole)}
    )


def _same_sub(other: str):
    return (
        (F.col("_hash") == F.col(other + "_hash"))
        & (F.col("_salt") == F.col(other + "_salt"))
        & F.col("_head").eqNullSafe(F.col(other + "_head"))
    )


def _merged(subs: DataFrame) -> DataFrame:
    """For the sub-groups of hot texts, by full comparison of their heads: the
    smallest id and the size of the whole group.

    At most 2 * MAX_HOT_TEXTS rows: every sub-group but one of a text stands for
    about ``rows / MAX_HOT_TEXTS`` rows or more."""
    total = subs.groupBy("_norm").agg(F.min("_head").alias("_keep"), F.sum("_size").alias("_total"))
    names = [F.col(c).alias("m" + c) for c in ("_hash", "_salt", "_head")]
    return subs.join(total, "_norm").select(*names, "_keep", "_total")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per document: ``id``, keep_id, group_size, kept, text_sha256."""
    found = _content_sorted(docs.select(id, text), id, text, hot_rows).select(
        "_id", "_hash", "_salt", "_first", "_head", "_size", F.sha2("_norm", 256).alias("text_sha256"),
        # the text itself goes along only where heads of sub-groups are compared
        F.when((F.col("_salt") > 0) & F.col("_first"), F.col("_norm")).alias("_norm"),
    )
    found = written(found, "exact-groups")
    merged = _merged(found.where("_norm is not null"))
    rows = found.drop("_norm").join(F.broadcast(merged), _same_sub("m"), "left")
    keep = F.when(F.col("_total").isNull(), F.col("_head")).otherwise(F.col("_keep"))
    return rows.select(
        F.col("_id").alias(id),
        keep.alias("keep_id"),
        F.coalesce("_total", "_size").alias("group_size"),
        (F.col("_first") & F.col("_head").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct normalised text,
    with all their columns."""
    ranged = _content_sorted(docs, id, text, hot_rows)
    merged = _merged(_content_sorted(docs.select(id, text), id, text, hot_rows).where("_salt > 0 and _first"))
    lost = merged.where(~F.col("m_head").eqNullSafe(F.col("_keep"))).select("m_hash", "m_salt", "m_head")
    return ranged.where("_first").join(F.broadcast(lost), _same_sub("m"), "left_anti").select("_doc.*")
