"""Near-duplicate groups by bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles; its
sketch holds the ``SKETCH`` smallest of them.

1. Documents with one set (equal 128-bit digest of the whole set) form a class;
   only the class's smallest id goes on, so exact copies cost one row each.
2. Inverted lists gather the classes that share a value.  A value in more than
   ``BLOCK`` classes says little, so every class is listed under its ``LISTED``
   smallest values that are not so common, and under ``MORE`` further ones for
   each common value, because the rest of such a pair agrees less.  Classes with
   fewer than ``LEAST_RARE`` of these among the first 2 * LISTED (wide ones) are
   listed with each other under the common values too.
3. Within a list, the sketch of the union gives an estimate of the similarity.
   Estimates of at least ``LOOSE`` below the wanted one join classes to loose
   clusters (each task returns a spanning forest, never the pairs).  First every
   class meets others under ``FIRST`` of its values only, which joins most of a
   group of near copies; lists whose members then lie in one cluster are dropped,
   as nothing is left to link in them, and in the others only members of
   different clusters are linked.
4. Within a loose cluster, full sets are compared exactly; the links that hold
   join classes to components (again as spanning forests).

A list or cluster that is larger than a block is dealt out to tasks in pairs of
blocks, so that no task holds more than two: each block meets the first one, then
those outside the largest cluster meet all others.  A list where these are so many
that dealing costs more rows than its classes have runs of three consecutive sketch
values is replaced by lists under those runs (short sketches: runs of two as well,
of which two linked short sets always share one).  Two sets with a similarity of 0.8
share none of the smallest such values of their union with probability 0.2^8 or less
(1e-5 if only one of the two is wide), and no run of three in 64 with probability
below 1e-8; their estimate is 6 standard deviations above the limit of a loose link,
which it misses with probability 2e-8.

Defined cases: null text, or one without words, has the empty set, is linked
with nothing and is its own component; a text with fewer words than a shingle
has one shingle of all its words; rows with one id count as one document; rows
with a null id are components of their own with a null id; an empty table gives
an empty result; other columns are not read."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainwatch.llm._common import split_words, text_slices, unused, written
from chainwatch.llm.components import components, contracted

#: Values of a sketch, and those of them that get inverted lists.
SKETCH, LISTED = 64, 8
#: Further values listed for each common one: c of 16 leave (0.8 - c / 16) / (1 - c / 16).
MORE = 0.6
#: Values that are not very common, among a class's first 2 * LISTED, below which
#: it is wide; sketch size below which its runs are of two as well.
LEAST_RARE, SHORT = 11, 32
#: Blocks of strays in a list from which its classes are listed by their runs, of
#: which a full sketch has as many.
RUNS = SKETCH - 2
#: Values under which a class meets others before the rest.
FIRST = 2
#: Classes of a block: the most that a list holds before it is refined or split.
BLOCK = 1024
#: Shingles of a block in the exact comparison, and of a task of many clusters.
BLOCK_SHINGLES, TASK_SHINGLES = 1 << 20, 1 << 18
#: Estimated similarity, below the wanted one, that makes a loose link.
LOOSE = 0.3
#: Classes with more than rows / MAX_HOT members are looked up by broadcast.
MAX_HOT = 10_000
FULL = np.uint64((1 << 63) - 1)


class Shingler:
    """Sets of shingle hashes (63 bits, ascending) of texts."""

    def __init__(self, words: int):
        self.words = words

    def sets(self, texts) -> list[np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        known, which, begins = split_words(pc.ascii_lower(texts))
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))[which]
        return [self._set(h[x:y]) for x, y in zip(begins.tolist(), begins[1:].tolist())]

    def _set(self, h: np.ndarray) -> np.ndarray:
        n, w = len(h), self.words
        if n == 0:
            return np.zeros(0, np.int64)
        width = min(n, w)
        v = _mix(h[: n - width + 1] + np.uint64(width))
        for j in range(1, width):
            v = _mix(v * np.uint64(0x9E3779B97F4A7C15) + h[j : n - width + 1 + j])
        return np.unique(v & FULL).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (fixed constants of that public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(id, n, digest, sketch) of each row."""

    def run(batches):
        shingler = Shingler(words)
        for whole in batches:
            for b in text_slices(whole, "text"):
                sets = shingler.sets(b.column("text"))
                n = pa.array([len(s) for s in sets], pa.int64())
                digest = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                sketch = pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("id"), n, digest, sketch], names=["id", "n", "digest", "sketch"])

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, digest binary, sketch array<bigint>")


def _lists(classes: DataFrame) -> DataFrame:
    """(key, rep, turn): the members of every inverted list of two or more; turn
    numbers a class's own lists.  One row per class gathers its first values."""
    first = classes.select("rep", F.least(F.size("sketch"), F.lit(2 * LISTED)).alias("k"), F.posexplode(F.slice("sketch", 1, 2 * LISTED)).alias("rank", "key"))
    first = written(first, "near-posts")
    m = first.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    value = F.struct("rank", "key", "m")
    own = first.join(m, "key").groupBy("rep", "k").agg(F.sort_array(F.collect_list(value)).alias("v"))
    own = own.withColumn("common", F.size(F.filter("v", lambda x: x["m"] > BLOCK)))
    wide = F.col("k") - F.col("common") < LEAST_RARE
    depth = LISTED + F.col("common") + F.ceil(F.col("common") * MORE)
    # the common values of wide classes are lists of their own: only wide ones are in them
    kept = F.filter("v", lambda x: F.when(x["m"] > BLOCK, wide).otherwise(x["rank"] < depth))
    keys = F.transform(kept, lambda x: F.when(x["m"] > BLOCK, F.xxhash64(x["key"], F.lit("wide"))).otherwise(x["key"]))
    listed = written(own.select("rep", F.posexplode(keys).alias("turn", "key")), "near-lists")
    several = listed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    return listed.join(several, "key")


def _run_keys(classes: DataFrame) -> DataFrame:
    """(key, rep): a key for every run of three sketch values (short: two as well)."""
    run = lambda n, of: F.expr(
        f"if(size(sketch) >= {n} and {of}, transform(sequence(0, size(sketch) - {n}), i -> xxhash64(slice(sketch, i + 1, {n}))), array())"
    )
    keys = F.concat(run(3, "true"), run(2, f"size(sketch) < {SHORT}"))
    return classes.select(F.explode(keys).alias("key"), "rep")


def _loose(classes: DataFrame, lists: DataFrame, link) -> DataFrame:
    """(node, component) of the loose links among the members of each list."""
    sketch = classes.select("rep", "n", "sketch")
    columns = ["n", "sketch"]
    attach = lambda d: d.join(sketch, "rep")
    # under a few values each first
    head = lists.where(F.col("turn") < FIRST).select("key", "rep")
    size = head.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("_n"))
    edges = _meet_first(head.join(size, "key"), "key", attach, columns, link)
    parts = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("_part"))
    rows = lists.select("key", "rep").join(parts, "rep", "left").withColumn("_part", F.coalesce("_part", "rep"))
    rows = written(rows, "near-parts")
    # lists that are one cluster have nothing left to link
    counts = rows.groupBy("key", "_part").agg(F.count("*").alias("_size"))
    state = counts.groupBy("key").agg(
        F.sum("_size").alias("m"), (F.sum("_size") - F.max("_size")).alias("_strays"), F.max_by("_part", F.struct("_size", "_part")).alias("_most")
    )
    state = written(state.where("_strays > 0").withColumns({"_n": F.ceil(F.col("m") / BLOCK), "_s": F.ceil(F.col("_strays") / BLOCK)}), "near-open")
    rows = rows.join(state, "key")
    small = rows.where("_n = 1").select(F.col("key").alias("task"), "rep", "_part")
    large = rows.where(F.col("_n") > 1)
    found = [edges, _by_task(attach(small), columns, link, part=True)]
    if not state.where("_n > 1").isEmpty():
        few = large.where(F.col("_s") <= RUNS)
        found.append(_by_task(attach(_deal_strays(few, "key")), columns, link, part=True))
        many = large.where(F.col("_s") > RUNS).select("rep").distinct()
        if not many.isEmpty():
            runs = written(_run_keys(classes.join(many, "rep", "left_semi")), "near-runs")
            size = runs.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
            runs = runs.join(size, "key").join(parts, "rep", "left").withColumn("_part", F.coalesce("_part", "rep"))
            return _linked(runs, "key", F.ceil(F.col("m") / BLOCK), attach, columns, link, reduce(DataFrame.union, found))
    return components(reduce(DataFrame.union, found))


def _block(column: str, blocks):
    return F.pmod(F.xxhash64(column), blocks)


def _meet_first(rows: DataFrame, key: str, attach, columns: list[str], link, tasks: int | None = None) -> DataFrame:
    """Edges of the links found when a key of one block (``_n`` = 1) is one task, and
    in a larger one each block meets the first."""
    rows = rows.select(key, "rep", F.col("_n").cast("bigint").alias("_n")).withColumn("_mine", _block("rep", F.col("_n")))
    later = F.sequence(F.lit(1).cast("bigint"), F.col("_n") - 1)
    meets = F.when(F.col("_n") == 1, F.array(F.lit(0).cast("bigint"))).when(F.col("_mine") == 0, later).otherwise(F.array("_mine"))
    dealt = rows.withColumn("_other", F.explode(meets)).select(F.xxhash64(key, "_other").alias("task"), "rep")
    return written(_by_task(attach(dealt), columns, link, tasks=tasks), "near-edges")


def _deal_strays(rows: DataFrame, key: str) -> DataFrame:
    """(task, rep, _part) in which the members outside a key's largest part meet all
    others: a block of them (of ``_s``) with a block of members (of ``_n``)."""
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    strays = rows.where("_part <> _most").withColumns({"_i": _block("rep", F.col("_s")), "_j": every("_n")})
    others = rows.withColumns({"_i": every("_s"), "_j": _block("rep", F.col("_n"))})
    dealt = strays.select(key, "_i", "_j", "rep", "_part").union(others.select(key, "_i", "_j", "rep", "_part")).distinct()
    return dealt.select(F.xxhash64(key, "_i", "_j", F.lit(1)).alias("task"), "rep", "_part")


def _linked(members: DataFrame, key: str, blocks, attach, columns: list[str], link, known: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """(node, component) of the links among the members (``key``, rep) of each key,
    and of the edges ``known``.

    A key of one block is one task.  A larger one is dealt out twice: first each
    block meets the first one, which in a dense group links nearly all members;
    then only those outside the key's largest component meet all others, a block
    of them with a block of members at a time.  Two members that never meet are in
    that component, so no link is lost, and a group of near copies costs a few
    rows a member however large it is.  ``attach`` joins what ``link`` needs."""
    rows = written(members.select(key, "rep", blocks.cast("bigint").alias("_n")), "near-members")
    edges = _meet_first(rows, key, attach, columns, link, tasks)
    if known is not None:
        edges = edges.union(known)
    first = components(edges)
    wide = rows.where("_n > 1")
    if wide.isEmpty():
        return first
    parts = first.select(F.col("node").alias("rep"), F.col("component").alias("_part"))
    wide = wide.join(parts, "rep", "left").withColumn("_part", F.coalesce("_part", "rep"))
    wide = written(wide, "near-wide")
    parts = wide.groupBy(key, "_part").agg(F.count("*").alias("_size"))
    most = parts.groupBy(key).agg(F.max_by("_part", F.struct("_size", "_part")).alias("_most"), (F.sum("_size") - F.max("_size")).alias("_strays"))
    most = written(most.where("_strays > 0").withColumn("_s", F.ceil(F.col("_strays") / BLOCK)), "near-strays")
    if most.isEmpty():
        return first
    return components(edges.union(_by_task(attach(_deal_strays(wide.join(most, key), key)), columns, link, part=True)))


def _by_task(rows: DataFrame, columns: list[str], link, part: bool = False, tasks: int | None = None) -> DataFrame:
    """Edges (a, b) that ``link(column arrays)`` finds in each task's rows; its
    result is a list of index pairs, of which a spanning forest is kept for the whole
    Spark task.  With
    ``part``, members of one ``_part`` count as linked already."""
    rows = rows.select("task", "rep", *(["_part"] if part else []), *columns)
    rows = (rows.repartition(tasks, "task") if tasks else rows.repartition("task")).sortWithinPartitions("task")

    def run(batches):
        held = None
        for b in batches:
            table = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            task = table.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist()]
            yield [e for x, y in zip(cuts, cuts[1:]) for e in forest(table.slice(x, y - x))]
            held = table.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield forest(held)

    def forest(group):
        if group.num_rows < 2:
            return []
        rep = group.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        parent = list(range(len(rep)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        rank = np.empty(len(rep), np.int64)
        rank[order] = np.arange(len(rep))
        if part:
            at: dict[int, int] = {}
            for x, p in zip(rank.tolist(), group.column("_part").to_pylist()):
                y = at.setdefault(p, x)
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
            if len(at) < 2:
                return []
        rep, edges = rep[order].tolist(), []
        for x, y in link(*(group.column(c) for c in columns)):
            x, y = root(int(rank[x])), root(int(rank[y]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((rep[min(x, y)], rep[max(x, y)]))
        return edges

    return rows.mapInArrow(lambda batches: contracted(run(batches)), "a bigint, b bigint")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(size)), size)


def common(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Matrix of the number of values that each two rows share.

    Values in few rows are counted pair by pair, others by matrix products."""
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    several = count[inverse] > 1
    inverse, row = inverse[several], row[several]
    total = np.zeros((rows, rows), np.float32)
    if not len(row):
        return total
    order = np.argsort(inverse, kind="stable")
    inverse, row = inverse[order], row[order]
    start = np.flatnonzero(np.r_[True, np.diff(inverse) > 0])
    size = np.diff(np.r_[start, len(row)])
    cells = []
    for g in range(2, 9):  # values that g rows share: all pairs of places at once
        at = start[size == g]
        if len(at):
            cells += [row[at + i] * rows + row[at + j] for i in range(g) for j in range(g) if i != j]
    if cells:
        total += np.bincount(np.concatenate(cells), minlength=rows * rows).reshape(rows, rows)
    wide = np.flatnonzero(size > 8)
    for k in range(0, len(wide), 4096):
        part = wide[k : k + 4096]
        which = np.repeat(np.arange(len(part)), size[part])
        place = np.concatenate([np.arange(start[p], start[p] + size[p]) for p in part])
        has = np.zeros((rows, len(part)), np.float32)
        has[row[place], which] = 1
        total += has @ has.T
    return total


def _estimated(least: float):
    def link(n, sketch):
        values, row = _flat(sketch)
        n = n.to_numpy()
        rows = len(n)
        shared = common(values, row, rows)
        # the sketch of a union reaches up to the smaller of the last values kept
        size = np.bincount(row, minlength=rows)
        end = np.cumsum(size)
        last = np.where(n <= SKETCH, np.iinfo(np.int64).max, values[end - 1])
        below = np.empty((rows, rows), np.int64)  # own values up to the other's last one
        for i in range(rows):
            below[i] = np.searchsorted(values[end[i] - size[i] : end[i]], last, side="right")
        union = below + below.T - shared
        close = np.minimum.outer(n, n) >= least * np.maximum.outer(n, n)
        x, y = np.nonzero(np.triu((shared >= (least - LOOSE) * union) & close, 1))
        return zip(x.tolist(), y.tolist())

    return link


def _exact(words: int, percent: int):
    shingler = []

    def link(text):
        if not shingler:
            shingler.append(Shingler(words))
        sets = shingler[0].sets(text.combine_chunks())
        n = np.array([len(s) for s in sets])
        shared = common(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), len(sets))
        union = n[:, None] + n[None, :] - shared
        x, y = np.nonzero(np.triu((100 * shared >= percent * union) & (shared > 0), 1))
        return zip(x.tolist(), y.tolist())

    return link


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: ``id``, n_shingles, component_id, kept."""
    own = written(sketches(docs, id, text, words), "near-sketches")
    classes = own.where("n > 0 and id is not null").groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = written(classes, "near-classes")

    loose = written(_loose(classes, _lists(classes), _estimated(percent / 100)), "near-loose")

    clusters = loose.join(classes.select(F.col("rep").alias("node"), "n"), "node")
    size = clusters.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    members = clusters.join(size, "component").withColumnRenamed("node", "rep")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    texts = docs.select(F.col(id).cast("bigint").alias("rep"), F.col(text).alias("text"))
    # comparing costs by shingles, not by bytes: tasks are counted by them
    total = clusters.agg(F.sum("n")).first()[0] or 0
    most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, total // TASK_SHINGLES))
    same = _linked(members, "component", blocks, lambda d: d.join(texts, "rep"), ["text"], _exact(words, percent), tasks=tasks)

    found = classes.join(same.withColumnRenamed("node", "rep"), "rep", "left")
    found = written(found.select("digest", "size", F.coalesce("component", "rep").alias("component_id")), "near-found")
    # classes with very many members are few enough to broadcast
    least = max(1_000, own.count() // MAX_HOT)
    hot = found.where(F.col("size") > least).select("digest", F.col("component_id").alias("hot_id"))
    rows = own.select("id", "n", "digest").join(F.broadcast(hot), "digest", "left")
    cold = rows.where("hot_id is null").drop("hot_id").join(found.select("digest", F.col("component_id").alias("hot_id")), "digest", "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("hot_id")).otherwise(F.col("id"))
    return rows.where("hot_id is not null").select("id", "n", "hot_id").union(cold.select("id", "n", "hot_id")).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def drop_near(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each component, with their columns; rows
    with a null id stay."""
    gone = unused(docs, "_lost")
    lost = near_groups(docs, id, text, words, percent).where("not kept").select(F.col(id).alias(gone)).distinct()
    return docs.join(lost, docs[id] == F.col(gone), "left_anti")
