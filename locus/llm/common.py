"""What the operators share: shared-folder tables, Arrow helpers, streamed groups, hot-group splitting and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Texts average a few KB; a batch stays far below a worker's memory even if many are long.
ARROW_ROWS = 1000

_own_dirs: dict[str, str] = {}
#: Tables written since the innermost `distilled` began.
_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints (spark.checkpoint.dir); a temporary one only where that is unset in a local session, as in
    tests."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set")
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="locus-")
    return _own_dirs[sc.applicationId]


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a table written in the shared folder: it survives lost executors and is read back with pruning."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    if _tables.get() is not None:
        _tables.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def distilled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """`make`'s rows as a table of their own. The tables that it wrote on the way are deleted, so no DataFrame on them may leave it;
    the shuffle files of its jobs go with the driver's garbage, which is collected."""
    outer, written = _tables.get(), []
    _tables.set(written)
    try:
        rows = make()
        _tables.set(outer)
        return materialize(rows)
    finally:
        _tables.set(outer)
        for path in written:
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
        spark._jvm.System.gc()


def arrow_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def restored(kind: type, state: dict):
    """An object from its attributes. Broadcasts hold plain values, since executors need not have this package."""
    out = object.__new__(kind)
    out.__dict__.update(state)
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) else "", column.type))
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by key and sort each partition by it, for `per_group`."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def per_group(keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch | pa.Table]]) -> Callable:
    """For mapInArrow over `spread` rows: calls `work` with a table of one or more whole groups at a time.

    Groups that end inside a batch go together, which spares the cost of a call per group; only the last, open group is held
    back. Callers bound the size of a group, so memory is bounded by a batch and a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in work(table.combine_chunks()):
                yield from part.to_batches() if isinstance(part, pa.Table) else [part]

        for batch in batches:
            if not batch.num_rows:
                continue
            start = 0
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
            if held and [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys] == last:
                held.append(batch)
                continue
            same = np.ones(batch.num_rows, dtype=bool)
            for k in keys:
                v = pc.equal(batch.column(k), batch.column(k)[batch.num_rows - 1])
                same &= np.asarray(v.fill_null(False)) if last[keys.index(k)] is not None else np.asarray(pc.is_null(batch.column(k)))
            start = int(np.argmax(same))
            if held or start:
                yield from out(pa.Table.from_batches([*held, batch.slice(0, start)]))
            held = [batch.slice(start)]
        if held:
            yield from out(pa.Table.from_batches(held))

    return run


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted columns, and the number of rows at the end."""
    n = len(columns[0])
    new = np.ones(n, dtype=bool)
    if n:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find over n = max + 1 local numbers given as links; returns each number's smallest reachable number."""
    n = int(max(a.max(initial=-1), b.max(initial=-1))) + 1
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def split_hot(df: DataFrame, keys: list[str], salt: str, most: int) -> DataFrame:
    """Rows of groups prepared for comparing every pair of a group without a task that holds more than 2 * most rows.

    A group of c rows is cut by `salt` (a hash column) into p = ceil(c / most) parts, and a row of part i goes to the blocks
    (i, j) with every part j: each pair of rows meets in exactly one block. Adds part, block_lo, block_hi. Sizes are counted
    with partial aggregation; the join is on the group, where AQE splits hot keys.
    """
    sizes = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")).where(F.col("group_rows") > 1))
    parts = F.ceil(F.col("group_rows") / most).cast("int")
    joined = df.join(sizes, keys).withColumn("parts", parts)
    part = F.pmod(F.col(salt), F.col("parts")).cast("int")
    return (
        joined.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("block_lo", F.least("part", "other"))
        .withColumn("block_hi", F.greatest("part", "other"))
        .drop("group_rows", "parts", "other")
    )


def components(vertices: DataFrame, links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): each vertex with the smallest id reachable over links (a, b), by large-star / small-star rounds.

    Each round is two aggregations of minima (with map-side combine, so a hub of millions of links is no hot task) and joins
    back on the vertex, where AQE splits hot keys; a round's links are written to the shared folder. Rounds are logarithmic in
    the longest path.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    mark: tuple | None = None
    for _ in range(most_rounds):
        # Large star: neighbours above v link to the smallest of v and all its neighbours.
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v").distinct()
        # Small star: v and its neighbours below it link to the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u")))
        new = materialize(small.where("u <> v").distinct())
        # No round that changes links keeps their number and their hashes' exclusive or.
        seen, mark = mark, tuple(new.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first())
        edges = new
        if seen == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    low = edges.groupBy("v").agg(F.min("u").alias("component"))
    return vertices.select("id").join(low, vertices["id"] == low["v"], "left").select("id", F.coalesce("component", "id").alias("component"))
