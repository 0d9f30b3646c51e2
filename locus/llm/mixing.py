"""Mixing sources to target weights by entropy balancing, in DataFrame and SQL functions only.

Every word of the corpus starts with rate 1. The balanced rates are those nearest to it in relative entropy whose words per group
sum to the targets, for one or several sets of groups that overlap (sources, languages). The convex dual sum_g(lambda_g *
target_g) - sum_i(size_i * exp(sum of lambda of i's groups)) gives documents exponentially tilted rates. Each Newton step is a
distributed aggregation: the words of each group at the present rates, which are the dual's gradient and, since groups of one set
do not overlap, that set's diagonal of the Hessian; sets take their steps in turn. Multipliers are tables of a row a group. Since
targets stop at `most` times a source, no rate exceeds `most`.

Rates become whole copies: each document gets floor(rate) copies, and those that come first in a seeded hash order get one more,
up to the point where the source's words come nearest to its target. That point is found in two levels: sums per (source, hash
bucket), then an exact running sum inside one bucket per source, so no task ever holds a whole source. Equal rows are counted
first, by partial aggregation, and share one place in the order; of the group at the end as many rows as come nearest get the copy.

Defined results: null or blank text has size 0 and takes 0. A null source is a source of its own, last in order. Rows without a
doc_id are told apart by their texts; repeated rows are documents of their own. Very long texts count like others, whole. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Hash buckets per source; the running sum inside a bucket holds this share of a source's rows.
BUCKETS = 4096
NEWTON_STEPS = 60
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets_by_weight(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Adds target to (source, source_size): weights repeat over sources by code point, null last; all words are shared out by
    weight; targets over most x source_size stop there and the excess is reshared by weight until none is above.

    The water level t with sum(min(weight * t, most * size)) = total is exact: sources are sorted by most * size / weight, where
    they stop one after another. The table has one row per source.
    """
    in_order = Window.orderBy(F.col("source").isNull(), F.encode(F.coalesce("source", F.lit("")), "utf-8"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    t = sources.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    stops = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    onward = stops.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    t = t.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    # The first source that does not stop at its cap under its own level fixes the level for it and all after it.
    t = t.withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(everything)["level"]
    return t.withColumn("t", level).withColumn("target", F.coalesce(F.least(F.col("cap"), F.col("t") * F.col("weight")), F.col("cap"))).select("source", "source_size", "target")


def balance(rows: DataFrame, targets: dict[str, DataFrame], most: float = 3.0) -> dict[str, DataFrame]:
    """(group, target, lam) of each set of groups: Newton steps on the dual, no longer than 1, until all targets are met to one part
    in 10^12. rows are (size, n, <set>...), targets name -> (<set>, target). Sets whose targets contradict each other do not
    settle: then the last step's multipliers are returned. A group without words, or with target 0, keeps multiplier 0."""
    small = {c: t.limit(100_001).count() <= 100_000 for c, t in targets.items()}
    lam = {c: t.select(c, "target", F.lit(0.0).alias("lam")) for c, t in targets.items()}
    for _ in range(NEWTON_STEPS):
        worst = 0.0
        for c in lam:
            s = F.coalesce("words", F.lit(0.0))
            sums = tilted(rows, lam, small).groupBy(F.col(c).alias("_g")).agg(F.sum(F.col("size") * F.col("n") * F.exp("tilt")).alias("words"))
            error = F.when((s > 0) & (F.col("target") > 0), (F.col("target") - s) / s).otherwise(0.0)
            step = lam[c].join(sums, F.col(c).eqNullSafe(F.col("_g")), "left").withColumn("error", error)
            lam[c] = materialize(step.select(c, "target", (F.col("lam") + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "error"))).alias("lam"), F.abs("error").alias("error")))
            worst = max(worst, lam[c].agg(F.max("error")).first()[0] or 0.0)
        if worst < 1e-12:
            break
    return lam


def tilted(rows: DataFrame, lam: dict[str, DataFrame], small: dict[str, bool]) -> DataFrame:
    """Adds tilt, the sum of the multipliers of a row's groups. Tables counted to be small, up to 100,000 groups, are broadcast."""
    out = rows.withColumn("tilt", F.lit(0.0))
    for i, (c, table) in enumerate(lam.items()):
        own = table.select(F.col(c).alias(f"_g{i}"), F.col("lam").alias(f"_l{i}"))
        own = F.broadcast(own) if small[c] else own
        out = out.join(own, F.col(c).eqNullSafe(F.col(f"_g{i}")), "left").withColumn("tilt", F.col("tilt") + F.coalesce(f"_l{i}", F.lit(0.0))).drop(f"_g{i}", f"_l{i}")
    return out


def order_key(seed: int, *columns: Column) -> Column:
    """A row's place in the seeded order: a digest of these columns that other engines have too."""
    named = [F.coalesce(F.concat(F.lit("v"), F.md5(c.cast("string").cast("binary"))), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *named).cast("binary"))


def mix(rows: DataFrame, targets: DataFrame, most: float = 3.0) -> DataFrame:
    """Adds source_size, target, rate, whole and extra to groups of equal rows (source, size, n, k, ...) by the targets (source,
    source_size, target, lam): each of a group's n rows gets `whole` copies, `extra` of them one more. k is the groups' order.

    `rows` should be cheap to read again (a table). Joins with the sources are null-safe; below 100,000 sources their table is
    broadcast (its rows are counted first), beyond that the join is a shuffle, where AQE splits hot sources.
    """
    rows = rows.withColumn("_bucket", F.conv(F.substring("k", 1, 3), 16, 10).cast("int"))
    bounded = targets.limit(100_001).count() <= 100_000
    hint = F.broadcast if bounded else (lambda x: x)
    rate = F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.least(F.lit(float(most)), F.exp("lam"))).otherwise(0.0)
    rates = targets.select("source", "source_size", "target", rate.alias("rate"))
    rates = rates.withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("long"))
    rates = materialize(rates.withColumn("_need", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    # Level 1: the bucket in which the extra copies end.
    sums = rows.groupBy("source", "_bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    by_source = Window.partitionBy("source").orderBy("_bucket")
    upto = sums.withColumn("done", F.sum("words").over(by_source) - F.col("words")).join(hint(rates.select(F.col("source").alias("s"), "_need")), F.col("source").eqNullSafe(F.col("s")))
    edge = upto.where("done <= _need").groupBy("source").agg(F.max_by(F.struct("_bucket", "done"), "_bucket").alias("e"))
    edge = materialize(edge.select(F.col("source").alias("s"), F.col("e._bucket").alias("_edge"), F.col("e.done").alias("_done")))
    plan = hint(rates.join(hint(edge), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "_source"))
    # Level 2: inside that bucket, the group up to which, and the rows of it with which, the words come nearest to the need.
    before = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select("source", "size", "n", "k", "_bucket").join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_edge")))
    rest = F.col("_need") - F.col("_done") - F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0))
    cut = inside.withColumn("_rest", rest).where("_rest > 0 and size > 0").groupBy("source").agg(F.max(F.struct("k", "size", "n", "_rest")).alias("c"))
    some = F.least(F.col("c.n"), F.floor(F.col("c._rest") / F.col("c.size") + 0.5).cast("long"))
    cut = materialize(cut.select(F.col("source").alias("_cut"), F.col("c.k").alias("_last"), some.alias("_some")))
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").join(hint(cut), F.col("source").eqNullSafe(F.col("_cut")), "left")
    upto = F.when(F.col("_bucket") < F.col("_edge"), F.col("n")).when(F.col("_bucket") > F.col("_edge"), 0).when(F.col("k") < F.col("_last"), F.col("n")).when(F.col("k") == F.col("_last"), F.col("_some")).otherwise(0)
    extra = F.when((F.col("_need") > 0) & (F.col("size") > 0) & (F.col("whole") < F.lit(int(most))), upto).otherwise(0).cast("long")
    return out.withColumn("extra", extra).drop("_bucket", "_source", "_need", "_edge", "_done", "_cut", "_last", "_some")


def by_weight(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """`mix` of groups of equal rows, targets by `targets_by_weight`, rates by `balance`."""
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialize(targets_by_weight(sources, weights, most))
    lam = balance(rows, {"source": targets}, most)["source"]
    both = targets.join(lam.select(F.col("source").alias("_s"), "lam"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return mix(rows, materialize(both), most)


def by_targets(rows: DataFrame, targets: dict[str, DataFrame], most: float = 3.0) -> DataFrame:
    """`mix` of groups of equal rows (size, n, k, <set>...) to the targets of several overlapping sets of groups: documents of equal
    memberships have one rate, so they are rounded together; source is their memberships as JSON."""
    lam = balance(rows, targets, most)
    cell = F.to_json(F.struct(*targets), {"ignoreNullFields": "false"})
    small = {c: t.limit(100_001).count() <= 100_000 for c, t in targets.items()}
    keyed = tilted(rows, lam, small).withColumn("source", cell)
    cells = keyed.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.first("tilt").alias("lam"))
    cells = cells.withColumn("target", F.least(F.lit(float(most)), F.exp("lam")) * F.col("source_size"))
    return mix(keyed.drop("tilt"), materialize(cells), most)


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken) of each row of documents (doc_id, source, text)."""
    k = order_key(seed, F.col("doc_id"), F.col("text"))
    groups = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), k.alias("k")).groupBy("doc_id", "source", "size", "k").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_weight(materialize(groups), weights, most)
    one = mixed.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = F.col("whole") + F.when(F.col("_i") <= F.col("extra"), 1).otherwise(0)
    return one.select("doc_id", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeat_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    columns = docs.columns
    keyed = docs.withColumn("k", order_key(seed, *[F.col(c) for c in columns]))
    # Equal rows have equal digests of all columns: one of them stands for all.
    counted = keyed.select("k", "source", n_words(F.col("text")).alias("size")).groupBy("k", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_weight(materialize(counted), weights, most)
    total = (F.col("n") * F.col("whole") + F.col("extra")).cast("long")
    taken = materialize(mixed.select("k", "n", total.alias("total")).where("total > 0"))
    once = keyed.join(taken, "k")
    single = once.where("n = 1")
    several = once.where("n > 1").dropDuplicates(["k"])
    return single.unionByName(several).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("total")))).select(*columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


#: The same rows in DuckDB: water level in closed form, rates as target / source size, the rows nearest to what is needed.
OP2_SQL = r"""
WITH g AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
  md5('7|' || coalesce('v' || md5(CAST(doc_id AS VARCHAR)), 'n') || '|' || coalesce('v' || md5(text), 'n')) AS k FROM documents),
d AS (SELECT doc_id, source, size, k, count(*) AS n FROM g GROUP BY ALL),
s AS (SELECT source, CAST(sum(size * n) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT arg_min(level, (cap / weight, source IS NULL, source)) FROM l WHERE level * weight <= cap) * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(least(3.0, target / source_size) + 1e-9) ELSE 0 END AS whole FROM t),
p AS (SELECT d.*, r.source_size, r.target, r.whole, greatest(0, r.target - r.whole * r.source_size) - (sum(d.size * d.n) OVER (PARTITION BY d.source ORDER BY k) - d.size * d.n) AS rest FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
o AS (SELECT *, CASE WHEN rest > 0 AND size > 0 AND whole < 3 THEN least(n, floor(rest / size + 0.5)) ELSE 0 END AS extra FROM p),
e AS (SELECT *, unnest(generate_series(1, n)) AS i FROM o)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN i <= extra THEN 1 ELSE 0 END) * size AS BIGINT) AS taken, CAST(whole + CASE WHEN i <= extra THEN 1 ELSE 0 END AS BIGINT) AS copies FROM e
"""
