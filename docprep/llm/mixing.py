"""Mixing sources to target weights, by capped water-filling and seeded sampling.

The sizes of the sources are summed where they lie; only these few sums reach the driver. A source that can't fill
its share even when repeated to its cap is clamped there, and what it leaves is shared out among the others in
proportion until everything fits. A source then gives whole repetitions of all its documents and, for the rest, the
documents that come first in a seeded order. The place where that order ends is found by a histogram, then exactly
within one bucket, so that no source is ever sorted as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docprep.session import cut

#: Most sources with a target; their table goes to every task.
MOST_SOURCES = 10_000
_BUCKETS = 4096


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    cap: int


def canonical_source(source: Column) -> Column:
    """One spelling of a source: lower case, its words joined by underscores."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-_]+", "_")


def water_fill(sizes: dict[str, int], targets: list[Target], total: float) -> dict[str, float]:
    """Tokens from each source: shares of the total, none above cap * size, the excess redistributed in proportion."""
    most = {t.source: float(t.cap) * sizes.get(t.source, 0) for t in targets}
    share = {t.source: t.share for t in targets}
    free = {s for s in share if share[s] > 0 and most[s] > 0}
    out = dict.fromkeys(share, 0.0)
    left = float(total)
    while free:
        weight = sum(share[s] for s in free)
        over = {s for s in free if left * share[s] / weight > most[s]}
        if not over:
            out |= {s: left * share[s] / weight for s in free}
            break
        for s in over:
            out[s] = most[s]
        left -= sum(most[s] for s in over)
        free -= over
    return out


def read_targets(targets: DataFrame, source: str, share: str, cap: str) -> list[Target]:
    """The targets by canonical source; shares of spellings of one source add up, its largest cap holds."""
    spelled = targets.select(canonical_source(F.col(source)).alias("s"), F.col(share).cast("double").alias("w"), F.col(cap).cast("int").alias("k")).where("s is not null")
    rows = spelled.groupBy("s").agg(F.sum(F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0))).alias("w"), F.max(F.greatest(F.coalesce("k", F.lit(1)), F.lit(0))).alias("k")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources have a target")
    return sorted((Target(r.s, r.w, r.k) for r in rows), key=lambda t: t.source)


def mix(documents: DataFrame, id: str, source: str, size: str, targets: DataFrame, target_source: str = "source", share: str = "target_share", cap: str = "max_repeats", total: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(plan, shares). plan: (id, source, n_tokens, repeats), a row for every document; shares: what each source reaches.

    Without a total the mix is as large as the documents of the sources with a target are together. repeats is 0 for
    documents not taken and for those whose source is null or has no target; it never exceeds the cap. A source's
    tokens come within one document of what water-filling gives it. A null size counts as 0. Ties in the seeded
    order are broken by id; repeated rows are documents of their own. Other columns are not read. Empty tables give an
    empty plan, and shares of 0.
    """
    spark = documents.sparkSession
    known = read_targets(targets, target_source, share, cap)
    names = spark.createDataFrame([(t.source, t.share, t.cap) for t in known], "source string, target_share double, max_repeats int")
    docs = documents.select(F.col(id).alias("id"), canonical_source(F.col(source)).alias("source"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n_tokens"))
    docs = cut(docs.withColumn("draw", F.xxhash64(F.lit(seed), F.col("id"))).withColumn("bucket", F.pmod("draw", F.lit(_BUCKETS)).cast("int")))
    targeted = docs.join(F.broadcast(names.select("source")), "source")  # at most MOST_SOURCES rows
    histogram = cut(targeted.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n")))
    sizes = {r.source: r.n for r in histogram.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    planned = water_fill(sizes, known, sum(sizes.values()) if total is None else total)
    rows = []
    for t in known:
        have = sizes.get(t.source, 0)
        whole = min(t.cap, int(planned[t.source] / have + 1e-9)) if have else 0
        rows.append((t.source, t.share, t.cap, have, planned[t.source], whole, max(0, round(planned[t.source] - whole * have)) if whole < t.cap else 0))
    plan = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available bigint, planned double, whole int, rest bigint")
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = histogram.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(F.broadcast(plan.select("source", "rest")), "source")
    edge = sums.where("before < rest and before + n >= rest").groupBy("source").agg(F.min_by(F.struct("bucket", "before"), "bucket").alias("e"))
    rule = cut(plan.join(edge, "source", "left").select("source", "whole", "rest", F.coalesce("e.bucket", F.lit(-1)).alias("edge"), F.coalesce("e.before", F.lit(0)).alias("before")))
    ruled = docs.join(F.broadcast(rule), "source", "left")
    at_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    in_order = Window.partitionBy("source").orderBy("draw", "id").rowsBetween(Window.unboundedPreceding, -1)
    within = ruled.where(at_edge).withColumn("sum", F.col("before") + F.coalesce(F.sum("n_tokens").over(in_order), F.lit(0)))
    within = within.withColumn("extra", (F.col("sum") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int"))
    others = ruled.where(~at_edge).withColumn("extra", F.coalesce((F.col("bucket") < F.col("edge")).cast("int"), F.lit(0)))
    every = within.select(others.columns).unionByName(others)
    result = every.select(F.col("id").alias(id), "source", "n_tokens", (F.coalesce("whole", F.lit(0)) + F.col("extra")).alias("repeats"))
    given = result.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"))
    shares = plan.join(given, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    everything = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # over the targets, of which there are few
    shares = shares.select("source", "target_share", "max_repeats", "available", F.round("planned").cast("bigint").alias("planned_tokens"), "tokens", F.coalesce(F.try_divide("tokens", everything), F.lit(0.0)).alias("actual_share"))
    return result, shares
