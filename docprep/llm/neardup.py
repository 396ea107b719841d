"""Near-duplicate records by ProbMinHash, banding and exact verification.

Texts with the same set of shingles form a class and one of them stands for it, so copies cost nothing beyond
one row. A class's sketch falls into buckets by bands; classes meet in a self-join on the bucket, which AQE splits
where one is hot, and those that meet twice are verified on their full shingle sets. Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.llm.components import components
from docprep.llm.sketch import band_keys, banding, character_shingles, prob_minhash, shingles, weighted_jaccard, weights
from docprep.session import cut, never_sent

_SKETCH = "id bigint, class_key binary, n int, bands array<bigint>"
_SETS = "id bigint, n int, shingles array<bigint>, weight array<double>"
_BATCH = 500
#: What a shingle is a run of.
SHINGLERS = {"word": shingles, "character": character_shingles}


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values))


def sketch(records: DataFrame, id: str, text: Column, words: int, threshold: float, least: int, weighting: str, unit: str = "word") -> DataFrame:
    """(id, class_key, n, bands) of the records with at least so many distinct shingles."""
    bands, rows = banding(threshold)
    shingled = SHINGLERS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                owner, h, count, first = shingled(part.column(1).to_pylist(), words)
                n = np.bincount(owner, minlength=part.num_rows)
                take = np.flatnonzero(n >= max(1, least))
                inside = np.isin(owner, take)
                owner, h, weight = np.searchsorted(take, owner[inside]), h[inside], weights(weighting, count[inside], first[inside])
                keys = band_keys(prob_minhash(owner, h, weight, len(take), bands * rows), bands, rows)
                ends = np.cumsum(n[take])
                told = h if weighting == "distinct" else np.stack((h, weight.view(np.uint64)), axis=1)
                classes = [hashlib.blake2b(told[e - k : e].tobytes(), digest_size=16).digest() for e, k in zip(ends, n[take])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(take)), pa.array(classes, pa.binary()), pa.array(n[take], pa.int32()), _lists(keys.ravel(), np.full(len(take), bands))],
                    names=["id", "class_key", "n", "bands"],
                )

    return records.select(F.col(id).cast("bigint").alias("id"), text.cast("string").alias("text")).where("id is not null").mapInArrow(run, _SKETCH)


def shingle_sets(records: DataFrame, id: str, text: Column, words: int, weighting: str = "distinct", unit: str = "word") -> DataFrame:
    """(id, n, shingles, weight): the distinct shingles of each record, as hashes in order; weight is null where all weigh the same."""
    shingled = SHINGLERS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, h, count, first = shingled(batch.column(1).to_pylist(), words)
            n = np.bincount(owner, minlength=batch.num_rows)
            weight = pa.nulls(batch.num_rows, pa.list_(pa.float64())) if weighting == "distinct" else _lists(weights(weighting, count, first), n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), _lists(h.view(np.int64), n), weight], names=["id", "n", "shingles", "weight"])

    return records.select(F.col(id).cast("bigint").alias("id"), text.cast("string").alias("text")).mapInArrow(run, _SETS)


def verified(pairs: DataFrame, sets_a: DataFrame, sets_b: DataFrame, threshold: float, weighting: str) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) whose sets are similar enough; a is looked up in the one table of sets, b in the other."""
    with_a = pairs.join(never_sent(sets_a.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"), F.col("weight").alias("wa"))), "a")
    both = with_a.join(never_sent(sets_b.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"), F.col("weight").alias("wb"))), "b")
    if weighting == "distinct":
        shared = F.size(F.array_intersect("sa", "sb"))
        counted = both.where(F.least("na", "nb") >= threshold * F.greatest("na", "nb")).select("a", "b", shared.alias("common"), (F.col("na") + F.col("nb") - shared).alias("either"))
        return counted.where(F.col("common") >= threshold * F.col("either")).select("a", "b", (F.col("common") / F.col("either")).alias("similarity"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.asarray(x.values) for x in batch.column(k)] for k in range(2, 6)]
            found = pa.array([weighted_jaccard(*p) for p in zip(*sides)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["a", "b", "similarity"])

    return both.select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(run, "a bigint, b bigint, similarity double").where(F.col("similarity") >= threshold)


def meeting(one: DataFrame, two: DataFrame, where: str = "true") -> DataFrame:
    """(a, b) that meet in two buckets at least; the one has (a, key), the other (b, key)."""
    return one.join(never_sent(two), "key").where(where).groupBy("a", "b").agg(F.count("*").alias("k")).where("k >= 2").select("a", "b")


def near_duplicates(
    records: DataFrame, id: str, text: Column, words: int = 5, threshold: float = 0.8, least: int = 1, weighting: str = "distinct", unit: str = "word"
) -> tuple[DataFrame, DataFrame]:
    """(links, members). links: (a, b, similarity) between representatives of classes, a < b; members: (id, class_id, n).

    A class holds the records with the same set of shingles; class_id is its least id. Similarity is Jaccard's over
    distinct shingles, which are runs of `words` words, or of as many characters of any script with unit 'character'.
    Pairs that meet in two bands are verified, none is capped; a pair at the threshold fails to meet twice with
    probability 1e-4, far less above it. With weighting 'count' a shingle weighs by its occurrences, with 'opening' the
    less the later it comes; similarity is then that of the shares of weight, and a class's weights are equal too. ids
    must be unique; rows with a null id are left out, as nothing could name them. A null text counts as ''; texts with
    fewer shingles than `least` (at least one) take no part. Columns other than those named are not read. An empty
    table gives empty results.
    """
    sketches = cut(sketch(records, id, text, words, threshold, least, weighting, unit))
    classes = sketches.groupBy("class_key").agg(F.min("id").alias("class_id"))
    members = sketches.join(classes, "class_key").select("id", "class_id", "n")
    lead = sketches.groupBy("class_key").agg(F.min_by(F.struct("id", "bands"), "id").alias("r")).select("r.id", F.explode("r.bands").alias("key"))
    pairs = cut(meeting(lead.toDF("a", "key"), lead.toDF("b", "key"), "a < b"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = records.select(F.col(id).cast("bigint").alias("id"), text.cast("string").alias("text")).join(wanted, "id", "left_semi")
    sets = shingle_sets(texts, "id", F.col("text"), words, weighting, unit)
    return cut(verified(pairs, sets, sets, threshold, weighting)), members


def member_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): every pair of records behind the links, and every pair within a class; a < b."""
    m = members.select("id", "class_id")
    one = m.select(F.col("id").alias("x"), F.col("class_id").alias("a"))
    two = m.select(F.col("id").alias("y"), F.col("class_id").alias("b"))
    across = links.select("a", "b").join(one, "a").join(two, "b").select("x", "y")
    within = one.join(two.withColumnRenamed("b", "a"), "a").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def near_duplicate_groups(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id, class_id, group_id, n_links): a row for each record that took part.

    group_id is the least id of the records connected by links; n_links counts the links of the record's class to
    classes with another text.
    """
    found = components(links, "a", "b")
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    per_class = found.join(degree, found.node == degree.class_id).select("class_id", "component", "n_links")
    joined = members.join(per_class, "class_id", "left")
    return joined.select("id", "class_id", F.coalesce("component", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
