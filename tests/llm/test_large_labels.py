"""Sorted projection passes over labels that are large for their window: recall, partition edges, number of passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import projections
from larder.llm.projections import PassSpec, passes_needed


def planted(pairs: int, lone: int, size: int, cosine: float, seed: int):
    """``pairs`` pairs of unit vectors at the given cosine, ids 2k and 2k + 1, and lone vectors after them."""
    rng = np.random.default_rng(seed)
    ones = rng.standard_normal((pairs + lone, size))
    ones /= np.linalg.norm(ones, axis=1, keepdims=True)
    aside = rng.standard_normal((pairs, size))
    aside -= (aside * ones[:pairs]).sum(1, keepdims=True) * ones[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    others = cosine * ones[:pairs] + np.sqrt(1 - cosine**2) * aside
    rows = [(2 * k, ones[k].tolist(), 1) for k in range(pairs)] + [(2 * k + 1, others[k].tolist(), 1) for k in range(pairs)]
    return rows + [(2 * pairs + k, ones[pairs + k].tolist(), 1) for k in range(lone)]


def test_passes_grow_with_the_label(spark):
    counts = [0, 1, 128, 3_000, 100_000, 1_000_000, 1_000_000_000]
    df = spark.createDataFrame([(n,) for n in counts], "n long")
    got = [r["p"] for r in df.select(passes_needed(F.col("n"), PassSpec()).alias("p")).collect()]
    assert got[:4] == [12] * 4 and got == sorted(got)
    assert got[4] > 12 and 20 <= got[5] <= 24 and 70 <= got[6] <= 100


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_recall_of_links_near_the_threshold_in_a_large_label(spark, partitions):
    """A window of 4 for 6,000 vectors is as hard as the usual one for 190,000."""
    rows = planted(300, 5400, 32, 0.935, 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["vec_id"]: r for r in projections.near_vectors(df, PassSpec(window=4, passes=4)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    found = sum(got[2 * k + 1]["component_id"] == 2 * k for k in range(300))
    assert found >= 0.95 * 300
    for r in got.values():
        if r["vec_id"] >= 600:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)


def test_neighbours_on_two_sides_of_an_edge_are_compared(spark):
    """The links of one pass do not depend on the number of partitions."""
    rows = planted(200, 1600, 16, 0.97, 3)
    df = spark.createDataFrame(rows, "rep long, vector array<double>, label long").withColumn("dims", F.lit(16)).withColumn("size", F.lit(1))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = []
    try:
        for partitions in ("1", "3", "20"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            links = projections.pass_links(df, range(1), PassSpec(window=8))
            found.append({(r["a"], r["b"]) for r in links.collect()})
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found[0] and found[0] == found[1] == found[2]
