"""Links inside groups of near vectors that are larger than the window."""

import numpy as np
import pytest

from larder.llm import projections

from .test_pairs import by_row, check_vectors


@pytest.mark.parametrize("block", [2048, 100])
def test_links_of_a_large_group_are_all_counted(spark, block):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    rows = [(k, (centre + rng.choice([0.05, 0.2, 0.26]) * rng.standard_normal(32)).tolist(), 1) for k in range(700)]
    rows += [(700 + k, rows[3 * k][1], 1) for k in range(40)]  # equal vectors
    rows += [(800 + k, rng.standard_normal(32).tolist(), k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    spec = projections.PassSpec(window=32, block=block)
    check_vectors(by_row(projections.near_vectors(df, spec), "vec_id", "n_links", "component_id", "kept"), rows)
