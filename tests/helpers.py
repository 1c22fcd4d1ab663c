"""Small synthetic matrices, the kind a unit test needs."""

import numpy as np


def poisson_counts(spark, n_genes, n_cells, lam, seed=1, sample="s1"):
    rng = np.random.default_rng(seed)
    m = rng.poisson(lam, (n_genes, n_cells))
    rows = [
        (sample, f"Cell{c + 1}", f"Gene{g + 1}", "RNA", float(m[g, c])) for g, c in zip(*np.nonzero(m))
    ]
    counts = spark.createDataFrame(rows, "sample_id string, cell_id string, feature string, assay string, value double")
    cells = spark.createDataFrame(
        [(sample, f"Cell{c + 1}", f"type{c % 2}") for c in range(n_cells)], "sample_id string, cell_id string, cell_type string"
    )
    features = spark.createDataFrame(
        [(f"Gene{g + 1}", g % 20 == 0, g % 20 == 1) for g in range(n_genes)], "feature string, is_mito boolean, is_ribo boolean"
    )
    return m, counts, cells, features
