"""Machines over the polynomial expansion, fitted side by side, against the library's."""

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortline.operators import polynomial as PL
from cohortline.operators import training as T


def test_expansion_holds_every_monomial():
    x = np.random.default_rng(0).normal(size=(7, 4))
    for degree in (1, 2, 3):
        want = [x[:, list(c)].prod(axis=1) for d in range(1, degree + 1) for c in itertools.combinations_with_replacement(range(4), d)]
        assert np.allclose(PL.expanded(x, degree), want) and len(want) == PL.n_monomials(4, degree)


def test_machines_are_the_librarys(spark, monkeypatch):
    """The first step is the library's to the last digits; many steps end at the same loss. No machine is fitted alone."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 5)) * 0.8 + 0.3
    label = (x[:, 0] * x[:, 1] + x[:, 2] ** 2 > 0.6).astype(int) + (x[:, 3] > 1)
    df = T.cut_lineage(T.from_arrays(spark.createDataFrame(pd.DataFrame({"v": x.tolist(), "label": label})).repartition(3), "v", "label"))
    scaled = df.withColumn("scaled", array_to_vector(F.transform(vector_to_array("features"), lambda v: v * math.sqrt(0.1))))
    library = PolynomialExpansion(degree=3, inputCol="scaled", outputCol="poly").transform(scaled)
    classes, margins = [0, 1, 2], lambda scored: np.array([r["margins"] for r in scored.select("margins").collect()])
    both = {}
    for n in (1, 50):
        fitted = T._class_machines(library, "poly", classes, 500, 1.0, n)
        grown = PL.fit_machines(df, classes, math.sqrt(0.1), 3, 1 / 500, n)
        own = df.withColumn("margins", PL.margins(F.col("features"), grown, math.sqrt(0.1), 3, spark))
        both[n] = margins(T._with_margins(library, "poly", fitted)), margins(own)
    assert np.allclose(*both[1], atol=1e-9)
    assert np.mean((both[50][0] > 0) == (both[50][1] > 0)) > 0.97 and np.corrcoef(both[50][0].ravel(), both[50][1].ravel())[0, 1] > 0.99
    monkeypatch.setattr(T.LinearSVC, "_fit", lambda *a: (_ for _ in ()).throw(AssertionError("fitted alone")))
    assert T.fit_poly_svc(df, classes, max_iter=2)(df).columns == ["features", "label", "margins"]
