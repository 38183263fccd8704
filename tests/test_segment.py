from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from saldora.operators import segment as sg
from saldora.operators.clusters import fit_all, unmoved

RNG = np.random.default_rng(9)


@pytest.fixture(scope="module")
def blobs(spark):
    centres = np.array([[0, 0], [6, 1], [2, 8]])
    sizes = [150, 90, 60]
    xy = np.concatenate([RNG.normal(c, 1.0, (n, 2)) for c, n in zip(centres, sizes)])
    pdf = pd.DataFrame(xy, columns=["a", "b"])
    pdf["k"] = range(len(pdf))
    pdf["label"] = np.repeat([0, 1, 2], sizes)
    return pdf, spark.createDataFrame(pdf)


def test_silhouette_against_pairs(blobs):
    pdf, df = blobs
    x, lab = pdf[["a", "b"]].to_numpy(), pdf.label.to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(len(x)):
        means = {c: d[i, lab == c].sum() / ((lab == c).sum() - (c == lab[i])) for c in set(lab)}
        a, b = means[lab[i]], min(v for c, v in means.items() if c != lab[i])
        s.append((b - a) / max(a, b))
    got = sg.silhouette(df, ["a", "b"], "label", "k").first()[0]
    assert got == pytest.approx(np.mean(s), abs=1e-9)


def test_davies_bouldin_against_definition(blobs):
    pdf, df = blobs
    x, lab = pdf[["a", "b"]].to_numpy(), pdf.label.to_numpy()
    c = np.array([x[lab == i].mean(0) for i in range(3)])
    s = [np.linalg.norm(x[lab == i] - c[i], axis=1).mean() for i in range(3)]
    worst = [
        max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(3) if j != i) for i in range(3)
    ]
    assert sg.davies_bouldin(df, ["a", "b"], "label").first()[0] == pytest.approx(np.mean(worst))


def test_kmeans_best_of_restarts(blobs):
    pdf, df = blobs
    vectors = sg.as_vector(df, ["a", "b"]).persist()
    best = sg.kmeans(vectors, 3, restarts=3)
    assert best.cost == min(best.costs) and len(best.costs) == 3
    out = best.label(vectors).toPandas()
    assert len(out) == len(pdf) and out.k.is_unique
    assert list(out.segment.value_counts().sort_index()) == sorted(out.segment.value_counts(), reverse=True)
    agreement = pd.crosstab(out.segment, out.label).max(axis=1).sum()
    assert agreement > 0.97 * len(pdf)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 2.0, 3.0], "b": [5.0] * 3}))
    scaled, stats = sg.standardise(df, ["a", "b"])
    assert stats["b"] == (5.0, 1.0)
    assert scaled.toPandas().b.tolist() == [0.0] * 3


def test_missing_inputs_are_refused(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, None]}).astype(object).where(lambda d: d.notna(), None), "a double")
    with pytest.raises(ValueError, match="missing"):
        sg.assert_complete(df, ["a"])


def test_all_runs_share_their_passes(blobs):
    """Each run of a joint fit ends where it does by itself, and where plain numpy ends."""
    pdf, df = blobs
    point = F.array("a", "b")
    df = df.persist()
    joint = fit_all(df, point, [2, 3], 3, 5, key="k")
    x = pdf[["a", "b"]].to_numpy()
    for k, runs in joint.items():
        alone = fit_all(df, point, [k], 3, 5, key="k")[k]
        for run, single in zip(runs, alone):
            assert run.cost == pytest.approx(single.cost, rel=1e-9) and run.steps == single.steps
            own = ((x[:, None] - run.centres[None]) ** 2).sum(2)
            assert run.cost == pytest.approx(own.min(axis=1).sum(), rel=1e-9)
            label = own.argmin(axis=1)
            assert run.sizes.tolist() == np.bincount(label, minlength=k).tolist()
            assert run.centres == pytest.approx(np.array([x[label == c].mean(axis=0) for c in range(k)]), abs=1e-6)
        moved = unmoved(df, point, runs[0].centres).collect()
        assert sum(r["rows"] for r in moved) == len(pdf) and max(r["moved"] for r in moved) < 1e-6
    df.unpersist()


def test_more_clusters_than_points(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": [1, 2, 3], "a": [1.0, 1.0, 5.0]}))
    run = fit_all(df, F.array("a"), [4], 1, 0, key="k")[4][0]
    assert run.cost == 0.0 and sum(run.sizes) == 3
