from __future__ import annotations

import dataclasses
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlane.operators import (
    ClusterModel,
    cluster_events,
    cluster_quality,
    clustering,
    fit_clusters,
    standardize,
    with_nearest,
)
from tremorlane.plans.queries import cluster_verdict
from tremorlane.schemas import CLUSTERED_COLUMNS, ENRICHED

FEATURES = ["latitude", "longitude", "magnitude"]


def events(spark, points):
    rows = [
        (f"e{i}", "p", "t", m, 1.0, lat, lon, "r", "", "MINOR", None)
        for i, (lat, lon, m) in enumerate(points)
    ]
    return spark.createDataFrame(rows, ENRICHED)


def random_points(n: int, seed: int = 1) -> list[tuple[float, float, float]]:
    rng = random.Random(seed)
    return [(rng.uniform(35, 43), rng.uniform(25, 45), rng.expovariate(1.0)) for _ in range(n)]


@pytest.mark.parametrize(
    ("points", "at_most"),
    [
        ([], 0),
        ([(40.0, 30.0, 1.0)], 1),
        ([(40.0, 30.0, 1.0), (36.0, 44.0, 5.0)], 2),
        ([(40.0, 30.0, 1.0)] * 3, 1),
        ([(40.0, 30.0, 1.0)] * 4 + [(36.0, 44.0, 5.0)] * 4, 2),
    ],
)
def test_small_tables(spark, points, at_most):
    result = cluster_events(events(spark, points))
    assert result.columns == list(CLUSTERED_COLUMNS)
    assert dict(result.dtypes)["cluster"] == "int"
    rows = result.collect()
    assert sorted(row.earthquake_id for row in rows) == sorted(f"e{i}" for i in range(len(points)))
    clusters = {row.cluster for row in rows}
    assert len(clusters) == at_most
    assert clusters <= set(range(5))
    by_point = {(row.latitude, row.longitude, row.magnitude): row.cluster for row in rows}
    assert all(
        by_point[row.latitude, row.longitude, row.magnitude] == row.cluster for row in rows
    )


def test_all_rows_get_the_nearest_centre(spark):
    df = events(spark, random_points(2000))
    model = fit_clusters(df)
    rows = model.label(df).select(*FEATURES, "cluster").toPandas()
    assert len(rows) == 2000
    scaled = rows[FEATURES].to_numpy() / rows[FEATURES].std(ddof=1).to_numpy()
    assert np.allclose(list(model.factors.values()), 1 / rows[FEATURES].std(ddof=1).to_numpy())
    distances = ((scaled[:, None, :] - np.array(model.centers)[None]) ** 2).sum(axis=2)
    chosen = distances[np.arange(len(rows)), rows["cluster"]]
    assert (chosen <= distances.min(axis=1) + 1e-9).all()
    assert sorted(rows["cluster"].unique()) == [0, 1, 2, 3, 4]
    assert model.centers == sorted(model.centers)


def test_labels_do_not_depend_on_the_layout_of_the_input(spark, monkeypatch):
    monkeypatch.setattr(clustering, "ROWS_PER_PART", 500)
    df = events(spark, random_points(3000, seed=5))
    layouts = [
        df.repartition(8),
        df.coalesce(1),
        df.repartitionByRange(3, "longitude"),
        df.orderBy(F.col("magnitude").desc()),
    ]
    labels = [
        {row.earthquake_id: row.cluster for row in cluster_events(layout).collect()}
        for layout in layouts
    ]
    assert all(other == labels[0] for other in labels[1:])


BLOBS = [(36.0, 26.0, 1.0), (36.0, 44.0, 1.0), (42.5, 26.0, 1.0), (42.5, 44.0, 1.0), (39.0, 35.0, 9.0)]


@pytest.mark.parametrize("merge_copies", [False, True])
def test_a_third_of_the_rows_on_one_point(spark, monkeypatch, merge_copies):
    monkeypatch.setattr(clustering, "COPIES_PER_PART", 7)
    rng = random.Random(4)
    points = [tuple(x + rng.gauss(0, 0.05) for x in rng.choice(BLOBS)) for _ in range(600)]
    points += [BLOBS[2]] * 300
    df = events(spark, points)
    model = fit_clusters(df, merge_copies=merge_copies)
    rows = model.label(df).select(*FEATURES, "cluster").toPandas()
    # every blob is one cluster, and its centre the mean of all its rows
    scaled = rows[FEATURES] / rows[FEATURES].std(ddof=1)
    means = scaled.groupby(rows["cluster"]).mean().to_numpy()
    assert np.allclose(means, model.centers)
    blob = rows[FEATURES].apply(
        lambda row: min(range(5), key=lambda i: sum((row.to_numpy() - BLOBS[i]) ** 2)), axis=1
    )
    assert rows.groupby("cluster")[FEATURES[0]].count().sum() == 900
    assert (blob.groupby(rows["cluster"]).nunique() == 1).all()


def test_copies_are_spread_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(clustering, "COPIES_PER_PART", 10)
    points = [(40.0, 30.0, 1.0)] * 995 + random_points(40)
    laid_out = clustering._laid_out(events(spark, points), FEATURES, 8)
    rows = laid_out.withColumn("task", F.spark_partition_id()).collect()
    assert sum(row._copies for row in rows) == 1035
    assert max(row._copies for row in rows) == 10
    hot = [row.task for row in rows if row.latitude == 40.0]
    assert len(hot) == 100
    assert max(hot.count(task) for task in set(hot)) < 30


def test_standardize(spark):
    points = random_points(500, seed=3)
    rows = standardize(events(spark, points).select(*FEATURES)).toPandas()
    values = rows[FEATURES].to_numpy()
    expected = values / values.std(axis=0, ddof=1)
    assert np.allclose(rows[[f"{name}_std" for name in FEATURES]].to_numpy(), expected)


@pytest.mark.parametrize("merge_copies", [False, True])
def test_labels_do_not_depend_on_the_session(spark, monkeypatch, merge_copies):
    monkeypatch.setattr(clustering, "ROWS_PER_PART", 700)
    df = events(spark, random_points(3000, seed=6)).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    labels = []
    try:
        for parts in ("4", "8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            model = fit_clusters(df, merge_copies=merge_copies)
            labels.append({row.earthquake_id: row.cluster for row in model.label(df).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert labels[0] == labels[1] == labels[2]


def test_quality_refuses_poor_fits(spark):
    df = events(spark, random_points(4000, seed=8)).cache()
    good = fit_clusters(df)

    def verdict(model):
        return cluster_verdict(cluster_quality(df, model)).first().asDict()

    passed = {
        "n_rows": 4000,
        "n_clusters": 5,
        "n_misplaced": 0,
        "centres_are_means": True,
        "loss_is_low": True,
    }
    assert verdict(good) == passed
    assert not verdict(fit_clusters(df.limit(7)))["centres_are_means"]
    moved = [list(center) for center in good.centers]
    moved[2][0] += 0.5
    shifted = verdict(dataclasses.replace(good, centers=moved))
    assert shifted["n_misplaced"] > 0 and not shifted["centres_are_means"]
    assert not verdict(fit_clusters(df, k=2))["loss_is_low"]


def test_nearest_is_told_row_by_row(spark):
    df = events(spark, random_points(500, seed=2))
    model = fit_clusters(df)
    labelled = with_nearest(model.label(df), model)
    assert labelled.where("not nearest or distance < 0").isEmpty()
    wrong = model.label(df).withColumn("cluster", (F.col("cluster") + 1) % 5)
    assert with_nearest(wrong, model).where("nearest").isEmpty()


@pytest.mark.parametrize("points", [random_points(300), [(40.0, 30.0, 1.0)] * 3, []])
def test_a_saved_model_labels_as_the_fitted_one(spark, tmp_path, points):
    path = str(tmp_path / "model")
    fit_clusters(events(spark, random_points(40, seed=9)), 3).save(spark, path)  # is replaced
    fitted = fit_clusters(events(spark, points))
    fitted.save(spark, path)
    loaded = ClusterModel.load(spark, path)
    assert (loaded.centers, loaded.factors, loaded.ranks) == (
        fitted.centers,
        fitted.factors,
        fitted.ranks,
    )
    rows = events(spark, points)
    assert sorted(loaded.label(rows).collect()) == sorted(fitted.label(rows).collect())


def test_a_model_half_written_is_not_loaded(spark, tmp_path):
    fit_clusters(events(spark, random_points(40))).kmeans.save(str(tmp_path / "model" / "kmeans"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ClusterModel.load(spark, str(tmp_path / "model"))
