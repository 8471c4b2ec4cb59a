"""Density clustering of vectors, distances to centroids, and grades for what belongs to no cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.vectors import cosine, distance, doubles
from millrace.operators.graph import connected_components
from millrace.operators.similarity import similar_pairs
from millrace.runtime import cut


def dbscan(df: DataFrame, key: str, vector: str, eps: float, min_samples: int) -> DataFrame:
    """``(key, cluster)`` by cosine distance within ``eps``; -1 is noise, clusters are numbered by their least key from 0.

    A row with at least ``min_samples`` rows within eps, itself included, is a core row; core rows in reach of one
    another form a cluster, and a border row joins the reachable core row's cluster with the least label.
    """
    pairs = cut(similar_pairs(df, key, vector, 1 - eps).select("id_1", "id_2"), "pairs")
    ids = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id")).distinct()
    both = pairs.union(pairs.select("id_2", "id_1")).toDF("id", "near")
    core = ids.join(both.groupBy("id").agg(F.count("*").alias("n")), "id", "left").where(F.coalesce("n", F.lit(0)) + 1 >= min_samples).select("id")
    core = cut(core, "core")
    c1, c2 = core.toDF("id_1"), core.toDF("id_2")
    label = core.join(connected_components(pairs.join(c1, "id_1").join(c2, "id_2"), "id_1", "id_2"), "id", "left").select("id", F.coalesce("component", "id").alias("label"))
    label = cut(label, "labels")
    border = both.join(label.toDF("near", "label"), "near").join(core, "id", "left_anti").groupBy("id").agg(F.min("label").alias("label"))
    found = ids.join(label.unionByName(border), "id", "left")
    from millrace.operators.ranking import global_rank

    order = global_rank(label.select("label").distinct(), [F.col("label")], "cluster").withColumn("cluster", (F.col("cluster") - 1).cast("int"))
    return found.join(order, "label", "left").select(F.col("id").alias(key), F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``(label, centroid)``: the mean vector of each label, summed on the map side place by place."""
    long = df.where(F.col(label).isNotNull()).select(label, F.posexplode(doubles(F.col(vector))).alias("pos", "x"))
    mean = long.groupBy(label, "pos").agg(F.avg("x").alias("x"))
    return mean.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("centroid"))


def to_centroid(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``df`` with ``distance`` to the centroid of its own label; -1 for noise (label -1)."""
    c = centroids(df.where(F.col(label) >= 0), label, vector)
    return df.join(c, label, "left").withColumn("distance", F.coalesce(distance(doubles(F.col(vector)), F.col("centroid")), F.lit(-1.0))).drop("centroid")


def summary(df: DataFrame, label: str) -> DataFrame:
    """``(label, size, share, mean_distance, max_distance)``; noise and single rows have no distances."""
    total = df.count()
    one = (F.col(label) < 0) | (F.count("*") < 2)
    return df.groupBy(label).agg(
        F.count("*").alias("size"), (F.count("*") / F.lit(max(1, total))).alias("share"),
        F.when(~one, F.avg("distance")).alias("mean_distance"), F.when(~one, F.max("distance")).alias("max_distance"),
    )


def kth_distance(neighbours: DataFrame, k: int, share: float = 0.75) -> DataFrame:
    """``(eps)``: the given quantile of the distance to the k-th neighbour, itself counted as the first."""
    return neighbours.where(F.col("place") == k).agg(F.percentile("distance", F.lit(share)).alias("eps"))


def grade(d: Column, is_music: Column, has_speech: Column, has_noise: Column) -> tuple[Column, Column, Column]:
    """(class, action, review) of a row outside all clusters by its distance to the nearest centroid.

    Only a far one that is told not to be music, or to have speech or noise, is rejected; unknown counts as music.
    """
    no = lambda c: F.coalesce(c, F.lit(False))
    bad = ~F.coalesce(is_music, F.lit(True)) | no(has_speech) | no(has_noise)
    kind = F.when(d < 0.6, "substyle_variant").when(d < 0.8, "substyle_outlier").when(bad, "non_music_outlier").otherwise("extreme_style_variant")
    return kind, F.when((d >= 0.8) & bad, "reject").otherwise("keep"), d >= 0.6


def label_verdict(similarity: Column, found: Column, failed: Column, least: float = 0.3) -> tuple[Column, Column]:
    """(verdict, similarity to four places) of a label's vector and a recording's: not_found, error, mismatch or match."""
    ok = F.coalesce(found, F.lit(False))
    bad = F.coalesce(failed, F.lit(False)) | similarity.isNull() | F.isnan(similarity)
    verdict = F.when(~ok, "not_found").when(bad, "error").when(similarity < least, "mismatch").otherwise("match")
    return verdict, F.when(ok & ~bad, F.round(similarity, 4))


def label_check(df: DataFrame, key: str, own: str, labels: DataFrame, label: str, vector: str, least: float = 0.3) -> DataFrame:
    """``(key, verdict, similarity)``: the cosine of each row's vector to that of its label; rows without either aren't found."""
    ref = labels.select(F.col(label).alias("_l"), doubles(F.col(vector)).alias("_v")).dropDuplicates(["_l"])
    j = df.select(key, F.col(own).alias("_own"), doubles(F.col(vector)).alias("_x")).join(ref, F.col("_own") == F.col("_l"), "left")
    verdict, sim = label_verdict(cosine(F.col("_x"), F.col("_v")), F.col("_x").isNotNull() & F.col("_v").isNotNull(), F.lit(False), least)
    return j.select(key, verdict.alias("verdict"), sim.alias("similarity"))


def projection(df: DataFrame, key: str, vector: str, k: int = 2) -> DataFrame:
    """``(key, point)``: principal components of the centred vectors, by their covariance (of bounded size: dimensions squared).

    A component's sign is that of its greatest loading. Null vectors are left out.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.where(F.col(vector).isNotNull()).select(key, doubles(F.col(vector)).alias("_v"))
    d = rows.select(F.size("_v").alias("d")).first()
    if d is None:
        return rows.select(key, F.col("_v").alias("point"))
    mean = rows.agg(F.array(*[F.avg(F.get("_v", i)) for i in range(d["d"])]).alias("m")).first()["m"]
    centred = rows.select(key, array_to_vector(F.zip_with("_v", F.array(*[F.lit(x) for x in mean]), lambda a, b: a - b)).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(centred)
    load = model.pc.toArray()
    sign = [1.0 if load[abs(load[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    return model.transform(centred).select(key, F.zip_with(vector_to_array("_p"), F.array(*[F.lit(x) for x in sign]), lambda a, b: a * b).alias("point"))


def k_means(df: DataFrame, key: str, vector: str, k: int, seed: int = 42) -> DataFrame:
    """``(key, cluster)`` of ``k`` clusters around means; null vectors are left out."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(doubles(F.col(vector))).alias("features"))
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(rows).transform(rows).select(key, "cluster")
