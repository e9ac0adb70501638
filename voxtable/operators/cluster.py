"""Similarities between tracks, clusters and their names."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import pyround
from voxtable.operators.filters import singletons
from voxtable.operators.sequence import by_first_seen


def pairwise(df: DataFrame, keys: list[str], item: str, vector: str, both_ways: bool = False, places: int | None = None, block: int = 1024) -> DataFrame:
    """keys, a, b, similarity (dot product) of all pairs of a group's items, a < b, or all but a = b.

    With `places` also distance, as scalars.distance, and both rounded.

    All pairs are what is asked for here: groups are the tracks of one video.  A group's items are cut into blocks, and
    a task holds two blocks and their products, whatever the size of the group.  A product's terms are added in the
    vector's order, as SQL and scalars.dot do; it is null if an element is, or if the vectors' lengths differ.
    """
    by = Window.partitionBy(*keys)
    cut = df.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in [*keys, item]])).select(*keys, F.col(item).alias("i"), F.col(vector).alias("v"))
    cut = cut.withColumn("p", F.row_number().over(by.orderBy("i")) - 1).withColumn("n", F.floor((F.count("*").over(by) - 1) / block).cast("int")).withColumn("b", F.floor(F.col("p") / block).cast("int"))
    # s: 0 for the side of the rows, 1 for that of the columns; a block meets itself and all after it
    sides = cut.select(*keys, "i", "v", "p", F.explode(F.expr("concat(transform(sequence(b, n), o -> struct(0 as s, b as vx_a, o as vx_b)), transform(sequence(0, b), o -> struct(1 as s, o as vx_a, b as vx_b)))")).alias("o"))
    sides = sides.select(*keys, "i", "v", "p", "o.*")
    kinds = {f.name: f.dataType.simpleString() for f in sides.schema}
    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", a {kinds['i']}, b {kinds['i']}, similarity double" + (", distance double" if places is not None else "")
    names = [*keys, "a", "b", "similarity", *(["distance"] if places is not None else [])]

    def rounded(x: np.ndarray) -> np.ndarray:
        """Halves away from zero; no negative zero."""
        scaled = x * 10.0**places
        whole = np.trunc(scaled)
        return (whole + np.where(np.abs(scaled - whole) >= 0.5, np.sign(scaled), 0.0)) / 10.0**places + 0.0

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Vectors as columns of doubles, and each one's length, -1 where an element is missing."""
        v = t["v"].combine_chunks()
        flat, n = v.flatten(), np.asarray(pc.fill_null(pc.list_value_length(v), 0))
        at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        m = np.zeros((n.max(initial=0), len(n)))
        m[at, np.repeat(np.arange(len(n)), n)] = np.asarray(flat.cast("double").fill_null(0.0))
        whole = np.asarray(v.is_valid()) & (np.bincount(np.repeat(np.arange(len(n)), n), ~np.asarray(flat.is_valid()), len(n)) == 0)
        return m, np.where(whole, n, -1)

    def products(t: pa.Table) -> pa.Table:
        x, y = (t.filter(pc.equal(t["s"], k)).sort_by("p") for k in (0, 1))
        (p, np_), (q, nq) = matrix(x), matrix(y)
        ids, jds = x["i"].combine_chunks(), y["i"].combine_chunks()
        later = np.asarray(x["p"])[:, None] < np.asarray(y["p"])[None, :]
        if pc.count_distinct(ids).as_py() < len(ids) or ids[-1] == jds[0]:  # an item that stands twice is no pair with itself
            code = pa.concat_arrays([ids, jds]).dictionary_encode().indices.to_numpy()
            later &= code[: len(ids), None] != code[None, len(ids) :]
        part, done = max(1, 65_536 // max(1, len(jds))), []
        for lo in range(0, len(ids), part):
            s = np.zeros((min(part, len(ids) - lo), len(jds)))
            for k in range(min(len(p), len(q))):
                s += p[k, lo : lo + part, None] * q[k]
            i, j = np.nonzero(later[lo : lo + part])
            fits = (np_[lo + i] == nq[j]) & (nq[j] >= 0)
            s, missing = s[i, j], None if fits.all() else ~fits
            values = [pa.array(s if places is None else rounded(s), mask=missing)]
            if places is not None:
                values.append(pa.array(np.where(fits, rounded(np.maximum(0.0, 1 - s)), 0.0)))
            a, b, same = ids.take(pa.array(lo + i)), jds.take(pa.array(j)), [pa.repeat(t[k][0], len(i)) for k in keys]
            done += [pa.RecordBatch.from_arrays([*same, *ends, *values], names=names) for ends in ([a, b], [b, a])[: 2 if both_ways else 1]]
        return pa.Table.from_batches(done)

    return sides.groupBy(*keys, "vx_a", "vx_b").applyInArrow(products, out)


def average_linkage(similarity: np.ndarray, cut: float) -> np.ndarray:
    """Labels of clusters merged by mean distance 1 - similarity, up to distance `cut`.

    Follows chains of nearest neighbours, which average linkage allows: n^2 time and memory.
    """
    n = len(similarity)
    d = np.maximum(0.0, 1.0 - np.asarray(similarity, float))
    np.fill_diagonal(d, np.inf)
    size, label = np.ones(n), np.arange(n)
    live = np.ones(n, bool)
    chain: list[int] = []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(live)[0])]
        while True:
            a = chain[-1]
            b = int(np.argmin(d[a]))
            if len(chain) > 1 and d[a, chain[-2]] <= d[a, b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        if d[a, b] <= cut:
            label[label == label[b]] = label[a]
        merged = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        size[a] += size[b]
        live[b] = False
        d[a], d[:, a] = merged, merged
        d[b], d[:, b] = np.inf, np.inf
        d[a, a] = np.inf
    return label


def linked_by_sums(v: np.ndarray, cut: float, block: int | None = None) -> np.ndarray:
    """Labels as average_linkage's of v's products, for vectors no longer than 1, without the matrix: memory as the vectors'.

    The mean distance of two clusters is 1 less the product of their mean vectors, as no product of unit vectors is above
    1, but for rounding.  Equal vectors, which nothing is nearer to, are one point from the start.  A cluster's nearest
    is kept while neither changes (average linkage brings no cluster nearer by a merge); the first ones are found by
    products of blocks.  One whose nearest is beyond the cut stays as it is.
    """
    v = np.ascontiguousarray(v, float)
    points, of, size = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    of = of.reshape(-1)
    if cut < 1e-6:  # too near to the rounding of equal vectors' products
        points, of, size = v, np.arange(len(v)), np.ones(len(v), int)
    else:  # in the order of the items: of equal distances the first counts
        first = np.full(len(points), len(v))
        np.minimum.at(first, of, np.arange(len(v)))
        order = np.argsort(first)
        points, size, of = points[order], size[order], np.argsort(order)[of]
    n = len(points)
    label, ids = np.arange(n), np.arange(n)  # label: the cluster that one was merged into; ids: clusters in rows of mean
    mean, count, dead = points.copy(), size.astype(float), np.zeros(n)
    near, far, stamp, seen = np.full(n, -1), np.full(n, np.inf), np.zeros(n, int), np.zeros(n, int)
    block = block or max(1, 1_000_000 // n)
    for lo in range(0, n, block):
        d = np.maximum(0.0, 1.0 - mean[lo : lo + block] @ mean.T)
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        near[lo : lo + block] = d.argmin(axis=1)
        far[lo : lo + block] = d.min(axis=1)
    row, alive, live, start = np.arange(n), np.ones(n, bool), n, 0
    chain: list[int] = []

    def drop(a: int) -> None:
        nonlocal live, ids, mean, dead
        alive[a], dead[row[a]], live = False, np.inf, live - 1
        if live < len(ids) / 2:
            kept = alive[ids]
            ids, mean, dead = ids[kept], mean[kept], dead[kept]
            row[ids] = np.arange(len(ids))

    while live > 1:
        if not chain:
            while not alive[start]:
                start += 1
            chain = [start]
        a = chain[-1]
        if not (near[a] >= 0 and alive[near[a]] and stamp[near[a]] == seen[a]):
            d = np.maximum(0.0, 1.0 - mean @ mean[row[a]]) + dead
            d[row[a]] = np.inf
            k = int(d.argmin())
            near[a], far[a], seen[a] = ids[k], d[k], stamp[ids[k]]
        if far[a] > cut:  # none comes nearer
            chain.pop()
            drop(a)
        elif len(chain) == 1 or far[a] < far[chain[-2]] - 1e-13:
            chain.append(int(near[a]))
        else:
            b, chain = chain[-2], chain[:-2]
            a, b = min(a, b), max(a, b)
            total = count[a] + count[b]
            mean[row[a]] = (count[a] * mean[row[a]] + count[b] * mean[row[b]]) / total
            count[a], label[b], near[a] = total, a, -1
            stamp[a] += 1
            drop(b)
    for i in range(n):  # a cluster is merged into one that stands before it
        label[i] = label[label[i]]
    return label[of]


def cluster_tracks(df: DataFrame, keys: list[str], item: str, vector: str, cut: float = 0.5) -> DataFrame:
    """keys, item and cluster (the least item of the cluster).

    A group is one video: its vectors are held whole, and their matrix only where one is longer than 1.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys, item).schema)
    of_item = df.select(item).schema[0].dataType.simpleString()

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(item).reset_index(drop=True)
        m = np.array(pdf[vector].tolist(), float)
        unit = np.isfinite(m).all() and (m * m).sum(axis=1).max() <= 1 + 1e-6
        label = linked_by_sums(m, cut) if unit else average_linkage(m @ m.T, cut) if len(pdf) > 1 else np.zeros(1, int)
        out = pdf[[*keys, item]].copy()
        out["cluster"] = pdf[item].groupby(label).transform("min")
        return out

    return df.select(*keys, item, vector).groupBy(*keys).applyInPandas(cluster, f"{kinds}, cluster {of_item}")


def named_clusters(clustered: DataFrame, keys: list[str], item: str, seen: str, pos: str) -> DataFrame:
    """clustered with identity person_0, person_1, ... by when each cluster was first seen."""
    names = by_first_seen(clustered, keys, "cluster", seen, pos).drop("first_seen")
    return clustered.join(names, [*keys, "cluster"])


def nearest_other(df: DataFrame, keys: list[str], item: str, vector: str, label: str, block: int = 4096) -> DataFrame:
    """keys, item, track, identity, similarity (3 places): each item's nearest of another label.

    Of equal ones the least item; none if there is no other label, or none more alike than -1.

    A video's items are cut into blocks; each pair of blocks is one product of matrices in one task, which gives
    the best of one block for each item of the other.  So no pair of items becomes a row, and a video of many
    items is many tasks.
    """
    by = Window.partitionBy(*keys)
    cut = df.select(*keys, F.col(item).alias("i"), F.col(label).alias("l"), F.col(vector).alias("v"))
    cut = cut.withColumn("b", F.floor((F.row_number().over(by.orderBy("i")) - 1) / block).cast("int")).withColumn("n", F.floor((F.count("*").over(by) - 1) / block).cast("int"))
    sides = cut.withColumn("o", F.explode(F.expr("sequence(0, n)"))).withColumn("s", F.explode(F.array(F.lit(0), F.lit(1))))
    sides = sides.select(*keys, "i", "l", "v", "s", F.when(F.col("s") == 0, F.col("b")).otherwise(F.col("o")).alias("vx_a"), F.when(F.col("s") == 0, F.col("o")).otherwise(F.col("b")).alias("vx_b"))
    kinds = {f.name: f.dataType.simpleString() for f in sides.schema}
    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", i {kinds['i']}, track {kinds['i']}, identity {kinds['l']}, s double"

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["s"] == 0], pdf[pdf["s"] == 1].sort_values("i")
        x, y = (np.array(p["v"].tolist(), float) for p in (a, b))
        s = x @ y.T
        s[a["l"].to_numpy()[:, None] == b["l"].to_numpy()[None, :]] = -np.inf
        at = s.argmax(axis=1)
        got = a[[*keys, "i"]].assign(track=b["i"].to_numpy()[at], identity=b["l"].to_numpy()[at], s=s[np.arange(len(a)), at])
        return got[got["s"] > -1]

    pairs = sides.groupBy(*keys, "vx_a", "vx_b").applyInPandas(best, out)
    first = pairs.groupBy(*keys, "i").agg(F.min(F.struct((-F.col("s")).alias("s"), "track", "identity")).alias("m"))
    return first.select(*keys, F.col("i").alias(item), "m.track", "m.identity", pyround(-F.col("m.s"), 3).alias("similarity"))


def borderline(nearest: DataFrame, labels: DataFrame, keys: list[str], item: str, label: str, least: float = 0.35) -> DataFrame:
    """Nearest-other rows of clusters of one item that are nearly alike, for review."""
    alone = labels.join(singletons(labels, [*keys, label]), [*keys, label], "left_semi").select(*keys, item)
    return nearest.join(alone, [*keys, item], "left_semi").where(F.col("similarity") >= least)


def profile_ranking(segments: DataFrame, profiles: DataFrame, keys: list[str], segment: str, vector: str, most: int | None = None) -> DataFrame:
    """keys, segment, identity, similarity, nth: a segment's voice against all profiles of its video."""
    from voxtable.functions.scalars import cosine

    pairs = segments.select(*keys, segment, F.col(vector).alias("va")).join(profiles.select(*keys, "identity", F.col(vector).alias("vb")), keys)
    w = Window.partitionBy(*keys, segment).orderBy(F.desc("similarity"), "identity")
    ranked = pairs.select(*keys, segment, "identity", cosine("va", "vb").alias("similarity")).withColumn("nth", F.row_number().over(w))
    return ranked if most is None else ranked.where(F.col("nth") <= most)


def identity_maps(members: DataFrame, nearest: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each video with the document's maps: track_to_identity and nearest_other_cluster."""
    a = members.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("track_key", "identity")))).alias("track_to_identity"))
    b = nearest.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("track_key", F.struct("track", "identity", "similarity").alias("v"))))).alias("nearest_other_cluster"))
    return a.join(b, keys, "left")
