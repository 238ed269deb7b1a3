"""Embedding near-duplicates by cross-polytope hashing.

Vectors are rotated by random signs and fast Hadamard transforms; the hash of a
rotation is the coordinate of the greatest magnitude, with its sign. A table
joins the hashes of a few rotations. A vector is put into its own bucket and into
those of its likeliest near misses (multiprobe), and pairs that meet are
verified by their cosine in double precision.

Equal vectors are one class with a number of copies. Buckets are compared in
blocks: a block pair is one matrix product of bounded size and returns, for each
of its vectors, a number of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import partitions, table, written
from tillscope.llm.components import connected_components

COSINE = 0.93
#: Buckets of a table that a vector goes into.
PROBES = 4
#: Rotations joined in the key of a table -> tables. Of pairs at a cosine of 0.93 these find,
#: by simulation in 64 and 384 dimensions, 0.997 and 0.98, 0.994 and 0.957, 0.997 and 0.958.
TABLES = {2: 4, 3: 6, 4: 12}
#: A label gets one more rotation while its vectors fill more than one in so many buckets.
SPARE = 8
#: Shorter vectors are padded to 2**LEAST_BITS coordinates, where signs make enough rotations.
LEAST_BITS = 4
SEED = 29
#: Vectors of a bucket that meet in one task at most; larger buckets go in pairs of such blocks.
BLOCK = 1024
#: Buckets of one task are chosen so that it gets about so many vectors.
TASK_VECTORS = 20_000


# --- hashing ----------------------------------------------------------------------------

def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row (length a power of two), scaled to keep lengths."""
    out, half = rows.copy(), 1
    count, size = rows.shape
    while half < size:
        pairs = out.reshape(count, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, size)
        half *= 2
    return out / np.sqrt(size)


def _rotated(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    for _ in range(3):
        rows = hadamard(rows * rng.choice([-1.0, 1.0], rows.shape[1]))
    return rows


def bucket_codes(units: np.ndarray, tables: int, rotations: int, probes: int, seed: int) -> np.ndarray:
    """codes[vector, table, probe]: own bucket first, then the nearest misses.

    A miss takes the second-greatest coordinate in some of the rotations; the subsets
    with the least loss of magnitude come first.
    """
    size = 1 << max(LEAST_BITS, (units.shape[1] - 1).bit_length())
    padded = np.zeros((len(units), size))
    padded[:, : units.shape[1]] = units
    codes = np.zeros((len(units), tables, probes), dtype=np.int64)
    choices = [c for n in range(rotations + 1) for c in combinations(range(rotations), n)]
    for t in range(tables):
        first, second, loss = [], [], []
        for r in range(rotations):
            turned = _rotated(padded, np.random.default_rng([seed, t, r, size]))
            order = np.argsort(-np.abs(turned), axis=1)[:, :2]
            great = np.take_along_axis(turned, order, 1)
            vertex = 2 * order + (great < 0)
            first.append(vertex[:, 0])
            second.append(vertex[:, 1])
            loss.append(np.abs(great[:, 0]) - np.abs(great[:, 1]))
        ranks = np.argsort(np.stack([sum((loss[r] for r in c), np.zeros(len(units))) for c in choices], axis=1), axis=1, kind="stable")
        every = np.zeros((len(units), len(choices)), dtype=np.int64)
        for k, c in enumerate(choices):
            for r in range(rotations):
                every[:, k] = every[:, k] * (2 * size) + (second[r] if r in c else first[r])
        codes[:, t] = np.take_along_axis(every, ranks, 1)[:, :probes]
    return codes


# --- comparing ----------------------------------------------------------------------------

def _met(left: np.ndarray, right: np.ndarray, t: int) -> np.ndarray:
    """Whether the vectors share a bucket of table t, of any probe of either."""
    met = np.zeros((len(left), len(right)), dtype=bool)
    for p in range(left.shape[2]):
        for q in range(right.shape[2]):
            met |= left[:, t, p, None] == right[None, :, t, q]
    return met


def _first_meeting(left: np.ndarray, right: np.ndarray, t: int, code: int) -> np.ndarray:
    """Pairs whose first common bucket, by table and then by code, is this one."""
    fresh = np.ones((len(left), len(right)), dtype=bool)
    for earlier in range(t):
        fresh &= ~_met(left, right, earlier)
    for p in range(left.shape[2]):
        for q in range(right.shape[2]):
            same = left[:, t, p, None] == right[None, :, t, q]
            fresh &= ~(same & (left[:, t, p, None] < code))
    return fresh


def _compare(units, codes, ids, sizes, left, right, t: int, code: int, cosine: float):
    """Links found between two sets of rows: (row, copies linked) and forest edges of ids."""
    near = units[left] @ units[right].T >= cosine
    if left is right:
        near = np.triu(near, 1)
    if not near.any():
        return [], []
    rows = np.flatnonzero(near.any(axis=1))
    columns = np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(rows, columns)]
    near &= _first_meeting(codes[left[rows]], codes[right[columns]], t, code)
    a, b = left[rows], right[columns]
    counts = [(a, near @ sizes[b]), (b, near.T @ sizes[a])]
    return counts, _forest(near, ids[a], ids[b])


def _forest(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the links of the matrix join."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    rows, columns = place[: len(a)], place[len(a) :]
    labels, edges = np.arange(len(names)), []
    for i, line in enumerate(near):
        hits = columns[line]
        foreign = labels[hits] != labels[rows[i]]
        while foreign.any():
            other = hits[foreign.argmax()]
            edges.append((int(names[rows[i]]), int(names[other])))
            labels[labels == labels[other]] = labels[rows[i]]
            foreign = labels[hits] != labels[rows[i]]
    return edges


def _unit(vectors: np.ndarray) -> np.ndarray:
    # by the greatest component first, so that no square passes what a double can hold
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _links(group: pd.DataFrame, probes: int, cosine: float) -> pd.DataFrame:
    """Counts and forest of all block pairs of one task, as rows (id, copies) or (id, other)."""
    found_ids, found_counts, edges = [], [], []
    group = group.assign(label=pd.factorize(group["label"])[0], length=group["codes"].map(len))
    for _, part in group.groupby(["width", "length"], sort=False):
        keys = part[["label", "t", "code", "i", "j"]].to_numpy(np.int64)
        order = np.lexsort(keys.T[::-1])
        keys, part = keys[order], part.iloc[order]
        units = _unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
        codes = np.stack(part["codes"].to_numpy()).reshape(len(part), -1, probes)
        ids, sizes = part["id"].to_numpy(np.int64), part["copies"].to_numpy(np.int64)
        mine = part["mine"].to_numpy()
        bounds = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
        members = np.diff(bounds)
        # buckets of two are looked at all at once; most hold no link
        twos = bounds[:-1][members == 2]
        far = set(twos[np.einsum("ij,ij->i", units[twos], units[twos + 1]) < cosine - 1e-9].tolist())
        for at, count in zip(bounds[:-1].tolist(), members.tolist()):
            if count < 2 or at in far:
                continue
            _, t, code, i, j = keys[at].tolist()
            rows = np.arange(at, at + count)
            left = rows[mine[rows] == i]
            right = left if i == j else rows[mine[rows] == j]
            counts, forest = _compare(units, codes, ids, sizes, left, right, t, code, cosine)
            for found, copies in counts:
                found_ids.append(ids[found])
                found_counts.append(copies)
            edges += forest
    a = np.array(edges, dtype=np.int64).reshape(-1, 2)
    id_ = np.concatenate([*found_ids, a[:, 0]]).astype(np.int64)
    copies = np.concatenate([*found_counts, np.zeros(len(a))]).astype(np.int64)
    other = pd.array(np.concatenate([np.zeros(len(id_) - len(a), dtype=np.int64), a[:, 1]]), dtype="Int64")
    other[: len(id_) - len(a)] = pd.NA
    return pd.DataFrame({"id": id_, "copies": copies, "other": other})


# --- near-duplicates ------------------------------------------------------------------------

def classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, usable): vectors in double precision; what can't be compared is not usable."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))
    return vectors.select("vec_id", "label", vector.alias("vector"), usable.alias("usable"))


def label_rotations(members: str, width: str, probes: int) -> Column:
    """Rotations for a label of so many vectors of a width: the least whose buckets, of
    (2 * padded width) ** rotations, are not one in ``SPARE`` filled."""
    bits = F.greatest(F.lit(LEAST_BITS), F.ceil(F.log2(F.col(width).cast("double"))))
    base = F.pow(F.lit(2.0), bits + 1)
    filled = F.col(members) * (probes * SPARE)
    found = F.when(filled <= F.pow(base, F.lit(min(TABLES))), min(TABLES))
    for r in sorted(TABLES)[1:-1]:
        found = found.when(filled <= F.pow(base, F.lit(r)), r)
    return found.otherwise(max(TABLES))


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int | None = None,
    rotations: int | None = None,
    probes: int = PROBES,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label, others): vec_id, n_links,
    component_id, kept.

    A label's number of vectors decides how many rotations its keys join, so that
    buckets stay as empty, and how many tables make up for it; ``rotations`` and
    ``tables`` set them for all labels.

    Only vectors of equal, non-null labels and equal dimension are compared. Vectors
    that are null, empty, zero or hold a null, NaN or infinity link with nothing:
    n_links 0, their own vec_id as component, kept. Repeated rows link like other
    copies. A null vec_id is counted as a link of others but is never the smallest of
    a component; a component of such rows alone has none and is kept. An empty table
    gives an empty result.
    """
    rows = written(classes(vectors), "vectors")
    usable = rows.filter("usable")
    # -0.0 and 0.0 are one number to a group
    alike = usable.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    named = F.xxhash64("label", "vector")
    alike = written(alike.select(named.alias("id"), "label", "vector", "copies", "first_id"), "vector-classes")

    width = F.size("vector")
    counted = alike.groupBy(F.col("label").alias("l"), width.alias("w")).agg(F.count("*").alias("members"))
    counted = counted.withColumn("joined", F.lit(rotations) if rotations else label_rotations("members", "w", probes))
    own = alike.join(counted, (F.col("label") == F.col("l")) & (width == F.col("w"))).drop("l", "w", "members")

    @F.pandas_udf("array<long>")
    def hashed(batch: pd.Series, joined: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(batch), dtype=object)
        kinds = pd.MultiIndex.from_arrays([batch.map(len), joined])
        for size, r in kinds.unique():
            at = np.flatnonzero((batch.map(len) == size) & (joined == r))
            units = _unit(np.stack(batch.iloc[at].to_numpy()))
            codes = bucket_codes(units, tables or TABLES[r], int(r), probes, seed)
            for k, row in zip(at, codes.reshape(len(at), -1)):
                out.iat[k] = row
        return out

    coded = written(own.withColumn("codes", hashed("vector", "joined")).drop("joined"), "vector-codes")
    # the buckets of a row: its codes by table, each code once
    places = F.transform(F.col("codes"), lambda c, i: F.struct(F.floor(i / F.lit(probes)).cast("int").alias("t"), c.alias("code")))
    buckets = coded.select("id", "label", F.size("vector").alias("width"), F.explode(F.array_distinct(places)).alias("b"))
    buckets = buckets.select("id", "label", "width", "b.t", "b.code")
    keys = ["label", "width", "t", "code"]
    counts = buckets.groupBy(*keys).agg(F.count("*").alias("members")).filter("members > 1")
    shared = buckets.join(
        counts.select(F.col("label").alias("l"), F.col("width").alias("w"), F.col("t").alias("u"), F.col("code").alias("c"), "members"),
        (F.col("label") == F.col("l")) & (F.col("width") == F.col("w")) & (F.col("t") == F.col("u")) & (F.col("code") == F.col("c")),
    ).drop("l", "w", "u", "c")
    shared = shared.withColumn("blocks", F.ceil(F.col("members") / block))
    shared = shared.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda i: F.struct(F.least(i, F.col("mine")).alias("i"), F.greatest(i, F.col("mine")).alias("j")),
    )
    shared = written(shared.withColumn("pair", F.explode(pairs)).select("id", *keys, "mine", "pair.*"), "vector-buckets")
    tasks = max(partitions(vectors.sparkSession), shared.count() // TASK_VECTORS)
    task = F.pmod(F.xxhash64(*keys, "i", "j"), F.lit(tasks))
    meetings = shared.join(coded.drop("label", "first_id"), "id").withColumn("task", task)
    found = meetings.groupBy("task").applyInPandas(
        lambda group: _links(group, probes, cosine), "id long, copies long, other long"
    )
    found = written(found, "vector-links")
    linked = found.filter("other is null").groupBy("id").agg(F.sum("copies").alias("linked"))
    reached = written(connected_components(found.filter("other is not null"), "id", "other"), "vector-components")
    alike = alike.join(linked, "id", "left").join(reached, alike.id == reached.node, "left")
    alike = alike.select(
        "id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "first_id",
        F.coalesce("component", "id").alias("component"),
    )
    least = alike.groupBy("component").agg(F.min("first_id").alias("component_id"))
    alike = alike.join(least, "component").select(F.col("id").alias("class"), "n_links", "component_id")
    keyed = rows.select("vec_id", F.when(F.col("usable"), named).alias("of"))
    joined = keyed.join(alike, F.col("of") == F.col("class"), "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
