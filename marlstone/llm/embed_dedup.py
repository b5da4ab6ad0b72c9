"""Embedding near-dedup: int8 tile products with an error bound per vector, full precision where a pair may pass.

Vectors are compared within a label (and length). Equal vectors are collapsed to one with a count. Each label's
vectors are dealt by hash into blocks of about BLOCK; a task gets one pair of blocks, multiplies their int8 codes
(exact in float32 as long as 127 * 127 * length < 2^24, else in float64) and keeps pairs whose product plus both
quantisation errors reaches the threshold; only those are recomputed in double precision. A tile returns, per
vector, how many others it links to and the smallest vector of its component within the tile: never pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and null labels link with nothing. Rows
without vec_id link as others do; their component is its smallest vec_id, null where it has none. Rows that repeat a
vec_id are rows of their own; as copies they count as each other's links. An empty table gives no rows, extra columns
are not read, vectors of any length are compared within their length. Every vector goes to each block of its label, so
a label of n vectors shuffles n * n / BLOCK of them: exact search has that price, and the tiles have equal work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stable, table
from marlstone.llm.graph import components

BLOCK = 2048


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, error) of unit vectors: |u - scale * code| <= error."""
    scale = np.abs(unit).max(1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - scale[:, None] * code) ** 2).sum(1)) + 1e-12
    return code, scale, error


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs with cosine >= threshold in double precision."""
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    ua, ub = a / na[:, None], b / nb[:, None]
    (qa, sa, ea), (qb, sb, eb) = quantise(ua), quantise(ub)
    kind = np.float32 if 127 * 127 * a.shape[1] < 1 << 24 else np.float64
    product = qa.astype(kind) @ qb.astype(kind).T
    near = product * sa.astype(kind)[:, None] * sb.astype(kind)[None, :]
    # |u.v - u'.v'| <= e_u (1 + e_v) + e_v; 1e-5 covers the rounding of the scaling in float32
    slack = (ea[:, None] * (1 + eb[None, :]) + eb[None, :] + 1e-5).astype(kind)
    out = np.zeros(near.shape, bool)
    i, j = np.nonzero(near + slack >= threshold)
    for k in range(0, len(i), 1 << 16):
        x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
        out[x, y] = (a[x] * b[y]).sum(1) / (na[x] * nb[y]) >= threshold
    return out


def spread(links: np.ndarray) -> np.ndarray:
    """Component number of each row of a symmetric boolean matrix."""
    n = len(links)
    label = np.full(n, -1)
    for s in range(n):
        if label[s] >= 0:
            continue
        label[s], front = s, np.array([s])
        while len(front):
            front = np.flatnonzero(links[front].any(0) & (label < 0))
            label[front] = s
    return label


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    v = v.withColumn("node", F.when(F.coalesce(able, F.lit(False)), F.unhex(F.md5(F.to_binary(F.concat(F.col("label").cast("string"), F.lit(":"), F.array_join("v", ",")), F.lit("utf-8"))))))
    classes = stable(v.where("node is not null").groupBy("node", "label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    sizes = classes.groupBy("label", F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = classes.withColumn("dim", F.size("v")).join(sizes, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = dealt.select("label", "dim", "node", "v", "copies", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = tiles.select("label", "dim", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "v", "copies")

    def work(key, pdf):
        lo, hi = key[2], key[3]
        x = np.array(pdf["v"].tolist(), np.float64)
        node, copies = pdf["node"].to_numpy(), pdf["copies"].to_numpy()
        first = np.flatnonzero(pdf["own"].to_numpy() == lo)
        second = first if lo == hi else np.flatnonzero(pdf["own"].to_numpy() == hi)
        if not len(first) or not len(second):
            return pd.DataFrame({"u": [], "n": [], "root": []})
        block = tile_links(x[first], x[second], threshold)
        links = np.zeros((len(x), len(x)), bool)
        links[np.ix_(first, second)] = block
        links |= links.T
        np.fill_diagonal(links, False)
        n = links @ copies
        has = np.flatnonzero(links.any(1))
        root = spread(links)
        return pd.DataFrame({"u": node[has], "n": n[has], "root": node[root[has]]})

    found = stable(tiles.groupBy("label", "dim", "lo", "hi").applyInPandas(work, "u binary, n long, root binary"))
    counts = found.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("u <> root").select("u", F.col("root").alias("v")))
    tied = stable(
        classes.select("node", "rep", "copies").join(counts, "node", "left").join(roots.withColumnsRenamed({"id": "node", "component": "root"}), "node", "left")
        .select("node", "rep", "root", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    names = tied.where("root is not null").groupBy("root").agg(F.min("rep").alias("component"))
    done = stable(tied.join(names, "root", "left").select("node", "n_links", F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("component")).alias("component")))
    out = v.select("vec_id", "node").join(done, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
