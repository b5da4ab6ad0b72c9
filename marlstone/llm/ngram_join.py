"""N-gram Jaccard join: a grouped prefix join, rarest shingles first, that returns link components.

1. Documents are dealt in chunks. Each chunk sends its distinct shingle fingerprints, packed, to hash ranges, which count
   them over all chunks and send one byte of frequency per fingerprint back. Frequencies only set the global order (rarest first), so their fingerprints may be short; sets are formed by 64-bit fingerprints.
2. A vertex is a distinct sequence of words, named by its 128-bit digest. Its prefix under that order holds a shingle
   in common with any partner at the threshold. Shingles that only one chunk has lead nowhere and only count as places.
3. Vertices with the same size, prefix shingles and places form one group. Cheap candidates come first: each member
   with its group's leader, each leader with its posting lists' smallest ones, and neighbours in three sorted orders of
   minimum hashes. Those that a sketch does not rule out are verified, and the links contract vertices to components.
4. What is left are pairs of different components. A group's members of one component form a cell; cells that meet in
   a posting list are filtered as pairs by size, by place (both places must lie within the pair's own prefix) and by a
   256-bit parity sketch, whose differing bits never exceed the differing shingles. Cell pairs are expanded, in blocks
   of members, to the member pairs the sketch allows. Of each pair of components the likeliest member pair is verified;
   only where it fails are the others. So copies of one another are contracted before they are paired, and no pair that
   could join two components is left out.
Verification compares whole sets of words, not fingerprints.

Null or empty texts have no shingles and link with nothing. Rows that repeat a doc_id are joined by equal words or by
links as any others, and a doc_id with two texts counts as one vertex per text, reported once per row. Null doc_ids
link as others do and get their component's smallest doc_id, null where it has none. An empty table gives no rows.
Very long texts are one set each; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stable, table
from marlstone.llm.graph import components
from marlstone.llm.packing import chunk_count, chunked, docs_of, frequencies, levels_of, print_bits, squeeze, unsqueeze
from marlstone.llm.shingles import distinct, exact_set, mix, shingle_sets, words

#: How many of a posting's preceding shingles it carries. A pair that meets in one of them is left to that earlier meeting;
#: the first common shingle has no common one before it, so every pair is formed there at least, and a few more than once.
WINDOW = 12
#: Rows before a vertex in a sorted order that are looked at, and members of a cell in a block.
AHEAD, BLOCK = 8, 256
#: Documents of a chunk.
CHUNK_ROWS = 2000
ORDERS = ((0, 1, 2), (1, 2, 0), (2, 0, 1))
_SEEDS = np.array([0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], np.uint64)

SET_SCHEMA = "doc_id long, text_sha256 binary, node binary, n int, sketch binary, h0 long, h1 long, h2 long, grp binary, tokens array<long>, places array<int>, packed binary"


def _fingerprint(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def _frequencies(d: DataFrame, n: int, bits: int, chunks: int) -> DataFrame:
    def prints(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        once = {s.tobytes(): s for s in shingle_sets(list(docs_of(pdf)["text"]), n)}  # copies in one chunk count once
        fps = [distinct(_fingerprint(s, bits), sort=False) for s in once.values()]
        return np.unique(np.concatenate(fps), return_counts=True) if fps else (np.zeros(0, np.uint64), np.zeros(0, int))

    return frequencies(d, prints, bits, chunks)


def _sets(d: DataFrame, freq: DataFrame, n: int, bits: int, num: int, den: int) -> DataFrame:
    def digest(*parts: bytes) -> bytes:
        h = hashlib.blake2b(digest_size=16)
        for p in parts:
            h.update(p)
        return h.digest()

    def build(key, docs, freq):
        docs = docs_of(docs)
        texts = list(docs["text"])
        sets = shingle_sets(texts, n)
        fps = [_fingerprint(s, bits) for s in sets]
        fp = distinct(np.concatenate(fps)) if fps else np.zeros(0, np.uint64)
        levels = levels_of(freq)
        rows = []
        for doc_id, text, s, f in zip(docs["doc_id"], texts, sets, fps):
            size = len(s)
            raw = text.encode("utf-8", "surrogatepass")
            sha = hashlib.sha256(raw).digest()
            if not size:
                rows.append((doc_id, sha, None, 0, None, 0, 0, 0, None, [], [], None))
                continue
            node = digest(b" ".join(words(raw)))
            lv = levels[np.searchsorted(fp, f)]
            prefix = size - (-(-num * size // den)) + 1
            order = np.lexsort((s, lv))[:prefix]
            place = np.flatnonzero(lv[order] > 1).astype(np.int32)
            if not len(place):
                rows.append((doc_id, sha, node, size, None, 0, 0, 0, None, [], [], None))
                continue
            token = s[order[place]]
            bit = (mix(s) & np.uint64(255)).astype(np.int64)
            parity = np.packbits((np.bincount(bit, minlength=256) & 1).astype(np.uint8)).tobytes()
            least = [int(mix(s ^ k).min().view(np.int64)) for k in _SEEDS]
            grp = digest(size.to_bytes(8, "little"), token.tobytes(), place.tobytes())
            rows.append((doc_id, sha, node, size, parity, *least, grp, token.view(np.int64), place, squeeze(raw)))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SET_SCHEMA.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return d.groupBy("chunk").cogroup(freq.groupBy("chunk")).applyInPandas(build, SET_SCHEMA)


def _verify(pairs: DataFrame, nodes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) of vertices whose whole sets of words pass."""

    def test(batches):
        last, y = None, set()
        for pdf in batches:
            keep = []
            for a, b in zip(pdf["pu"], pdf["pv"]):
                if b != last:  # rows come sorted by v
                    last, y = b, exact_set(unsqueeze(b), n)
                x = exact_set(unsqueeze(a), n)
                both = len(x & y)
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["u", "v"]]

    t = nodes.select("node", "packed")
    j = pairs.join(t.withColumnsRenamed({"node": "u", "packed": "pu"}), "u").join(t.withColumnsRenamed({"node": "v", "packed": "pv"}), "v")
    return j.select("u", "v", "pu", "pv").mapInPandas(test, "u binary, v binary")


def _allowed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Most differing shingles of linked sets of sizes a and b."""
    return a + b - 2 * -(-num * (a + b) // (num + den))


def _bits(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(-1, 4)


def _neighbours(nodes: DataFrame, order: tuple[int, ...], num: int, den: int) -> DataFrame:
    """(u, v): each vertex with the most alike of the AHEAD before it in a sorted order, if the sketch allows a link.

    The order's keys end with the vertex itself, so copies of one another are cut anywhere; neighbours across a cut are missed.
    """

    def near(batches):
        tail = None
        for pdf in batches:
            fresh = 0 if tail is None else len(tail)
            pdf = pdf if tail is None else pd.concat((tail, pdf), ignore_index=True)
            size, sketch = pdf["n"].to_numpy(np.int64), _bits(pdf["sketch"])
            best, who = np.full(len(pdf), 1 << 30), np.full(len(pdf), -1)
            for k in range(1, min(AHEAD, len(pdf) - 1) + 1):
                d = np.bitwise_count(sketch[k:] ^ sketch[:-k]).sum(1, dtype=np.int64)
                better = np.flatnonzero((d <= _allowed(size[k:], size[:-k], num, den)) & (d < best[k:]))
                best[better + k], who[better + k] = d[better], better
            i = np.flatnonzero((who >= 0) & (np.arange(len(pdf)) >= fresh))
            node = pdf["node"].to_numpy()
            yield pd.DataFrame({"u": node[i], "v": node[who[i]]})
            tail = pdf.iloc[-AHEAD:]

    by = [f"h{k}" for k in order] + ["node"]
    return nodes.select("node", "n", "sketch", "h0", "h1", "h2").repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(near, "u binary, v binary")


def _first_candidates(nodes: DataFrame, leading: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v) of members with leaders, leaders with the smallest of their lists, neighbours in sorted orders."""
    hub = F.struct("n", "node", "sketch")
    own = nodes.join(leading.select("grp", F.col("node").alias("v"), F.col("sketch").alias("with"), F.col("n").alias("m")), "grp").where("node <> v")
    posts = leading.select(*["node", "n", "sketch"], F.explode("tokens").alias("token"))
    hubs = posts.groupBy("token").agg(F.min(hub).alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    hubs = hubs.select("token", F.col("hub.node").alias("v"), F.col("hub.sketch").alias("with"), F.col("hub.n").alias("m"))
    stars = posts.join(hubs, "token").where(f"node <> v and {den} * m >= {num} * n")

    def near(batches):
        for pdf in batches:
            a, b = pdf["n"].to_numpy(np.int64), pdf["m"].to_numpy(np.int64)
            yield pdf.loc[np.bitwise_count(_bits(pdf["sketch"]) ^ _bits(pdf["with"])).sum(1) <= _allowed(a, b, num, den), ["node", "v"]].rename(columns={"node": "u"})

    columns = ["node", "n", "sketch", "v", "with", "m"]
    stars = stars.select(columns).mapInPandas(near, "u binary, v binary").groupBy("u").agg(F.min("v").alias("v"))
    pairs = own.select(columns).mapInPandas(near, "u binary, v binary").unionByName(stars)
    for o in ORDERS:
        pairs = pairs.unionByName(_neighbours(nodes, o, num, den))
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _cell_pairs(cells: DataFrame, leading: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of cells of different components that may hold a link."""
    word = lambda c, i: F.conv(F.hex(F.substring(c, 8 * i + 1, 8)), 16, -10).cast("long")
    bounds = cells.select("grp", "component", "cell", *[word(f"{k}_bits", i).alias(f"{k}{i}") for k in ("all", "any") for i in range(4)])
    # bounds join whole groups, before they are taken apart into postings
    p = leading.select("grp", "n", "tokens", "places").join(bounds, "grp").select("*", F.posexplode(F.arrays_zip("tokens", "places")).alias("k", "tp")).select(
        "cell", "component", "n", *[f"{k}{i}" for k in ("all", "any") for i in range(4)], F.col("tp.tokens").alias("token"), F.col("tp.places").alias("place"),
        F.expr(f"slice(tokens, greatest(k - {WINDOW}, 0) + 1, least(k, {WINDOW}))").alias("before"))
    need = f"cast(ceil({num} * (a.n + b.n) / {num + den}.0) as int)"
    index = p.where(f"place <= n - cast(ceil(2 * {num} * n / {num + den}.0) as int)")
    # a bit that all members of one cell have and none of the other differs for every pair
    surely = " + ".join(f"bit_count((a.all{i} & ~b.any{i}) | (~a.any{i} & b.all{i}))" for i in range(4))
    # left the larger (or equal) set, right its index prefix
    return p.alias("a").join(index.alias("b"), F.expr(
        f"a.token = b.token and (a.n > b.n or (a.n = b.n and a.cell > b.cell)) and {den} * b.n >= {num} * a.n and a.component <> b.component"
        f" and a.place <= a.n - {need} and b.place <= b.n - {need}"
        f" and {surely} <= a.n + b.n - 2 * {need} and not arrays_overlap(a.before, b.before)")).select(F.col("a.cell").alias("a"), F.col("b.cell").alias("b")).distinct()


def _expand(pairs: DataFrame, blocks: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v, d, cu, cv): member pairs that the sketch allows, with their differing bits and components."""

    def expand(batches):
        for pdf in batches:
            out = []
            for a, b, x, y, n, m, cu, cv in zip(pdf["a_nodes"], pdf["b_nodes"], pdf["a_sketches"], pdf["b_sketches"], pdf["a_n"], pdf["b_n"], pdf["a_component"], pdf["b_component"]):
                d = np.bitwise_count(_bits(x)[:, None] ^ _bits(y)[None]).sum(2, dtype=np.int64)
                for i, j in zip(*np.nonzero(d <= _allowed(n, m, num, den))):
                    out.append((a[i], b[j], int(d[i, j]), cu, cv) if cu > cv else (b[j], a[i], int(d[i, j]), cv, cu))
            yield pd.DataFrame(out, columns=["u", "v", "d", "cu", "cv"])

    side = lambda s: blocks.select(F.col("cell").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "component", "nodes", "sketches")])
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(expand, "u binary, v binary, d long, cu binary, cv binary")


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id; links at den * intersection >= num * union of n-word shingles.

    Further columns: root, the component's vertex of least digest (null without shingles), and text_sha256, the digest of the
    row's text, by which rows that share a doc_id or have none can be told apart.
    """
    total = docs.select(F.lit(1)).count()
    chunks = chunk_count(total, CHUNK_ROWS)
    bits = print_bits(total)
    d = chunked(docs, chunks, id_col, text_col)
    sets = stable(_sets(d, _frequencies(d, n, bits, chunks), n, bits, num, den))
    filled = sets.where("n > 0")
    classes = stable(filled.groupBy("node").agg(F.min("doc_id").alias("rep")))
    nodes = stable(filled.where("size(tokens) > 0").drop("doc_id", "text_sha256").dropDuplicates(["node"]))
    slim = nodes.drop("packed")
    leading = stable(slim.groupBy("grp").agg(F.min(F.struct("node", "n", "sketch", "tokens", "places")).alias("m")).select("grp", "m.*"))
    first = stable(_verify(_first_candidates(slim, leading, num, den), nodes, n, num, den))
    labels = stable(components(first))

    m = slim.select("grp", "node", "n", "sketch").join(labels.withColumnRenamed("id", "node"), "node", "left")
    m = stable(m.withColumn("component", F.coalesce("component", "node")).withColumn("cell", F.concat("grp", "component")))
    half = lambda i: F.conv(F.hex(F.substring("sketch", 8 * i + 1, 8)), 16, -10).cast("long")
    whole = lambda f: F.concat(*[F.unhex(F.lpad(F.hex(f(half(i))), 16, "0")) for i in range(4)])
    cells = stable(m.groupBy("grp", "component", "cell").agg(whole(F.bit_and).alias("all_bits"), whole(F.bit_or).alias("any_bits"), F.count(F.lit(1)).alias("c")))
    pairs = stable(_cell_pairs(cells, leading, num, den))
    met = pairs.select(F.explode(F.array("a", "b")).alias("cell")).distinct()
    blocks = m.join(cells.select("cell", "c"), "cell").join(met, "cell", "left_semi").groupBy("cell", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK)).alias("block"))
    blocks = blocks.agg(F.first("n").alias("n"), F.first("component").alias("component"), F.collect_list(F.struct("node", "sketch")).alias("s"))
    may = stable(_expand(pairs, blocks.select("cell", "n", "component", F.col("s.node").alias("nodes"), F.col("s.sketch").alias("sketches")), num, den))
    between = ["cu", "cv"]
    likely = stable(may.groupBy(*between).agg(F.min(F.struct("d", "u", "v")).alias("m")).select(*between, "m.u", "m.v"))
    joined = stable(likely.join(_verify(likely.select("u", "v"), nodes, n, num, den), ["u", "v"], "left_semi").select(between))
    rest = may.join(joined, between, "left_anti").join(likely.select("u", "v"), ["u", "v"], "left_anti").select("u", "v", *between)
    rest = stable(rest)
    late = rest.join(_verify(rest.select("u", "v"), nodes, n, num, den), ["u", "v"], "left_semi").select(between)
    roots = components(joined.unionByName(late).select(F.col("cu").alias("u"), F.col("cv").alias("v")))

    # a component's name is its smallest doc_id; vertices without a link are their own
    part = labels.withColumnsRenamed({"id": "node", "component": "at"})
    tied = classes.join(part, "node", "left").withColumn("at", F.coalesce("at", "node")).join(roots.withColumnsRenamed({"id": "at", "component": "root"}), "at", "left").select("node", "rep", F.coalesce("root", "at").alias("root"))
    tied = stable(tied)
    linked = tied.where("root <> node").select("root").distinct()
    names = tied.join(linked, "root", "left_semi").groupBy("root").agg(F.min("rep").alias("component"))
    final = stable(tied.join(names, "root", "left").select("node", "root", F.coalesce("component", "rep").alias("component")))
    out = sets.select("doc_id", "text_sha256", "node", "n").join(final, "node", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "root", "text_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, num=9, den=10).select("doc_id", "n_shingles", "component_id")
