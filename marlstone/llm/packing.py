"""Chunks of documents and packed columns: many small values travel as one compressed binary.

A chunk is a hash class of documents, about CHUNK_ROWS of them however many there are in all; it is the unit
that Python code handles at a time, so memory does not grow with the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 1000


def chunk_count(rows: int, per: int = CHUNK_ROWS) -> int:
    return max(1, math.ceil(rows / per))


def chunked(docs: DataFrame, chunks: int, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, texts) dealt by chunk, the documents of a batch packed by chunk; docs_of() opens them.

    Null text is empty. Copies of a text fall into different chunks.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches):
        for pdf in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
            known = pdf["doc_id"].notna().to_numpy()
            ids = pdf["doc_id"].fillna(0).to_numpy(np.int64)
            by = np.argsort(pdf["chunk"].to_numpy(), kind="stable")
            chunk = pdf["chunk"].to_numpy()[by]
            rows = []
            for k in np.split(by, np.flatnonzero(np.diff(chunk)) + 1):
                head = np.stack((ids[k], known[k].astype(np.int64), np.array([len(raw[i]) for i in k], np.int64)))
                rows.append((int(pdf["chunk"].iat[k[0]]), squeeze(head.tobytes()), squeeze(b"".join([raw[i] for i in k]))))
            yield pd.DataFrame(rows, columns=["chunk", "ids", "texts"])

    d = d.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    return d.mapInPandas(pack, "chunk int, ids binary, texts binary").repartition(parts, "chunk")


def docs_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of a chunk: doc_id (nullable), text."""
    ids, texts = [], []
    for head, body in zip(pdf["ids"], pdf["texts"]):
        own, known, sizes = np.frombuffer(unsqueeze(head), np.int64).reshape(3, -1)
        raw = unsqueeze(body)
        ends = np.cumsum(sizes).tolist()
        texts += [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]
        ids += [pd.array(np.where(known > 0, own, 0), "Int64")]
        ids[-1][known == 0] = pd.NA
    return pd.DataFrame({"doc_id": pd.concat([pd.Series(x) for x in ids], ignore_index=True), "text": texts})


def squeeze(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_sorted(values: np.ndarray) -> bytes:
    """A sorted uint64 array as differences, one byte plane after the other."""
    d = np.diff(values, prepend=np.uint64(0))
    return squeeze(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def grid(chunks: int) -> tuple[int, int]:
    """(blocks, sub-ranges) of a two-level exchange: chunks meet by block and range first, blocks by range and sub-range then.

    Each level sends about chunks^1.5 messages instead of chunks^2, and a value that every chunk has is combined within
    blocks before the blocks meet, so no task gets more than about sqrt(chunks) copies of it.
    """
    blocks = max(1, math.ceil(math.sqrt(chunks)))
    return blocks, max(1, math.ceil(chunks / blocks))


def borders(lo: int, hi: int, parts: int) -> np.ndarray:
    """First values of `parts` equal ranges of lo..hi-1."""
    return np.array([lo + (hi - lo) * r // parts for r in range(parts)], np.uint64)


def sub_borders(part: int, bits: int, blocks: int, subs: int) -> np.ndarray:
    lo, hi = ((1 << bits) * (int(part) + k) // blocks for k in (0, 1))
    return borders(lo, hi, subs)


def cuts_of(values: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(range, begin, end) of the ranges a sorted array has values in."""
    at = np.append(np.searchsorted(values, first), len(values))
    return [(r, a, b) for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if b > a]


def frequencies(groups: DataFrame, prints: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], bits: int, chunks: int) -> DataFrame:
    """(chunk, part, counts): a byte of total frequency for each fingerprint a chunk has, in order of range and fingerprint.

    prints gives a chunk's sorted distinct fingerprints (below 2^bits) and how often it has each. There are half as many
    ranges as chunks, so the exchange has at most chunks * chunks / 2 messages; most fingerprints are rare, so meeting in
    blocks first, as words do, would send nearly all of them twice. A hot one costs its range an entry per chunk.
    Frequencies over 127 are logarithmic.
    """
    first = borders(0, 1 << bits, max(1, math.ceil(chunks / 2)))

    def send(key, pdf):
        fp, c = prints(pdf)
        rows = [(key[0], r, pack_sorted(fp[a:b]), squeeze(np.minimum(c[a:b], 255).astype(np.uint8).tobytes(), 1)) for r, a, b in cuts_of(fp, first)]
        return pd.DataFrame(rows, columns=["chunk", "part", "fps", "own"])

    def count(pdf):
        lists = [unpack_sorted(x) for x in pdf["fps"]]
        own = [np.frombuffer(unsqueeze(x), np.uint8) for x in pdf["own"]]
        all_, where = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(own), minlength=len(all_)).astype(np.int64)
        level = np.where(total < 128, total, 128 + np.log2(np.maximum(total, 1)).astype(np.int64)).astype(np.uint8)[where]
        ends = np.cumsum([len(x) for x in lists])
        return pdf[["chunk", "part"]].assign(counts=[squeeze(x.tobytes(), 1) for x in np.split(level, ends[:-1])])

    sent = groups.groupBy("chunk").applyInPandas(send, "chunk int, part int, fps binary, own binary")
    return sent.groupBy("part").applyInPandas(count, "chunk int, part int, counts binary")


def levels_of(freq: pd.DataFrame) -> np.ndarray:
    """A chunk's frequencies, aligned with its sorted distinct fingerprints."""
    if not len(freq):
        return np.zeros(0, np.uint8)
    return np.concatenate([np.frombuffer(unsqueeze(x), np.uint8) for x in freq.sort_values("part")["counts"]])


def print_bits(rows: int) -> int:
    """Bits that keep clashes of shortened fingerprints rare for about 2^9 of them per row."""
    return min(60, 18 + math.ceil(math.log2(rows + 2)))
