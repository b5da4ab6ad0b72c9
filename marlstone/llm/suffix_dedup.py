"""Suffix-array dedup of repeated byte strings of SPAN bytes, over a sparse array of content-chosen suffixes.

1. Every SPAN-byte string of a text has one anchor: its least KMER-byte string by hash, leftmost first. Equal strings
   have equal anchors at equal offsets, so only suffixes that start at anchors need sorting, about one in 70 bytes.
   Chunks of documents count their anchors over all chunks; an anchor that occurs once has no repeated string.
2. For each other anchor a chunk keeps the segment of text its strings cover (equal segments once per chunk), as the
   anchor's suffix and what stands left of it. Splitters sampled from all chunks cut the order of suffixes (then of
   reversed left contexts) into buckets of about BUCKET segments; each chunk sends each bucket its part, packed.
3. A bucket sorts its suffixes by multikey quicksort over 8-byte tokens and finds each one's longest match with its
   neighbours, then the same for left contexts within equal anchors. A string at offset o before its anchor can only
   be repeated if the left match reaches o and the right match SPAN - o; these strings are compared by fingerprint.
4. An anchor at which a splitter falls has segments in several buckets: such hot anchors are compared across the
   boundaries instead. Their strings' fingerprints are counted over all chunks by hash range, once per chunk each.
5. The chunks mark covered bytes in their documents.

Null text is empty. Texts shorter than SPAN keep all. Repeated rows repeat each other's strings, null doc_ids are rows
like others, an empty table gives no rows. Very long texts are anchored in one piece; memory is proportional to the longest.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stable, table
from marlstone.llm.packing import chunk_count, chunked, docs_of, frequencies, levels_of, print_bits, squeeze, unsqueeze
from marlstone.llm.shingles import _INVERSE, mix, powers

SPAN, KMER = 200, 64
BUCKET = 16_000
SAMPLE = 20_000
_PLACE = np.uint64((1 << 28) - 1)
_CODES = mix(np.arange(11, 267, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_SLICE = 1 << 18
_NONE = np.zeros(0, np.int64)


def _running(data: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODES[data] * powers(len(data)), dtype=np.uint64)))


def anchors(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first, last, anchor's hash, segment's hash): the strings starting at first..last have this anchor."""
    n = len(data)
    starts = np.concatenate([np.arange(a, b - SPAN + 1) for a, b in zip(cuts[:-1], cuts[1:]) if b - a >= SPAN] or [_NONE])
    if not len(starts):
        return _NONE, _NONE, _NONE, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    run, inv = _running(data), powers(n + 1, _INVERSE)
    hashes = mix((run[KMER:] - run[:-KMER]) * inv[: n - KMER + 1])
    w = SPAN - KMER + 1
    keyed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    pad = -len(keyed) % w
    grid = np.concatenate((keyed, np.full(pad, ~np.uint64(0)))).reshape(-1, w)
    ahead = np.minimum.accumulate(grid, 1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    at = (np.minimum(behind[starts], ahead[starts + w - 1]) & _PLACE).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    a = at[new]
    end = last + SPAN
    whole = mix((run[end] - run[first]) * inv[first] + (a - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (end - first).astype(np.uint64))
    return a, first, last, hashes[a], whole


def _slices(raw: list[bytes]):
    i = 0
    while i < len(raw):
        j, size = i, 0
        while j < len(raw) and (j == i or size + len(raw[j]) < _SLICE):
            size += len(raw[j])
            j += 1
        yield i, np.frombuffer(b"".join(raw[i:j]), np.uint8), np.cumsum([0] + [len(x) for x in raw[i:j]])
        i = j


def _texts(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[bytes]]:
    """A chunk's documents in an order that does not depend on how they arrived."""
    pdf = docs_of(pdf).sort_values(["doc_id", "text"], kind="stable").reset_index(drop=True)
    return pdf, [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return squeeze(head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw = unsqueeze(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds), 8)
    at = 8 * (len(kinds) + 1)
    out = []
    for kind, n in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _prints(bits: int):
    def prints(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        _, raw = _texts(pdf)
        found = [anchors(data, cuts)[3] for _, data, cuts in _slices(raw)]
        return np.unique(np.concatenate(found) >> np.uint64(64 - bits), return_counts=True) if found else (np.zeros(0, np.uint64), _NONE)

    return prints


def _segments(d: DataFrame, freq: DataFrame, bits: int, sampled: int) -> DataFrame:
    """Per chunk: its distinct segments with repeated anchors, where they stand, and a sample of their keys."""

    def build(key, docs: pd.DataFrame, freq: pd.DataFrame) -> pd.DataFrame:
        _, raw = _texts(docs)
        levels = levels_of(freq)
        pieces = []
        for i, data, cuts in _slices(raw):
            a, first, last, h, whole = anchors(data, cuts)
            doc = np.searchsorted(cuts, first, side="right") - 1
            pieces.append((i, data, cuts, a, first, last, h >> np.uint64(64 - bits), whole, doc))
        fp = np.unique(np.concatenate([p[6] for p in pieces])) if pieces else np.zeros(0, np.uint64)
        known: dict[int, int] = {}
        left, right, bodies, seg_of, docs_of, firsts, times = [], [], [], [], [], [], []
        for i, data, cuts, a, first, last, f, whole, doc in pieces:
            keep = levels[np.searchsorted(fp, f)] > 1 if len(f) else np.zeros(0, bool)
            a, first, last, whole, doc = a[keep], first[keep], last[keep], whole[keep], doc[keep]
            body = data.tobytes()
            for x, p, q, h, n in zip(a.tolist(), first.tolist(), last.tolist(), whole.tolist(), doc.tolist()):
                s = known.get(h)
                if s is None:
                    s = known[h] = len(bodies)
                    left.append(x - p), right.append(SPAN - (x - q)), bodies.append(body[p : q + SPAN]), times.append(0)
                times[s] += 1
                seg_of.append(s), docs_of.append(i + n), firsts.append(p - int(cuts[n]))
        step = max(1, len(bodies) // sampled)
        sample = [_key(bodies[k], left[k]) for k in range(0, len(bodies), step)][:sampled]
        segs = _pack(np.array(left, np.uint8), np.array(right, np.uint8), np.minimum(times, 2).astype(np.uint8) if times else np.zeros(0, np.uint8), np.frombuffer(b"".join(bodies), np.uint8))
        places = _pack(np.array(seg_of, np.int32), np.array(docs_of, np.int32), np.array(firsts, np.int32))
        return pd.DataFrame([(key[0], segs, places, len(bodies), sample)], columns=["chunk", "segs", "places", "n", "sample"])

    return d.groupBy("chunk").cogroup(freq.groupBy("chunk")).applyInPandas(build, "chunk int, segs binary, places binary, n long, sample array<binary>")


def _key(body: bytes, left: int) -> bytes:
    return body[left:].ljust(SPAN, b"\0") + body[:left][::-1]


def _load(segs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    left, right, times, body = _unpack(segs, np.uint8, np.uint8, np.uint8, np.uint8)
    left, right = left.astype(np.int64), right.astype(np.int64)
    return left, right, times, body, np.concatenate(([0], np.cumsum(left + right)))


def _split(body: np.ndarray, left: np.ndarray, offs: np.ndarray, splitters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each segment, whether a splitter falls into its anchor)."""
    raw = body.tobytes()
    hot = {s[:KMER] for s in splitters}
    bucket, over = np.empty(len(left), np.int64), np.empty(len(left), bool)
    for k, (n, a, b) in enumerate(zip(left.tolist(), offs[:-1].tolist(), offs[1:].tolist())):
        over[k] = raw[a + n : a + n + KMER] in hot
        bucket[k] = bisect.bisect_right(splitters, _key(raw[a:b], n))
    return bucket, over


def _windows(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) for each offset lo..hi of each segment."""
    n = np.maximum(hi - lo + 1, 0)
    seg = np.repeat(np.arange(len(n)), n)
    return seg, np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n) + lo[seg]


def _string_hashes(body: np.ndarray, begin: np.ndarray) -> np.ndarray:
    run = _running(body)
    return mix((run[begin + SPAN] - run[begin]) * powers(len(body) + 1, _INVERSE)[begin])


def _intervals(seg: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (segment, offset) rows as (segment, lowest, highest) runs."""
    if not len(seg):
        return _NONE, _NONE, _NONE
    new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)))
    s = np.flatnonzero(new)
    return seg[s], off[s], off[np.append(s[1:] - 1, len(off) - 1)]


def multikey_sort(words: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of 8-byte tokens, and how many bytes each has in common with the one before it.

    Quicksort by one token at a time: rows that share all tokens so far form an open range, all open ranges are
    parted by the next token together, and only ranges of two rows or more stay open.
    """
    n, depth = words.shape
    if group is None:
        order, part = np.arange(n), np.zeros(n, np.int64)
    else:
        order = np.argsort(group, kind="stable")
        part = group[order]
    common = np.full(n, 8 * depth)
    if n:
        common[0] = 0
        common[1:][part[1:] != part[:-1]] = 0
    live = np.arange(n)
    for d in range(depth):
        opens = np.concatenate(([True], part[1:] != part[:-1])) if len(part) else np.zeros(0, bool)
        alone = opens & np.append(opens[1:], True)
        live, part = live[~alone], part[~alone]
        if not len(live):
            break
        token = words[order[live], d]
        by = np.lexsort((token, part))
        order[live], token = order[live][by], token[by]
        edge = np.concatenate(([True], (part[1:] != part[:-1]) | (token[1:] != token[:-1])))
        split = edge & np.concatenate(([False], part[1:] == part[:-1]))
        k = np.flatnonzero(split)
        x = token[k] ^ token[k - 1]
        lead = np.zeros(len(k), np.int64)
        for b in range(1, 8):
            lead += (x >> np.uint64(64 - 8 * b)) == 0
        common[live[k]] = 8 * d + lead
        part = np.cumsum(edge)
    return order, common


def _matrix(body: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, back: bool = False) -> np.ndarray:
    """Rows of zero-padded bytes as big-endian 8-byte tokens."""
    n = -(-width // 8) * 8
    at = np.arange(n)[None, :]
    ok = at < size[:, None]
    where = begin[:, None] - 1 - at if back else begin[:, None] + at
    out = np.where(ok, body[np.clip(where, 0, len(body) - 1)], 0).astype(np.uint8)
    return np.ascontiguousarray(out).view(">u8").astype(np.uint64)


def repeated_in_bucket(left: np.ndarray, right: np.ndarray, times: np.ndarray, body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, lowest offset, highest offset) of strings that occur in two segments of the bucket."""
    if not len(left):
        return _NONE, _NONE, _NONE
    at = offs[:-1] + left
    order, common = multikey_sort(_matrix(body, at, right, SPAN))
    group = np.empty(len(left), np.int64)
    group[order] = np.cumsum(common < KMER)
    r = np.empty(len(left), np.int64)
    r[order] = np.maximum(common, np.append(common[1:], 0))
    order, common = multikey_sort(_matrix(body, at, left, SPAN - KMER, back=True), group)
    same = np.concatenate(([False], group[order][1:] == group[order][:-1]))
    common = np.where(same, common, -1)
    m = np.empty(len(left), np.int64)
    m[order] = np.maximum(common, np.append(common[1:], -1))
    seg, off = _windows(np.maximum(SPAN - right, SPAN - r), np.minimum(left, m))
    h = _string_hashes(body, at[seg] - off)
    _, inv, n = np.unique(h, return_inverse=True, return_counts=True)
    twice = n[inv] > 1
    return _intervals(seg[twice], off[twice])


def _hot_prints(row: pd.Series, splitters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, offset, fingerprint, times) of all strings of a chunk's segments whose anchors a splitter cuts."""
    left, right, times, body, offs = _load(row["segs"])
    _, over = _split(body, left, offs, splitters)
    k = np.flatnonzero(over)
    seg, off = _windows(SPAN - right[k], left[k])
    seg = k[seg] if len(k) else seg
    if not len(seg):
        return _NONE, _NONE, np.zeros(0, np.uint64), _NONE
    return seg, off, _string_hashes(body, offs[seg] + left[seg] - off) >> np.uint64(1), times[seg].astype(np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans array<struct<start,end>> of removed bytes, kept binary."""
    total = docs.select(F.lit(1)).count()
    chunks = chunk_count(total)
    bits = print_bits(total)
    d = chunked(docs, chunks, id_col, text_col)
    kept = stable(_segments(d, frequencies(d, _prints(bits), bits, chunks), bits, max(1, SAMPLE // chunks)))
    found = kept.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-found // BUCKET))
    keys = kept.select(F.explode("sample").alias("k"), F.xxhash64("chunk").alias("o")).orderBy("o").limit(SAMPLE) if buckets > 1 else None
    sample = sorted(bytes(r[0]) for r in keys.collect()) if keys is not None else []
    splitters = sorted({sample[len(sample) * b // buckets] for b in range(1, buckets)}) if sample else []

    def send(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for chunk, segs in zip(pdf["chunk"], pdf["segs"]):
            left, right, times, body, offs = _load(segs)
            bucket, over = _split(body, left, offs, splitters)
            for b in np.unique(bucket[~over]).tolist():
                k = np.flatnonzero((bucket == b) & ~over)
                rows.append((chunk, b, _pack(k.astype(np.int32), left[k].astype(np.uint8), right[k].astype(np.uint8), times[k], np.concatenate([body[offs[i] : offs[i + 1]] for i in k]))))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "data"])

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(x, np.int32, np.uint8, np.uint8, np.uint8, np.uint8) for x in pdf["data"]]
        left, right = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2))
        body = np.concatenate([p[4] for p in parts])
        seg, lo, hi = repeated_in_bucket(left, right, np.concatenate([p[3] for p in parts]), body, np.concatenate(([0], np.cumsum(left + right))))
        ends = np.concatenate(([0], np.cumsum([len(p[0]) for p in parts])))
        out = []
        for k, p in enumerate(parts):
            a, b = np.searchsorted(seg, ends[k]), np.searchsorted(seg, ends[k + 1])
            out.append(_pack(p[0][seg[a:b] - ends[k]], lo[a:b].astype(np.uint8), hi[a:b].astype(np.uint8)))
        return pd.DataFrame({"chunk": pdf["chunk"], "kind": 1, "part": 0, "data": out, "more": None})

    def hot(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        _, _, h, times = _hot_prints(pdf.iloc[0], splitters)
        u, inv = np.unique(h, return_inverse=True)
        return u, np.bincount(inv, weights=times, minlength=len(u)).astype(np.int64)

    schema = "chunk int, kind int, part int, data binary, more binary"
    to_buckets = kept.select("chunk", "segs").groupBy("chunk").applyInPandas(send, "chunk int, bucket int, data binary")
    back = to_buckets.groupBy("bucket").applyInPandas(sort, schema)
    own = kept.select("chunk", F.lit(0).alias("kind"), F.lit(0).alias("part"), F.col("segs").alias("data"), F.col("places").alias("more"))
    back = back.unionByName(own)
    if splitters:
        over = frequencies(kept.select("chunk", "segs"), hot, 63, chunks)
        back = back.unionByName(over.select("chunk", F.lit(2).alias("kind"), "part", F.col("counts").alias("data"), F.lit(None).cast("binary").alias("more")))

    def mark(key, docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        docs, raw = _texts(docs)
        sizes = np.array([len(x) for x in raw], np.int64)
        base = np.concatenate(([0], np.cumsum(sizes)))
        covered = np.zeros(base[-1] + 1, np.int64)
        mine = back[back["kind"] == 0]
        if len(mine):
            row = mine.iloc[0]
            left, right, times, _, _ = _load(row["data"])
            seg_of, doc, first = (x.astype(np.int64) for x in _unpack(row["more"], np.int32, np.int32, np.int32))
            twice = np.flatnonzero(times > 1)
            runs = [(twice, SPAN - right[twice], left[twice])]
            for x in back.loc[back["kind"] == 1, "data"]:
                runs.append(tuple(a.astype(np.int64) for a in _unpack(x, np.int32, np.uint8, np.uint8)))
            if (back["kind"] == 2).any():
                seg, off, h, _ = _hot_prints(pd.Series({"segs": row["data"]}), splitters)
                level = levels_of(back[back["kind"] == 2].rename(columns={"data": "counts"}))
                hit = level[np.searchsorted(np.unique(h), h)] > 1
                runs.append(_intervals(seg[hit], off[hit]))
            seg, lo, hi = (np.concatenate([r[i] for r in runs]) for i in range(3))
            by = np.argsort(seg, kind="stable")
            seg, lo, hi = seg[by], lo[by], hi[by]
            a, b = np.searchsorted(seg, seg_of), np.searchsorted(seg, seg_of, side="right")
            who = np.repeat(np.arange(len(seg_of)), b - a)
            which = np.arange(len(who)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[who]
            at = base[doc[who]] + first[who] + left[seg_of[who]]
            np.add.at(covered, at - hi[which], 1)
            np.add.at(covered, at - lo[which] + SPAN, -1)
        gone = np.cumsum(covered)[:-1] > 0
        rows = []
        for x, a, b in zip(raw, base[:-1], base[1:]):
            g = gone[a:b]
            if not g.any():
                rows.append((len(x), [], x))
                continue
            edge = np.diff(np.concatenate(([False], g, [False])).astype(np.int8))
            spans = [{"start": int(s), "end": int(e)} for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
            rows.append((len(x), spans, np.frombuffer(x, np.uint8)[~g].tobytes()))
        out = pd.DataFrame(rows, columns=["n_bytes", "spans", "kept"])
        out.insert(0, "doc_id", docs["doc_id"])
        return out

    return d.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(mark, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeats(table(spark, sf_dir, "documents"))
    return r.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
