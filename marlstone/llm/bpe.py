"""Byte-level BPE encoding and decoding over a global table of distinct words.

1. Documents are dealt in chunks; each chunk splits its whole texts into pre-tokens with positions and sends each
   distinct one, packed, towards a hash range of words. Chunks meet in blocks first, which unite their words, and blocks
   meet in the ranges (packing.grid), so a word that every chunk has reaches no task more often than about sqrt(chunks) times.
2. Each range encodes each distinct word once, by merging the pair of least rank until none is left; ids go back the
   same way, to the blocks and to the chunks, in the order sent.
3. The chunk's texts meet those ids, and each document's ids are reassembled by position.
Decoding joins ids with the table of token bytes, whose size is the vocabulary's.

Null and empty texts give no ids. Repeated rows and null doc_ids are rows of their own. An empty table gives no
rows, extra columns are not read, very long texts are split in one piece. Words are ordered by 64-bit fingerprints and
told apart by their bytes, so clashes change nothing. Unpaired surrogates cannot occur in Spark strings.

The split follows the pattern of the rank files: letters, numbers, others, each with one space before; contractions
('s 't 're 've 'm 'll 'd) where an apostrophe opens a pre-token; white space up to the last character before a word.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import table
from marlstone.llm.packing import borders, chunk_count, chunked, cuts_of, docs_of, grid, squeeze, sub_borders, unsqueeze
from marlstone.llm.shingles import piece_hashes

#: What may follow an apostrophe in a contraction.
SHORT = ("s", "t", "re", "ve", "m", "ll", "d")
VOCABULARY = "byte_bpe_50k.tiktoken"
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Documents of a chunk: more of them share more of their words, which travel once per chunk.
CHUNK_ROWS = 1500
_SLICE = 1 << 18


@functools.cache
def _classes() -> np.ndarray:
    import regex

    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def boundaries(codes: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Start offsets of the pre-tokens of an array of code points; fresh: offsets where a text starts."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[codes]
    new_text = np.zeros(n + 1, bool)
    new_text[fresh[fresh < n]] = True
    new_text[n] = True
    start = new_text[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    last_space = np.flatnonzero((kind == SPACE) & ~new_text[1:] & (np.append(kind[1:], SPACE) != SPACE))
    start[last_space] = True  # the last white space before a word stands apart,
    joined = last_space[codes[last_space] == 32] + 1
    start[joined] = False  # or with the word if it is a space
    quote = np.flatnonzero((codes == 39) & start)
    if len(quote):
        padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
        a, b = padded[quote + 1], padded[quote + 2]
        ok1 = ~new_text[quote + 1]
        ok2 = ok1 & ~new_text[np.minimum(quote + 2, n)]
        size = np.zeros(len(quote), np.int64)
        for s in SHORT:
            hit = (ok1 & (a == ord(s))) if len(s) == 1 else (ok2 & (a == ord(s[0])) & (b == ord(s[1])))
            size[hit & (size == 0)] = len(s)
        hit = size > 0
        q, size = quote[hit], size[hit]
        start[q + 1] = False
        after = q + 1 + size
        # letters go on after the contraction as a pre-token of their own
        start[after[after < n]] = True
    return np.flatnonzero(start)


def _same(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> bool:
    """Whether each piece has the bytes of the piece `first` names for it; a bounded number of bytes at a time."""
    size, shift = end - begin, begin[first] - begin
    if (size != size[first]).any():
        return False
    cuts = np.append(np.searchsorted(begin, np.arange(0, len(raw), _SLICE)), len(begin))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if j > i:
            at = np.repeat(shift[i:j], size[i:j])
            at += np.arange(begin[i], end[j - 1])
            if (raw[at] != raw[begin[i] : end[j - 1]]).any():
                return False
    return True


def split_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pre-tokens by fingerprint and bytes, their fingerprints, index of each pre-token's word in order of
    position, offsets of the texts' pre-tokens)."""
    bodies, begins, prints, counts = [], [], [], []
    i = base = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < _SLICE):
            size += len(texts[j])
            j += 1
        text = "".join(texts[i:j])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        cuts = np.cumsum([0] + [len(t) for t in texts[i:j]])
        start = boundaries(codes, cuts[:-1])
        body = text.encode("utf-8")
        raw = np.frombuffer(body, np.uint8)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        offs = np.concatenate(([0], np.cumsum(width)))
        a, b = offs[start], np.append(offs[start[1:]], offs[-1]) if len(start) else offs[:0]
        prints.append(piece_hashes(raw, a, b))
        bodies.append(body), begins.append(a + base)
        counts.append(np.diff(np.searchsorted(start, cuts)))
        base += len(body)
        i = j
    if not bodies:
        return [], np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    data, begin = b"".join(bodies), np.concatenate(begins)
    end = np.append(begin[1:], base)
    fp = np.concatenate(prints)
    u, first, index = np.unique(fp, return_index=True, return_inverse=True)
    words = [data[x:y] for x, y in zip(begin[first].tolist(), end[first].tolist())]
    if not _same(np.frombuffer(data, np.uint8), begin, end, first[index]):  # two words share a fingerprint
        every = [(int(h), data[x:y]) for h, x, y in zip(fp, begin.tolist(), end.tolist())]
        place = {w: k for k, w in enumerate(sorted(set(every)))}
        words, u = [w for _, w in place], np.array([h for h, _ in place], np.uint64)
        index = np.array([place[w] for w in every], np.int64)
    return words, u, index, np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: of all neighbouring pieces the pair of least rank, leftmost first, is joined until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that starts at each place; end 0: gone
    heap = [(ranks[p], k, k + 2) for k in range(n - 1) if (p := word[k : k + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, a, b = heapq.heappop(heap)
        mid = end[a]
        if not mid or mid >= n or end[mid] != b:
            continue  # one of the two has been joined with another since
        end[a], end[mid] = b, 0
        if b < n:
            before[b] = a
            p = word[a : end[b]]
            if p in ranks:
                heapq.heappush(heap, (ranks[p], a, end[b]))
        if a:
            p = word[before[a] : b]
            if p in ranks:
                heapq.heappush(heap, (ranks[p], before[a], b))
    out, k = [], 0
    while k < n:
        out.append(ranks[word[k : end[k]]])
        k = end[k]
    return out


def _pack(lens, body: bytes) -> bytes:
    n = np.asarray(lens, np.uint32)
    return squeeze(len(n).to_bytes(4, "little") + n.tobytes() + body)


def _unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    raw = unsqueeze(data)
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, np.uint32, n, 4).astype(np.int64), raw[4 + 4 * n :]


def rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@functools.cache
def _tokens(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}


@functools.cache
def token_bytes(ranks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The table of token bytes by id: all bytes in a row and where each id's begin."""
    of = {i: b for b, i in _tokens(ranks).items()}
    parts = [of.get(i, b"") for i in range(max(of) + 1)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def _words(packed: bytes) -> list[bytes]:
    lens, body = _unpack(packed)
    ends = np.cumsum(lens).tolist()
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _pack_words(words: list[bytes]) -> bytes:
    return _pack([len(w) for w in words], b"".join(words))


def _pack_ids(ids: list[bytes]) -> bytes:
    """Ids in four byte planes, which compress better than the numbers."""
    planes = np.frombuffer(b"".join(ids), np.uint8).reshape(-1, 4).T
    return _pack([len(x) >> 2 for x in ids], np.ascontiguousarray(planes).tobytes())


def _flat_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    lens, body = _unpack(packed)
    return lens, np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(4, -1).T).view(np.int32).reshape(-1)


def _ids(packed: bytes) -> list[bytes]:
    lens, flat = _flat_ids(packed)
    body, ends = flat.tobytes(), (4 * np.cumsum(lens)).tolist()
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _parted(words: list[bytes], fp: np.ndarray, first: np.ndarray) -> list[tuple[int, list[int]]]:
    """(range, indices of its words in order of their bytes, in which they compress best) of words sorted by fingerprint."""
    return [(r, sorted(range(a, b), key=words.__getitem__)) for r, a, b in cuts_of(fp, first)]


def bytes_of(ids, ranks: bytes) -> bytes:
    """Ids joined with the table of token bytes."""
    body, begin = token_bytes(ranks)
    ids = np.asarray(ids, np.int64)
    a = begin[ids]
    n = begin[ids + 1] - a
    ends = np.cumsum(n)
    return body[np.repeat(a - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def encode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = False, chunk_rows: int = 0) -> DataFrame:
    """One row per document: doc_id, ids array<int>; with_bytes adds what decode() would, in the task that has the ids.

    A smaller chunk_rows (default CHUNK_ROWS) takes less memory and sends words more often.
    """
    chunks = chunk_count(docs.select(F.lit(1)).count(), chunk_rows or CHUNK_ROWS)
    blocks, subs = grid(chunks)
    first = borders(0, 1 << 64, blocks)
    d = chunked(docs, chunks, id_col, text_col)

    def send(key, pdf):
        words, fp, _, _ = split_words(list(docs_of(pdf)["text"]))
        rows = [(key[0] % blocks, p, key[0], _pack_words([words[k] for k in mine])) for p, mine in _parted(words, fp, first)]
        return pd.DataFrame(rows, columns=["block", "part", "chunk", "words"])

    def united(part, pdf):
        """(sub-range, its words) of the distinct words of a block and range."""
        words = sorted({w for x in pdf["words"] for w in _words(x)})
        ends = np.cumsum([len(w) for w in words])
        fp = piece_hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], ends[:-1])), ends)
        by = np.argsort(fp, kind="stable")
        words = [words[k] for k in by.tolist()]
        return [(s, [words[k] for k in mine]) for s, mine in _parted(words, fp[by], sub_borders(part, 64, blocks, subs))]

    def unite(key, pdf):
        rows = [(*key, s, _pack_words(mine)) for s, mine in united(key[1], pdf)]
        return pd.DataFrame(rows, columns=["block", "part", "sub", "words"])

    def answer(pdf):
        table, ids, out = _tokens(ranks), {}, []
        for packed in pdf["words"]:
            got = []
            for w in _words(packed):
                found = ids.get(w)
                if found is None:
                    found = ids[w] = np.array(merge(w, table), np.int32).tobytes()
                got.append(found)
            out.append(_pack_ids(got))
        return pdf[["block", "part", "sub"]].assign(ids=out)

    def back(key, sent, found):
        words = [w for _, mine in united(key[1], sent) for w in mine]
        ids = dict(zip(words, [x for packed in found.sort_values("sub")["ids"] for x in _ids(packed)]))
        return sent[["chunk", "part"]].assign(ids=[_pack_ids([ids[w] for w in _words(x)]) for x in sent["words"]])

    def join(key, docs, ids):
        docs = docs_of(docs)
        words, fp, flat, offs = split_words(list(docs["text"]))
        order = np.array([k for _, mine in _parted(words, fp, first) for k in mine], np.int64)
        found = [_flat_ids(x) for x in ids.sort_values("part")["ids"]]
        got = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
        all_ids = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int32)
        lens, begin = np.empty_like(got), np.empty_like(got)
        lens[order], begin[order] = got, np.cumsum(got) - got
        n = lens[flat]
        ends = np.concatenate(([0], np.cumsum(n)))
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        at = np.repeat((begin[flat] - ends[:-1]).astype(kind), n)
        at += np.arange(ends[-1], dtype=kind)
        out = all_ids[at]
        cut = ends[offs]
        res = pd.DataFrame({"doc_id": docs["doc_id"], "ids": [out[a:b] for a, b in zip(cut[:-1], cut[1:])]})
        return res.assign(bytes=[bytes_of(x, ranks) for x in res["ids"]]) if with_bytes else res

    sent = d.groupBy("chunk").applyInPandas(send, "block int, part int, chunk int, words binary")
    met = sent.groupBy("block", "part").applyInPandas(unite, "block int, part int, sub int, words binary")
    answers = met.groupBy("part", "sub").applyInPandas(answer, "block int, part int, sub int, ids binary")
    ids = sent.groupBy("block", "part").cogroup(answers.groupBy("block", "part")).applyInPandas(back, "chunk int, part int, ids binary")
    return d.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInPandas(join, "doc_id long, ids array<int>" + ", bytes binary" * with_bytes)


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """Adds `bytes` to rows with an `ids` column: a join with the table of token bytes, a batch of ids at a time."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def look_up(batches):
        for pdf in batches:
            yield pdf.assign(bytes=[bytes_of(x, ranks) for x in pdf["ids"]])

    return encoded.mapInPandas(look_up, StructType([*encoded.schema.fields, StructField("bytes", BinaryType())]))


def digest(decoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def default_ranks() -> bytes:
    import public_tokenizers

    return rank_file(public_tokenizers.path(VOCABULARY))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = default_ranks()
    return digest(encode(table(spark, sf_dir, "documents"), ranks, with_bytes=True))
