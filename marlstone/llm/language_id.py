"""Language ID by error-correcting output codes over binary n-gram classifiers.

Every language gets a codeword of bits. For each bit a binary classifier weighs hashed letter 1- to 3-grams by
the log-odds of the languages with a 1 against those with a 0, from counts over all training documents (each
language weighs the same, whatever its share). A text's margin for a bit is the mean weight of its n-grams,
scaled so that the classes expect +1 and -1. Decoding adds, per codeword, each bit's logistic loss times the
bit's separation and takes the least; score is the softmax of the negative losses, and a text is flagged
ambiguous when the runner-up is close.

Trained only on text and non-null lang of documents whose crc32(doc_id as text) mod 3 is not 1. Null texts and
texts without a letter give `und`, score 0. Rows are handled one by one, so repeated rows and ids change
nothing; an empty training table makes every answer `und`; ties go to the first language in code point order.
What reaches the driver is one count per language and n-gram bucket: bounded by BUCKETS times the number of
distinct lang values, independent of the number of documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import table

BUCKETS = 1 << 16
#: Most languages for which all splits into two classes become bits; beyond, as many seeded random splits.
EXHAUSTIVE = 6
STEEPNESS = 4.0
#: Share of the gap between the two best codewords below which an answer counts as ambiguous.
CLOSE = 0.05
_SLICE = 1 << 19
_BLANK = bytes(32 if c < 128 and not chr(c).isalpha() else c for c in range(256))


def ngrams(texts: list[str | None], buckets: int = BUCKETS):
    """Slices of texts as (indices of the texts, bucket of each n-gram, offsets of each text's n-grams)."""
    raw = [b" " + (t or "").lower().encode("utf-8", "replace").translate(_BLANK) + b"   " for t in texts]
    i = 0
    while i < len(raw):
        j, size = i, 0
        while j < len(raw) and (j == i or size + len(raw[j]) < _SLICE):
            size += len(raw[j])
            j += 1
        b = np.frombuffer(b"".join(raw[i:j]) + b"  ", np.uint8).astype(np.uint32)
        n = len(b) - 2
        one, two = b[:n], b[:n] * np.uint32(257) + b[1 : n + 1] + np.uint32(1 << 10)
        three = (two * np.uint32(263) + b[2:]) * np.uint32(2654435761) >> np.uint32(7)
        idx = np.stack((one, two, three), 1) & np.uint32(buckets - 1)
        yield range(i, j), idx, np.concatenate(([0], np.cumsum([len(x) for x in raw[i:j]])))
        i = j


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def codewords(k: int) -> np.ndarray:
    """k rows of +1/-1 bits, no two alike, each bit splitting the languages."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= EXHAUSTIVE:
        bits = [[1, *(1 if m >> i & 1 else -1 for i in range(k - 1))] for m in range(2 ** (k - 1) - 1)]
        return np.array(bits, float).T
    rng = np.random.default_rng(7)
    want = max(24, int(10 * np.ceil(np.log2(k))))
    for _ in range(1000):
        c = rng.choice([-1.0, 1.0], (k, want))
        near = min(np.sum(a != b) for a, b in itertools.islice(itertools.combinations(c, 2), 20000))
        if near >= want // 5 and np.all(np.abs(c.sum(0)) < k):
            break
    return c


class Model:
    """langs, code (langs x bits), weights (buckets x bits), middle, half, alpha (bits)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs))
        p = counts + 0.5
        p = p / p.sum(1, keepdims=True) if len(langs) else p
        w, mid, half = [], [], []
        for bit in self.code.T:
            yes, no = p[bit > 0].mean(0), p[bit < 0].mean(0)
            x = np.log(yes) - np.log(no)
            up, down = float(yes @ x), float(no @ x)
            w.append(x), mid.append((up + down) / 2), half.append(max((up - down) / 2, 1e-9))
        self.weights = np.array(w, np.float32).T.reshape(counts.shape[1] if counts.size else 0, len(w))
        self.middle, self.half = np.array(mid), np.array(half)
        self.alpha = self.half / self.half.sum() if len(w) else self.half

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, close = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
        real = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.langs:
            return lang, score, close
        if len(self.langs) == 1:
            for k in real:
                lang[k], score[k] = self.langs[0], 1.0
            return lang, score, close
        for part, idx, offs in ngrams([texts[k] for k in real]):
            sums = np.empty((len(part), self.weights.shape[1]))
            for k in range(0, len(part), 16):
                own = [np.bincount(idx[a:b].reshape(-1), minlength=len(self.weights)) for a, b in zip(offs[k : k + 16], offs[k + 1 : k + 17])]
                sums[k : k + 16] = np.array(own, np.float32) @ self.weights
            z = (sums / (3 * np.diff(offs))[:, None] - self.middle) / self.half
            loss = np.stack([(self.alpha * np.logaddexp(0, -STEEPNESS * c * z)).sum(1) for c in self.code], 1)
            best = loss.argmin(1)
            e = np.exp(STEEPNESS * (loss.min(1, keepdims=True) - loss))
            prob = e / e.sum(1, keepdims=True)
            two = np.sort(prob, 1)[:, -2:]
            for n, k in enumerate(part):
                at = real[k]
                lang[at], score[at], close[at] = self.langs[best[n]], float(prob[n, best[n]]), bool(two[n, 1] - two[n, 0] < CLOSE)
        return lang, score, close


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    rows = docs.where(~held_out(F.col(id_col))).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, group in pdf.groupby("lang")["text"]:
                own = total.setdefault(name, np.zeros(buckets, np.int64))
                for _, idx, _ in ngrams(list(group), buckets):
                    own += np.bincount(idx.reshape(-1), minlength=buckets)
        for name, own in total.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": own[at]})

    found = rows.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique(), key=lambda x: x.encode())
    counts = np.zeros((len(langs), buckets))
    for k, name in enumerate(langs):
        own = found[found["lang"] == name]
        counts[k, own["bucket"].to_numpy()] = own["n"].to_numpy()
    return Model(langs, counts)


def identify(text: Column, model: Model) -> Column:
    """struct<lang string, score double, ambiguous boolean> of a text column."""

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score, close = model.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang": lang, "score": score, "ambiguous": close})

    return run(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(F.col("text"), train(docs)).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.ambiguous").alias("ambiguous"))
