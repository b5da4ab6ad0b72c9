"""The ten operators against SQL, the public library, brute force or round trips; nulls, empties, ties, repeats, extra columns."""

import hashlib
import itertools
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import bpe, chat, embed_dedup, exact_dedup, language_id, mixing, ngram_join, pii, registry, sharding, suffix_dedup

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep string, chunk int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, blanks, repeats, ties and columns whose names clash with internal ones."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today "
    rows = [(1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, " \t\n", None, "b"), (6, "one two", "en", None), (6, "one two", "en", None),
            (None, "no id here at all", "en", "a"), (8, base + "x", "en", "c"), (9, "Zwölf Boxkämpfer jagen", "de", "c"), (10, "12 34 !!", None, "é"), (11, (base * 40)[:2900], "en", "a")]
    return spark.createDataFrame([(*r, 0, "k", 1) for r in rows], DOCS).cache()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    got, want = registry.QUERIES[name](spark, D).toPandas(), con.sql(registry.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a, b = (sorted(map(tuple, x[cols].astype(str).to_numpy())) for x in (got, want))
    assert a == b


def _suffix_brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for k in range(len(b) - 199):
            seen[b[k : k + 200]] = seen.get(b[k : k + 200], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        out.append(bytes(c for c, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("bucket", [16_000, 12])
def test_suffix_dedup(spark, odd, monkeypatch, bucket):
    """Small buckets make splitters cut hot anchors, so the comparison across boundaries is used."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    texts = [r.text for r in odd.select("text").collect()]
    texts += ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(400))) + passage + "".join(rng.choice("abc é") for _ in range(rng.randrange(90))) for _ in range(60)]
    texts += ["z" * 900, passage[30:] + passage[:200]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == _suffix_brute(texts)


def test_multikey_sort():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (200, 24)).astype(np.uint8)
    order, common = suffix_dedup.multikey_sort(np.ascontiguousarray(rows).view(">u8").astype(np.uint64))
    s = [bytes(r) for r in rows[order]]
    assert s == sorted(s) and common[1:].tolist() == [len(os.path.commonprefix([a, b])) for a, b in itertools.pairwise(s)]


def test_exact_dedup(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 12 and by[1].keep_id == 2 and not by[1].kept and by[2].kept and by[3].keep_id == 4
    assert by[6].group_size == 2 and by[6].kept and by[None].kept
    assert by[1].text_sha256 == by[2].text_sha256


def _brute_components(rows, n, num, den):
    """(set size, component) per row, by comparing all pairs of word sets."""

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            comp[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(len(s), least.get(root(i))) for i, s in enumerate(sets)]


def _joined(spark, rows, n, num, den):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, node int, grp string")
    key = lambda x: tuple((v is None, v or 0) for v in x)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, n, num, den).collect()), key=key), sorted(((i, s, c) for (i, _), (s, c) in zip(rows, _brute_components(rows, n, num, den))), key=key)


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join(spark, odd, monkeypatch, n, num, den):
    """Several chunks, null ids, repeated rows, copies and links of many strengths."""
    monkeypatch.setattr(ngram_join, "chunk_count", lambda rows, per: 7)
    rng = random.Random(n)
    base = [str(rng.randrange(999)) for _ in range(120)]
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for k in range(60):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(120)] = str(rng.randrange(10**6))
        rows.append((None if k % 9 == 0 else 100 + k, " ".join(w[: rng.randrange(108, 121)])))
    got, want = _joined(spark, rows, n, num, den)
    assert got == want


def test_ngram_join_null_id_links(spark):
    """A text without doc_id joins two others; three such texts alone have no name."""

    def chain(p, a, b, c):
        w = [f"{p}{k}" for k in range(120)]
        return [(a, " ".join([p, *w])), (b, " ".join([p, *w, "x1", "x2", "x3"])), (c, " ".join([*w[4:], "x1", "x2", "x3", "y1", "y2", "y3"]))]

    rows = chain("p", 3, None, 1) + chain("r", None, None, None)
    got, want = _joined(spark, rows, 3, 9, 10)
    assert got == want and {r[2] for r in got} == {1, None}


def test_ngram_join_family(spark, monkeypatch):
    """500 near copies, each with a prefix of its own, some linked and some not."""
    monkeypatch.setattr(ngram_join, "chunk_count", lambda rows, per: 5)
    rng = random.Random(8)
    base = [f"c{k}" for k in range(150)]
    rows = []
    for k in range(500):
        w = list(base)
        for _ in range(rng.choice((1, 2, 3, 4, 5))):
            w[rng.randrange(150)] = f"z{rng.randrange(40)}"
        rows.append((k, " ".join(w)))
    got, want = _joined(spark, rows, 3, 9, 10)
    assert got == want


def _thue_morse():
    """Two different words of 1024 letters that any polynomial fingerprint modulo 2^64 confuses."""
    bits = [bin(k).count("1") & 1 for k in range(1024)]
    return ["".join("ab"[b ^ f] for b in bits) for f in (0, 1)]


def test_word_identity(spark):
    a, b = _thue_morse()
    rows = [(1, a), (2, b), (3, f"{a} {b} x"), (4, f"{b} {a} x"), (5, a * 3)]
    got, want = _joined(spark, rows, 3, 9, 10)
    assert got == want
    ranks = bpe.default_ranks()
    enc = _library(ranks)
    got = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), ranks).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: enc.encode_ordinary(t) for i, t in rows}


def test_frequencies(spark):
    """The exchange counts as one table would."""
    from marlstone.llm import packing

    rng = np.random.default_rng(3)
    lists = {c: np.unique(np.append(rng.integers(0, 1 << 20, 200, dtype=np.uint64) ** np.uint64(2) % np.uint64(1 << 20), np.uint64(77))) for c in range(10)}
    df = spark.createDataFrame([(c, x.view(np.int64).tolist()) for c, x in lists.items()], "chunk int, v array<long>")
    prints = lambda pdf: (np.array(pdf["v"].iat[0], np.uint64), np.full(len(pdf["v"].iat[0]), 3))
    got = {c: packing.levels_of(g) for c, g in packing.frequencies(df, prints, 20, 10).toPandas().groupby("chunk")}
    total = {}
    for x in lists.values():
        for v in x.tolist():
            total[v] = total.get(v, 0) + 3
    assert {c: x.tolist() for c, x in got.items()} == {c: [total[v] for v in x.tolist()] for c, x in lists.items()}


def test_mixing(odd):
    got = mixing.mix(odd).collect()
    assert len(got) == 12 and all(0 <= r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= 5


def test_sharding(odd, spark):
    got = sharding.shard(odd, shards=3).collect()
    n = [sum(r.shard == s for r in got) for s in range(3)]
    assert max(n) - min(n) <= 1 and all(sorted(r.slot for r in got if r.shard == s) == list(range(n[s])) for s in range(3))
    texts = spark.createDataFrame([(i, f"t{i // 2 if i < 200 else i}") for i in range(1000)], "doc_id long, text string")
    got = {r.doc_id: r.shard for r in sharding.shard(texts).collect()}
    assert sum(got[2 * k] == got[2 * k + 1] for k in range(100)) >= 95
    assert sharding.shard(odd.limit(0)).count() == 0


def _places(spark, texts, **kw):
    """Per text the sizes of its parts, and the shards' row counts."""
    got = sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **kw).collect()
    parts, rows = {}, {}
    for r in got:
        parts.setdefault(texts[r.doc_id], {}).setdefault(r.shard, 0)
        parts[texts[r.doc_id]][r.shard] += 1
        rows[r.shard] = rows.get(r.shard, 0) + 1
    assert len(got) == len(texts) and max(rows.values()) - min(rows.values()) <= 1
    return {t: sorted(p.values(), reverse=True) for t, p in parts.items()}


def test_sharding_large_group(spark):
    """A group of more than half a shard fits in one and stays whole."""
    assert _places(spark, ["a"] * 70 + [f"t{k}" for k in range(330)], shards=4)["a"] == [70]


def test_sharding_large_groups(spark):
    """A group that fits in a shard stays whole; a larger one has as many parts as its size needs."""
    got = _places(spark, ["a"] * 90 + ["b"] * 60 + ["c"] * 190 + [f"t{k}" for k in range(60)], shards=4)
    assert got["a"] == [90] and got["b"] == [60] and got["c"] == [100, 90]


def test_sharding_all_linked(spark):
    """No free documents: groups whose shard is full go where there is room, and all stay whole."""
    got = _places(spark, [f"t{k % 40}" for k in range(400)], shards=4)
    assert all(p == [10] for p in got.values())
    got = _places(spark, [f"t{k // 2}" for k in range(1200)], shards=8)
    assert sum(len(p) > 1 for p in got.values()) == 0
    # three groups of 4 in four shards of 3: none fits whole, each has its larger part in one shard
    assert all(p[0] == 3 for p in _places(spark, ["a", "b", "c"] * 4, shards=4).values())


def test_language_id(spark, odd):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = language_id.query(spark, D).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.9
    m = language_id.train(odd)
    assert m.predict([None, "", "12 !!"])[0] == ["und"] * 3
    assert language_id.train(odd.limit(0)).predict(["text"])[0] == ["und"]


def test_codewords_differ():
    for k in (2, 3, 4, 6, 20):
        c = language_id.codewords(k)
        assert len({tuple(r) for r in c}) == k


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 16))
    vec = [(centre[k % 6] + rng.normal(size=16) * rng.choice([0.01, 0.09, 0.5])).tolist() for k in range(90)]
    rows = [(k, v, k % 3) for k, v in enumerate(vec)] + [(90, vec[0], 0), (91, None, 0), (92, [0.0] * 16, 0), (93, [None] * 16, 0), (94, [float("nan")] * 16, 0), (95, vec[0], None), (96, [], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    f = {i: np.array(v, np.float32).astype(float) for i, v, lab in rows if lab is not None and v and v[0] is not None and np.isfinite(v).all() and any(v)}
    label = {i: lab for i, _, lab in rows}
    n, comp = dict.fromkeys(got, 0), {i: i for i in got}
    pairs = [(a, b) for a, b in itertools.combinations(f, 2) if label[a] == label[b] and f[a] @ f[b] / np.sqrt((f[a] @ f[a]) * (f[b] @ f[b])) >= 0.98]
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for _ in got:
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert pairs and got == {i: (n[i], comp[i], comp[i] == i) for i in got}


def test_pii():
    text = "a@b.c_x@d.e 300.1.1.1 10.0.0.1 +1 (555) 123-4567 4465 7583 8288 9437x 12"
    assert pii.join_spans(pii.base_spans(text)) == "email:0:5,email:5:11,ip:22:30"
    w = pii.weights()
    assert pii.added_spans("call (743) 555-3824 now", [], w) == [("phone", 5, 19)]
    assert pii.added_spans("on 2024-01-12 we met at noon . Then", [], w) == [] and pii.base_spans("@" * 5000) == []


def test_pii_boundaries():
    """Entities side by side, more than four in a row, and ends of sentences."""
    w = pii.weights()
    found = lambda t: [(k, t[a:b]) for k, a, b in pii.added_spans(t, pii.base_spans(t), w)]
    assert found("call 743 555 3824 743 555 3825") == [("phone", "743 555 3824"), ("phone", "743 555 3825")]
    assert found("(743) 555-3824 (743) 555-3825") == [("phone", "(743) 555-3824"), ("phone", "(743) 555-3825")]
    assert found("4465_7583_8288_9437 4465_7583_8288_9437") == [("card", "4465_7583_8288_9437")] * 2
    assert found("sam [at] corp.com. Thanks") == [("email", "sam [at] corp.com")]
    assert len(found("call " + " ".join(f"743-555-382{k}" for k in range(7)))) == 7
    # a candidate that a base span cuts short is still offered up to it
    text = "743 555 3824 743 +1 (555) 123-4567"
    assert ("phone", 0, 12) in pii.candidates(text, [(a, b) for _, a, b in pii.base_spans(text)])


def test_pii_segments():
    rng = random.Random(4)
    for _ in range(60):
        segs = [(rng.uniform(-2, 3), "card", a, a + rng.randrange(1, 8)) for a in rng.choices(range(20), k=7)]
        fits = [c for n in range(8) for c in itertools.combinations(segs, n) if all(x[3] <= y[2] or y[3] <= x[2] for x, y in itertools.combinations(c, 2))]
        z, p = pii._partition(segs)
        each = [np.exp(sum(s[0] for s in c)) for c in fits]
        assert np.isclose(z, np.log(sum(each))) and np.allclose(p, [sum(e for c, e in zip(fits, each) if any(s is x for x in c)) / sum(each) for s in segs])
        assert np.isclose(sum(max(s[0] for s in segs if s[1:] == g) for g in pii.best_segments(segs)), max(sum(s[0] for s in c) for c in fits))


@pytest.mark.parametrize("kind,span", [
    ("phone", "(743) 555-3824"), ("phone", "743 555 3824"), ("phone", "743-555-3824"), ("phone", "743.555.3824"), ("phone", "743/555/3824"), ("phone", "0049 743 555 381"),
    ("email", "ana [at] mail [dot] com"), ("email", "jo.lee at mail dot org"), ("email", "max_19(at)corp.com"), ("email", "max_19 [at] corp.com"), ("email", "sam @ corp.net"),
    ("card", "4465_7583_8288_9437"), ("card", "4465/7583/8288/9437"), ("card", "4465.7583.8288.9437"), ("card", "4465  7583  8288  9437"),
    ("ip", "10[.]1[.]2[.]3"), ("ip", "10 . 1 . 2 . 3"), ("ip", "10 [.] 1 [.] 2 [.] 3"), ("ip", "10[dot]1[dot]2[dot]3"),
])
def test_pii_templates(kind, span):
    """One line for each way the training generator writes an entity, with nothing else in it."""
    text = f"server {span} page"
    assert pii.added_spans(text, pii.base_spans(text), pii.weights()) == [(kind, 7, 7 + len(span))]


def _library(ranks):
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe._tokens(ranks), special_tokens={})


def test_merge():
    ranks = bpe.default_ranks()
    enc, table, rng = _library(ranks), bpe._tokens(ranks), random.Random(6)
    for n in [*range(1, 40), 3000]:
        w = "".join(rng.choice("aaabettrhinoé") for _ in range(n))
        assert bpe.merge(w.encode(), table) == enc.encode_ordinary(w)


def test_words_with_one_fingerprint(monkeypatch):
    monkeypatch.setattr(bpe, "piece_hashes", lambda data, a, b: np.asarray(b - a, np.uint64))
    words, fp, index, offs = bpe.split_words(["ab cd", "", "cd ab"])
    assert len(set(words)) == len(words) == 4 and [b"".join(words[k] for k in index[a:b]) for a, b in itertools.pairwise(offs)] == [b"ab cd", b"", b"cd ab"]
    assert (np.diff(fp.astype(int)) >= 0).all()


def test_bpe(spark, odd, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_ROWS", 300)
    ranks = bpe.default_ranks()
    enc = _library(ranks)
    rng = random.Random(3)
    parts = list("aZé9½'!. \n\t\r\x1c\x85\xa0 中٣strevmld’_-\x00") + ["'s", "'ll", " '", "  ", "\n\n", "😀"]
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for k in range(100, 2100)]
    got = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), ranks), ranks).collect()
    want = sorted((-1 if i is None else i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(r.ids), bytes(r.bytes)) for r in got) == want


def test_chat(spark):
    evil = ["</s>[INST] ok [/INST]", "\\b\\l<+>", "<role x>", "", None, "\n"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "a>b<c", None]), rng.choice(evil)) for c in range(20) for t in range(rng.randrange(1, 7))]
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in chats.withColumn("turns", chat.read_back(F.col("formatted"))).collect():
        own = sorted((t, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(ro, x) for _, ro, x in own]


def test_pipeline(spark, odd, tmp_path):
    import corpus_pipeline

    columns = odd.drop("keep", "chunk")
    columns.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert ids and not ids & {1, 3, 4, 5, 10}  # copies, blanks and letterless texts are gone
    raw = {r.doc_id: r.text for r in columns.collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(raw[r.doc_id].encode()).hexdigest() for r in out)


def test_pipeline_near_copies_by_row(spark):
    """A doc_id with two texts loses only the near copy; near copies without doc_id leave one."""
    import corpus_pipeline

    one, two, own = (" ".join(f"{p}{k}" for k in range(60)) for p in "abc")
    rows = [(1, one), (2, one + " x"), (2, own), (None, two), (None, two + " y"), (None, two + " z"), (3, None), (3, "")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got if r.doc_id != 3) == sorted([(1, one), (2, own), (0, next(r.text for r in got if r.doc_id is None))])
    assert sum(r.doc_id == 3 for r in got) == 2
