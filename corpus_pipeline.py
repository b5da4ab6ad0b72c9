"""A corpus from raw documents to token ids: five stages, each on all rows the one before kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. run() writes each
stage's rows as Parquet in the shared folder and reads them again for the next. Nulls, very long texts and empty tables
are handled as the operators' docstrings say. Rows are told apart by doc_id and text: a repeated doc_id with different
texts is as many documents, rows that repeat both are one, and null doc_ids are told apart by their texts. Extra columns
of docs, whatever their names, are carried through the filtering stages and the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from marlstone.llm.common import stable, table

#: Below this score an ambiguous language answer rejects the document.
SURE = 0.5
#: Documents that one task of the last stage holds at a time: executors still hold what the stages before left on their heaps.
CHUNK_ROWS = 750
#: Most keys of dropped rows (id, flag, 32-byte digest: about 100 bytes each) that are broadcast.
BROADCAST_ROWS = 500_000


def _own(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keys(doc_id: Column, sha: Column) -> list[Column]:
    """What tells rows apart, without nulls: doc_id, whether it is missing, the text's digest."""
    return [F.coalesce(doc_id.cast("long"), F.lit(-1)), doc_id.isNull(), sha]


def _without(docs: DataFrame, sha: Column, told: DataFrame) -> DataFrame:
    """docs less the rows that `told` (id, none, sha, kept) names; of rows that repeat a kept one, one stays."""
    keys = [_own(docs, f"row_{k}") for k in ("id", "none", "sha")]
    named = docs.withColumns(dict(zip(keys, _keys(F.col("doc_id"), sha))))
    told = told.withColumnsRenamed(dict(zip(("id", "none", "sha"), keys)))
    # below a bound the rows that go are sent to every executor and texts stay; above it both sides are dealt by key
    gone = told.select(keys)
    kept = named.join(F.broadcast(gone) if told.count() <= BROADCAST_ROWS else gone, keys, "left_anti")
    repeated = told.where("kept").select(keys)
    if not repeated.isEmpty():
        kept = kept.unionByName(named.join(repeated, keys, "left_semi").dropDuplicates(keys))
    return kept.select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter in them, or two codewords equally near."""
    p = _own(docs, "found")
    found = docs.withColumn(p, language_id.identify(F.col("text"), language_id.train(docs)))
    return found.where((F.col(f"{p}.lang") != "und") & ~(F.col(f"{p}.ambiguous") & (F.col(f"{p}.score") < SURE))).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, once.

    Only ids and digests of the rows that go, or that repeat a kept row, meet the documents, so whole texts need not move again.
    """
    d = exact_dedup.exact_dedup(docs)
    id_, none, sha = _keys(F.col("doc_id"), F.unhex("text_sha256"))
    told = d.select(id_.alias("id"), none.alias("none"), sha.alias("sha"), "kept").groupBy("id", "none", "sha").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("c"))
    return _without(docs, F.unhex(F.sha2(exact_dedup.normal(F.col("text")), 256)), stable(told.where("not kept or c > 1")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the row with the smallest doc_id stays, null ids last, once."""
    parts = ngram_join.jaccard_components(docs, n=5, num=4, den=5).where("root is not null")
    id_, none, sha = _keys(F.col("doc_id"), F.col("text_sha256"))
    parts = stable(parts.select(id_.alias("id"), none.alias("none"), sha.alias("sha"), "root"))
    order = F.struct("none", "id", "sha")
    first = stable(parts.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    told = parts.join(first, "root").select("id", "none", "sha", (order == F.col("first")).alias("kept")).groupBy("id", "none", "sha").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("c"))
    return _without(docs, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), stable(told.where("not kept or c > 1")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut counts as taken whole."""
    taken = mixing.mix(docs, keep=tuple(docs.columns)).where("taken > 0")
    times = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    return taken.select(F.explode(times), *[F.col(f"keep_{c}") for c in docs.columns]).select(*[F.col(f"keep_{c}").alias(c) for c in docs.columns])


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(docs, bpe.default_ranks(), with_bytes=True, chunk_rows=CHUNK_ROWS))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

#: The classifier of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
