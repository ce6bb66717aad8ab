"""From raw documents to packed training sequences: quality classifier, language ID, near-duplicate
groups, benchmark decontamination, best-fit packing.

A stage works on all that the one before kept. What a stage rejects is written as keys before it returns, and
the broadcasts and tables behind it are removed, so the driver holds one stage's state at a time. A row is
known by its id and the hash of its text. Defined results: rows that share an id are judged by their own
text; null text is rejected as a quality; of a near-duplicate group that document stays that has the
smallest id (null last), and of repeated rows one, the first by its other columns; an empty table passes
through; columns of any other name are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm import decontam, kneser, langid, packing, partenum, store

#: No SQL: the classifier, the language model of stage 2 and the packing plan are fitted numerically.
ORACLE_SQL = None


def _row_id() -> Column:
    return F.xxhash64("doc_id", store.text_key("text"))


def _split(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose row id is surely not among ``ids``, and the others: only the latter need a join,
    so whole texts stay where they are."""
    mark = store.unused(docs, "_mark")
    d = decontam.marked(docs, ids, _row_id(), mark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return d.where(~F.col(mark)).select(*columns), d.where(F.col(mark)).select(*columns)


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text key are not among ``rejected`` (doc_id, text_key)."""
    if not rejected.take(1):
        return docs
    sure, open_ = _split(docs, rejected.select(F.xxhash64("doc_id", "text_key").alias("id")))
    key = store.unused(docs, "_key")
    d = open_.withColumn(key, store.text_key("text")).alias("d")
    r = rejected.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_of")).alias("r")
    left = d.join(r, F.col("d.doc_id").eqNullSafe(F.col("r._id")) & (F.col(f"d.{key}") == F.col("r._of")), "left_anti")
    return sure.unionByName(left.select(*[F.col(f"d.`{c}`") for c in docs.columns]))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang", store.text_key("text").alias("text_key"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def bad():
        out = kneser.classify(_keyed(docs), kneser.trusted_ids(spark, sf_dir), keep=("text_key",))
        return out.where("not kept").select("doc_id", "text_key").distinct()

    return _without(docs, store.settled(bad, "rejected"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, quantile: float = 0.0005, slack: float = 0.8, least: int = 20, bounds: tuple[int, ...] = (64, 512)) -> DataFrame:
    """Texts without letters go, and those whose calibrated score stands out as low: under ``slack`` times the
    ``quantile`` of the scores of labelled texts that the model has not seen, of the same predicted
    language and length (``bounds`` in bytes); where there are under ``least`` those of the length over all
    languages hold, then all."""

    def bad():
        seen = ~langid.held_out("doc_id", 4)
        own = _keyed(docs).withColumn("new", ~seen & F.col("lang").isNotNull()).withColumn("size", sum((F.octet_length("text") > b).cast("int") for b in bounds))
        out = store.table(langid.predict(own, langid.fit(own, seen), keep=("doc_id", "text_key", "new", "size")), "languages")
        low = F.percentile_approx("score", quantile, 100_000)
        known = out.where("new and lang_pred <> 'und'")
        near = known.groupBy("lang_pred", "size").agg(low.alias("own"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
        wide = known.groupBy("size").agg(low.alias("like"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
        # a row for each language and length
        out = out.join(F.broadcast(near), ["lang_pred", "size"], "left").join(F.broadcast(wide), "size", "left").crossJoin(F.broadcast(known.agg(low.alias("any"))))
        return out.where((F.col("lang_pred") == "und") | (F.col("score") < slack * F.coalesce("own", "like", "any", F.lit(0.0)))).select("doc_id", "text_key").distinct()

    return _without(docs, store.settled(bad, "rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are grouped under ids of their own: ``doc_id`` where surely no other row has it, as plain numbers
    take less room than hashes in what is shuffled, else a negative hash of id and text, so that rows that
    share an id are apart."""

    def bad():
        number = F.col("doc_id").try_cast("long")
        shared = store.table(docs.groupBy(number.alias("id")).count().where("id is not null and count > 1").select(F.xxhash64("id").alias("id")), "shared")
        own = decontam.marked(docs.select("doc_id", "text"), shared, F.xxhash64(number), "_shared")
        hashed = _row_id().bitwiseOR(F.lit(-(1 << 63)))
        own = own.select("doc_id", "text", F.when(~F.col("_shared") & (number >= 0), number).otherwise(hashed).alias("id"))
        group = store.table(partenum.jaccard_groups(own.select("id", "text"), doc_id="id").select("doc_id", "component_id").distinct(), "groups").withColumnRenamed("doc_id", "id")
        rows = own.select("doc_id", "id", store.text_key("text").alias("text_key")).distinct().join(group, "id").withColumn("salt", store.salt("id"))
        first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first"), F.count("*").alias("n"), store.salts_used("salt").alias("used")).where("n > 1")
        first = first.select("component_id", F.col("first.id").alias("stays"), F.explode(store.salts("used")).alias("salt"))
        return rows.join(first, ["component_id", "salt"]).where("id <> stays").select("doc_id", "text_key").distinct()

    left = _without(docs, store.settled(bad, "rejected"))
    again = store.settled(lambda: docs.select(_row_id().alias("_again")).groupBy("_again").count().where("count > 1").select("_again"), "repeated")
    if not again.take(1):
        return left
    sure, open_ = _split(left, again)
    one, rank = store.unused(docs, "_one"), store.unused(docs, "_rank")
    open_ = open_.withColumn(one, _row_id())
    order = [F.col(f"`{f.name}`") if f.dataType.typeName() not in ("map", "variant") else F.lit(0) for f in docs.schema.fields]
    firsts = open_.join(again, F.col(one) == F.col("_again"), "left_semi").withColumn(rank, F.row_number().over(Window.partitionBy(one).orderBy(*order))).where(F.col(rank) == 1)
    single = open_.join(again, F.col(one) == F.col("_again"), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return sure.unionByName(single.select(*columns)).unionByName(firsts.select(*columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hit = lambda: decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit > 0").select("doc_id", "text_key").distinct()
    return _without(docs, store.settled(hit, "rejected"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.table(stage(spark, docs, sf_dir), name)
    return docs
