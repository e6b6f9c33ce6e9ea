"""A training corpus from the ``documents`` table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept and returns a DataFrame; ``run`` writes it to the shared folder and reads
it back as the next stage's docs, so a lost executor never reruns a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, near_dedup, token_store, toxicity
from tessera.llm.common import read, stage


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``docs`` has a column of that name."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject, each row judged by its whole text.

    Null and empty texts have the score of no evidence, without labels none is rejected.
    Columns of any name stay as they are; an empty table gives no rows.
    """
    model, curve = toxicity.train(spark, docs, read(spark, sf_dir, "labels"), toxicity.learnable)
    score = _unused(docs, "score")
    return toxicity.score(docs, model, curve, score_col=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id.

    Rows are told apart by doc_id and text; of rows that repeat both one stays. Null ids rank
    last, texts without words are never grouped. Other columns, of any name, stay as they are.
    """
    mark = _unused(docs, "print")
    key = F.struct("doc_id", F.xxhash64("text").alias("print"))
    kept = (near_dedup.near_duplicates(docs.select(key.alias("doc_id"), "text")).where("kept")
            .select(F.col("doc_id.doc_id").alias("keep_id"), F.col("doc_id.print").alias("keep_print")))
    rows = docs.withColumn(mark, F.xxhash64("text"))
    return (rows.join(kept, rows["doc_id"].eqNullSafe(kept["keep_id"]) & (rows[mark] == kept["keep_print"]), "left_semi")
            .dropDuplicates(["doc_id", mark]).drop(mark))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; texts without words have none.

    Repeated rows and null ids stay rows of their own, columns of any name as they are. An
    empty benchmark rejects nothing.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    hits = decontaminate.hit_runs(rows, read(spark, sf_dir, "benchmark"), id_col="row")
    return hits.where(F.size("runs") == 0).select("doc_id.*")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says: the whole part, and one more with the
    probability of the rest, drawn from its id and text. The targets' total is raised until
    no rate is below 1, so every document stays at least once, also one without words or id.

    Other columns pass the operator under other names, so columns of any name stay as they are.
    """
    own = {c: c if c in ("doc_id", "text", "lang") else f"column_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*(F.col(c).alias(name) for c, name in own.items()))
    mixed = mixing.mix(spark, rows, read(spark, sf_dir, "labels"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + draw).cast("int")
    return (mixed.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
            .select(*(F.col(name).alias(c) for c, name in own.items())))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of what is left, read back by document.

    A null text counts as empty and has the end id only; rows that repeat a doc_id follow each
    other, null ids come first. Only doc_id and text are read.
    """
    return token_store.token_rows(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_to_targets),
    ("token_store", write_tokens),
]

#: SQL cannot express the learnt models and signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; an empty table gives no rows."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
