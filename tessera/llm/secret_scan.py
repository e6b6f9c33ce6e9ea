"""Secret scans over an incremental, content-addressed blob ledger.

Every version of every path is reduced to the SHA-256 of its text (its blob).
The ledger holds one row per (blob, rule, rule version) that was ever scanned,
with the spans found. A scan reads the texts of one representative path per
blob that lacks one of the current rule versions, appends the result to the
ledger, and joins the ledger's findings back to all paths that carry the blob.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read
from tessera.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least
    ``least`` characters. A changed rule takes a new ``version``."""
    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: In the order in which kinds rank at equal start.
RULES = (
    Rule("assign", 1,
         r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # Runs below the least length cannot start a match of another run, so the bound may
    # stand in the pattern (not so for "assign", where a short match consumes its text).
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:long, end:long>>"


def scan(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Scan (blob, text, kinds): one ledger row per blob and kind in ``kinds``.

    Spark has no function that returns all match positions. ``split`` gives the
    gaps between the matches that ``regexp_extract_all`` returns; a running sum
    of both lengths gives each match's start in code points.
    """
    def lengths(r: Rule) -> Column:
        found = F.arrays_zip(
            F.transform(F.split("text", r.pattern, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)), F.length).alias("len"),
            F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)), F.length).alias("val"))
        # Both columns in one condition: the regex stays above the join that leaves out
        # what the ledger already holds.
        todo_and_hit = F.when(F.array_contains("kinds", r.kind), F.col("text").rlike(r.pattern)).otherwise(False)
        return F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"),
                        F.when(todo_and_hit, found).alias("m"))

    # A path may repeat a version: its rows are told apart, and one result of each blob stays.
    parts = (todo.withColumn("rid", F.monotonically_increasing_id())
             .select("rid", "blob", F.explode(F.array(*[lengths(r) for r in rules])).alias("r"))
             .select("rid", "blob", "r.kind", "r.least", F.posexplode("r.m").alias("pos", "m"))
             .select("rid", "blob", "kind", "least", "pos", "m.gap", "m.len", "m.val"))
    # One text and kind per window group: as many rows as that one text has matches.
    upto = "sum(gap + coalesce(len, 0)) OVER (PARTITION BY blob, kind, rid ORDER BY pos)"
    found = (parts.withColumn("end", F.expr(upto).cast("long"))
             .where(F.col("val") >= F.col("least"))
             .groupBy("blob", "kind", "rid")
             .agg(F.sort_array(F.collect_list(F.struct(
                 (F.col("end") - F.col("len")).cast("long").alias("start"), "end"))).alias("spans"))
             .dropDuplicates(["blob", "kind"]))
    version = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    return (todo.select("blob", F.explode("kinds").alias("kind"))
            .join(found, ["blob", "kind"], "left")
            .select("blob", "kind", version[F.col("kind")].cast("int").alias("version"),
                    F.coalesce("spans", F.expr("cast(array() AS array<struct<start:long, end:long>>)"))
                    .alias("spans")))


def update_ledger(spark: SparkSession, versions: DataFrame, ledger: str, *, path_col: str = "doc_id",
                  text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
    """Scan the (blob, rule version) pairs of ``versions`` that the ledger lacks and append them.

    Returns the number of pairs scanned.
    """
    spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (
        ("blob", "string"), ("kind", "string"), ("version", "int"),
        ("spans", "array<struct<start:bigint, end:bigint>>"))) + " WHERE false"
    ).write.mode("ignore").parquet(ledger)
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    done = (spark.read.schema(LEDGER).parquet(ledger).groupBy("blob")
            .agg(F.collect_set(F.struct("kind", "version")).alias("done")))  # bounded by the rules
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(text_col, F.lit("")).alias("text")
                           ).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    # One path per blob, found on ids alone; copies collapse map-side.
    pairs = (rows.groupBy("blob").agg(F.min("path").alias("path"))
             .join(done, "blob", "left")
             .select("blob", "path", F.array_except(current, F.coalesce(
                 "done", F.expr("cast(array() AS array<struct<kind:string, version:int>>)"))).alias("unseen"))
             .where(F.size("unseen") > 0)
             .select("blob", "path", F.col("unseen.kind").alias("kinds")))
    todo = (rows.alias("r").join(pairs.alias("p"), (F.col("r.blob") == F.col("p.blob"))
                                 & F.col("r.path").eqNullSafe(F.col("p.path")))
            .select("r.blob", "r.text", "p.kinds"))
    fresh = scan(todo, rules).dropDuplicates(["blob", "kind"])  # a path may repeat a version
    before = spark.read.schema(LEDGER).parquet(ledger).count()
    fresh.write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger).count() - before


def findings(spark: SparkSession, versions: DataFrame, ledger: str, *, path_col: str = "doc_id",
             text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version: path, blob, found (array of start, rank, kind, end, in that order)."""
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    known = spark.read.schema(LEDGER).parquet(ledger)
    now = F.lit(False)
    for r in rules:
        now = now | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    per_blob = (known.where((F.size("spans") > 0) & now)
                .select("blob", "kind", F.explode("spans").alias("s"))
                .groupBy("blob")
                .agg(F.sort_array(F.collect_list(F.struct(
                    F.col("s.start").alias("start"), ranks[F.col("kind")].alias("rank"), "kind",
                    F.col("s.end").alias("end")))).alias("found")))
    none = F.expr("cast(array() AS array<struct<start:bigint, rank:int, kind:string, end:bigint>>)")
    return (versions.select(F.col(path_col).alias("path"), F.sha2(
                F.coalesce(text_col, F.lit("")).cast("binary"), 256).alias("blob"))
            .join(per_blob, "blob", "left")
            .select("path", "blob", F.coalesce("found", none).alias("found")))


def secret_scan(spark: SparkSession, versions: DataFrame, ledger: str, *, path_col: str = "doc_id",
                text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, then return the findings of every version.

    A null text counts as empty, an empty text has no findings. Null and repeated
    paths are rows like any other. Each distinct text is scanned whole and once per
    rule version, however many paths carry it. Extra columns are not read; an empty
    table gives no rows and leaves the ledger as it is.
    """
    update_ledger(spark, versions, ledger, path_col=path_col, text_col=text_col, rules=rules)
    return findings(spark, versions, ledger, path_col=path_col, text_col=text_col, rules=rules)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against a fresh ledger."""
    found = secret_scan(spark, read(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    of = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.withColumn("spans", spans).select(
        F.col("path").alias("doc_id"), of("assign"), of("access"), of("hex"),
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans")


def _oracle() -> str:
    key = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    assign = f"({key})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    kinds = ((0, "assign", assign, 2, 6), (1, "access", "AKIA[A-Z0-9]+", 0, 20), (2, "hex", "[0-9a-f]+", 0, 24))
    per = " UNION ALL ".join(f"""
SELECT doc_id, rank, kind, e - l AS s, e FROM (
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, v, l,
         sum(g + coalesce(l, 0)) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM (SELECT doc_id, unnest(range(len(gs))) AS i, unnest([len(x) FOR x IN gs]) AS g,
               unnest([len(x) FOR x IN ls] || [NULL]) AS l, unnest([len(x) FOR x IN vs] || [NULL]) AS v
        FROM (SELECT doc_id, regexp_split_to_array(t, '{p}') AS gs, regexp_extract_all(t, '{p}', 0) AS ls,
                     regexp_extract_all(t, '{p}', {grp}) AS vs FROM d)))
WHERE v >= {least}""" for rank, kind, p, grp, least in kinds)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({per}),
s AS (SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b,
             count(*) FILTER (rank = 2) AS c,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
      FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)
"""


QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLES = {"op4_secret_scan": _oracle()}
