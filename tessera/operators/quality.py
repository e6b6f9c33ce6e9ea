"""Data-quality rules V01-V07, the per-rule report and the error table.

Every rule outcome is computed as a column over the extracted rows
(:func:`flag_rules`), so the report is one aggregate and no rule costs a job of
its own. Rules run in the fixed order V01 -> V02 -> V03 -> V04 -> V05 -> V07,
then V06 on the image metadata.

Scale notes
-----------
* V02 passing rows are ``row_number() = 1`` per key: Spark limits each task's
  group to its first row before the shuffle, so a key holding a third of all
  rows sends one row per task. One scan, one exchange.
* V02 flags on all rows join the few keys that occur more than once (from one
  hash aggregate) back to the rows; AQE broadcasts them if small and splits a
  hot key's rows otherwise.
* V06 is a semi/anti join on the study key; only the key column of the studies
  side is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import config as C
from tessera.config import JobConfig
from tessera.functions import exprs as X

FLAG_V01 = "_v01_fail"
FLAG_V02 = "_v02_dup"
FLAG_V03 = "_v03_unmapped"
FLAG_V04 = "_v04_invalid"
TAT_US = "_tat_us"
PATIENT_PSEUDO = "_patient_pseudo"


def v01_null_timestamps(df: DataFrame, cfg: JobConfig = C.DEFAULT) -> Column:
    """V01 fail condition: any required time stamp is null."""
    return X.any_null(cfg.required_ts_cols)


def keep_first_flag(df: DataFrame, key: str, order: str, eligible: Column | None = None,
                    flag: str = FLAG_V02) -> DataFrame:
    """V02 as a general operator: ``flag`` is true for every eligible row that is
    not the first (smallest ``order``) of its ``key``; null keys count as equal.
    Ineligible rows get a null flag.

    ``order`` is the row's position in its source and must be unique per row
    (``event_id`` for the stand-in, file and place in it for files): two rows
    with the same key *and* the same position would both count as first."""
    base = df if eligible is None else df.withColumn("_eligible", eligible)
    elig = F.lit(True) if eligible is None else F.col("_eligible")
    firsts = (base.where(elig).groupBy(F.col(key).alias("_fk"))
              .agg(F.min(order).alias("_first_ix"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    joined = base.join(firsts, base[key].eqNullSafe(firsts["_fk"]), "left")
    later = F.coalesce(F.col(order) > F.col("_first_ix"), F.lit(False))
    out = joined.withColumn(flag, F.when(elig, later))
    drop = ["_fk", "_first_ix"] + ([] if eligible is None else ["_eligible"])
    return out.drop(*drop)


def standard_modality(c: str | Column, cfg: JobConfig = C.DEFAULT) -> Column:
    """V03 lookup: stripped raw code in the vocabulary, else null."""
    raw = X.strip(c)
    if cfg.normalise_modality_case:
        vocab = {k.upper(): v for k, v in cfg.vocabulary.items()}
        return X.lookup(F.upper(raw), vocab)
    return X.lookup(raw, cfg.vocabulary)


def valid_patient_id(c: str | Column, cfg: JobConfig = C.DEFAULT) -> Column:
    """V04 condition: exactly N digits after stripping (null is invalid)."""
    return F.coalesce(X.is_digits(X.strip(c), cfg.patient_id_length), F.lit(False))


def checked_patient_id(c: str | Column, cfg: JobConfig = C.DEFAULT) -> Column:
    """V04 value: the unstripped id when valid, else ``INVALID_ID``."""
    c = X.col_of(c)
    return F.when(valid_patient_id(c, cfg), c).otherwise(F.lit(C.INVALID_PATIENT_ID))


def pseudonymised(c: str | Column, cfg: JobConfig = C.DEFAULT) -> Column:
    """V07 value: SHA-256 prefix; null, empty or INVALID_ID -> placeholder."""
    c = X.col_of(c)
    bad = c.isNull() | (c == "") | (c == C.INVALID_PATIENT_ID)
    return F.when(bad, F.lit(C.INVALID_PSEUDONYM)).otherwise(X.pseudonym(c, cfg.pseudonym_salt))


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """V02 passing rows: the first (smallest ``order``) of each ``key``; null keys are one group."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def flag_rules(ris: DataFrame, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """All RIS rule outcomes as columns, one row per extracted row.

    Adds ``_v01_fail``, ``_v02_dup`` (null where V01 failed), ``_v03_unmapped``,
    ``_v04_invalid``, ``modality_standard``, ``patient_id_checked``, ``_tat_us``,
    ``turnaround_mins``, ``tat_flag`` and ``patient_id_pseudo``.
    """
    df = ris.withColumn(FLAG_V01, v01_null_timestamps(ris, cfg))
    return _rule_columns(keep_first_flag(df, cfg.key_col, cfg.order_col, eligible=~F.col(FLAG_V01)), cfg)


def flag_passing(ris: DataFrame, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """The rows of :func:`flag_rules` that pass V01 and V02, without flagging the others."""
    df = first_rows(ris.where(~v01_null_timestamps(ris, cfg)), cfg.key_col, cfg.order_col)
    return _rule_columns(df.withColumn(FLAG_V01, F.lit(False)).withColumn(FLAG_V02, F.lit(False)), cfg)


def _rule_columns(df: DataFrame, cfg: JobConfig) -> DataFrame:
    std = standard_modality(cfg.modality_col, cfg)
    checked = checked_patient_id(cfg.patient_col, cfg)
    tat_us = X.diff_micros(cfg.end_col, cfg.report_col)
    return df.select(
        "*",
        std.isNull().alias(FLAG_V03),
        F.coalesce(std, F.lit(C.UNKNOWN_MODALITY)).alias("modality_standard"),
        (~valid_patient_id(cfg.patient_col, cfg)).alias(FLAG_V04),
        checked.alias("patient_id_checked"),
        tat_us.alias(TAT_US),
        X.micros_to_minutes(tat_us).alias("turnaround_mins"),
        X.tat_flag(tat_us, cfg.min_tat_mins, cfg.max_tat_mins).alias("tat_flag"),
        pseudonymised(checked, cfg).alias("patient_id_pseudo"),
        pseudonymised(cfg.patient_col, cfg).alias(PATIENT_PSEUDO),
    )


def masked(flagged: DataFrame, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """Flagged rows without any raw patient id, for outputs that outlive the run."""
    return flagged.drop(cfg.patient_col, "patient_id_checked")


def passes_v01(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col(FLAG_V01))


def passes_v02(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col(FLAG_V01) & ~F.col(FLAG_V02))


def validated(flagged: DataFrame, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """Rows that passed V01 and V02, after V03-V05 and V07 (raw id dropped)."""
    ris_cols = [c for c in flagged.columns
                if not c.startswith("_") and c not in (
                    cfg.patient_col, "patient_id_checked", "modality_standard",
                    "turnaround_mins", "tat_flag", "patient_id_pseudo")]
    return passes_v02(flagged).select(*ris_cols, "modality_standard", "turnaround_mins",
                                      "tat_flag", "patient_id_pseudo")


def rejects(flagged: DataFrame, ris_columns: list[str], cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """V-ERR: V01 rejects and V02 rejects, original columns plus ``rule_id`` and
    ``captured_at``; the raw patient id is pseudonymised (not kept in a sink)."""
    rule = F.when(F.col(FLAG_V01), F.lit("V01")).otherwise(F.lit("V02"))
    cols = []
    for c in ris_columns:
        if c == cfg.patient_col:
            cols.append(F.col(PATIENT_PSEUDO).alias("patient_id_pseudo"))
        else:
            cols.append(F.col(c))
    return (flagged.where(F.col(FLAG_V01) | F.col(FLAG_V02))
            .select(*cols, rule.alias("rule_id"),
                    F.lit(cfg.run_ts).cast("timestamp_ntz").alias("captured_at")))


def error_table(reject_rows: DataFrame, run_id: str, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """Rows for the warehouse Error_Table (declared by the source, filled here).
    Positions restart with every export, so the id carries the run."""
    desc = X.lookup(F.col("rule_id"), {**C.RULE_DESCRIPTIONS, **C.EXTRA_RULE_DESCRIPTIONS})
    return reject_rows.select(
        F.concat_ws("-", F.lit(run_id), F.col("rule_id"), F.col(cfg.order_col).cast("string")).alias("error_id"),
        F.col(cfg.key_col).alias("study_id"),
        F.col("rule_id").alias("error_rule"),
        desc.alias("error_detail"),
        F.col("captured_at"),
    )


def source_errors(rows: DataFrame, rule: str, cfg: JobConfig = C.DEFAULT, key: Column | None = None) -> DataFrame:
    """Error_Table rows for rows that no run loads (E1, S1), named by their content.

    Every run of the same export finds them again, under the same ids, so the table takes
    them once; rows of equal content are one entry. The content (all columns but the
    position) enters as a hash only.
    """
    content = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in rows.columns if c != cfg.order_col]
    return rows.select(
        F.concat(F.lit(f"{rule}-"), F.sha2(F.concat_ws("\x1f", *content), 256)).alias("error_id"),
        (F.lit(None).cast("string") if key is None else key).alias("study_id"),
        F.lit(rule).alias("error_rule"),
        F.lit(C.EXTRA_RULE_DESCRIPTIONS[rule]).alias("error_detail"),
        F.lit(cfg.run_ts).cast("timestamp_ntz").alias("captured_at"),
    ).dropDuplicates(["error_id"])


def referential_integrity(pacs: DataFrame, valid: DataFrame, cfg: JobConfig = C.DEFAULT,
                          how: str = "left_semi") -> DataFrame:
    """Image rows whose study key is (semi) / is not (anti) among the
    validated study keys; null equals null as in the source."""
    ids = valid.select(F.col(cfg.key_col).alias("_rk"))
    return pacs.join(ids, pacs[cfg.pacs_key_col].eqNullSafe(ids["_rk"]), how)


def pacs_flagged(pacs: DataFrame, valid: DataFrame, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """V06 as one pass: every image row with ``_v06_linked``. The studies side
    is unique per key after V02, so the left join never multiplies rows."""
    ids = valid.select(F.col(cfg.key_col).alias("_rk"), F.lit(True).alias("_v06_linked"))
    j = pacs.join(ids, pacs[cfg.pacs_key_col].eqNullSafe(ids["_rk"]), "left")
    return j.drop("_rk").withColumn("_v06_linked", F.coalesce("_v06_linked", F.lit(False)))


def _report_rows(counts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot ``(rule, passed col, failed col)`` triples of a one-row frame."""
    n = len(rules)
    args = ", ".join(f"'{r}', {p}, {f}" for r, p, f in rules)
    return counts.selectExpr(f"stack({n}, {args}) AS (rule_id, passed, failed)")


def quality_report(flagged: DataFrame, pacs_linked: DataFrame | None) -> DataFrame:
    """V-REP: ``(rule_id, description, passed, failed, pass_rate, total_failed)``
    in rule order (``total_failed`` is the running sum), from one aggregate over
    the flagged studies and one over the images (without images, no V06 row)."""
    v01, v02 = F.col(FLAG_V01), F.col(FLAG_V02)
    ok2 = ~v01 & ~v02
    ris_counts = flagged.agg(
        F.count_if(~v01).alias("v01_p"), F.count_if(v01).alias("v01_f"),
        F.count_if(ok2).alias("v02_p"), F.count_if(~v01 & v02).alias("v02_f"),
        F.count_if(ok2 & ~F.col(FLAG_V03)).alias("v03_p"),
        F.count_if(ok2 & F.col(FLAG_V03)).alias("v03_f"),
        F.count_if(ok2 & ~F.col(FLAG_V04)).alias("v04_p"),
        F.count_if(ok2 & F.col(FLAG_V04)).alias("v04_f"),
        F.count_if(ok2 & (F.col("tat_flag") == "OK")).alias("v05_p"),
        F.count_if(ok2 & (F.col("tat_flag") != "OK")).alias("v05_f"),
        F.count_if(ok2).alias("v07_p"),
        F.lit(0).cast("bigint").alias("v07_f"),
    )
    ris_rows = _report_rows(ris_counts, [
        ("V01", "v01_p", "v01_f"), ("V02", "v02_p", "v02_f"), ("V03", "v03_p", "v03_f"),
        ("V04", "v04_p", "v04_f"), ("V05", "v05_p", "v05_f"), ("V07", "v07_p", "v07_f")])
    rows = ris_rows
    if pacs_linked is not None:
        pacs_counts = pacs_linked.agg(F.count_if("_v06_linked").alias("v06_p"),
                                      F.count_if(~F.col("_v06_linked")).alias("v06_f"))
        rows = rows.unionByName(_report_rows(pacs_counts, [("V06", "v06_p", "v06_f")]))
    # running total of failures in rule order: a window over the seven report
    # rows (a bounded table, so one partition is fine)
    pos = F.array_position(F.array(*[F.lit(r) for r in C.RULE_ORDER]), F.col("rule_id"))
    running = Window.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        "rule_id",
        X.lookup(F.col("rule_id"), dict(C.RULE_DESCRIPTIONS)).alias("description"),
        F.col("passed").cast("bigint").alias("passed"),
        F.col("failed").cast("bigint").alias("failed"),
        X.percent_text("passed", "failed").alias("pass_rate"),
        F.sum(F.col("failed").cast("bigint")).over(running).cast("bigint").alias("total_failed"),
    )


def quality_samples(flagged: DataFrame, pacs_linked: DataFrame, cfg: JobConfig = C.DEFAULT,
                    k: int = 3) -> DataFrame:
    """Up to ``k`` sample values per rule (V01, V02, V03, V05, V06), first by
    source order. ``row_number() <= k`` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each rule ships at most k rows per
    task however many rows fail."""
    v01, v02 = F.col(FLAG_V01), F.col(FLAG_V02)
    ok2 = ~v01 & ~v02
    ord_col, ord_type = F.col(cfg.order_col), flagged.schema[cfg.order_col].dataType
    def sample(rule: str, value: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule_id"), value.cast("string").alias("sample"),
                        ord_col.alias("ord"))

    ris = flagged.select(
        F.explode(F.array(
            F.when(v01, sample("V01", F.col(cfg.key_col))),
            F.when(~v01 & v02, sample("V02", F.col(cfg.key_col))),
            F.when(ok2 & F.col(FLAG_V03), sample("V03", F.col(cfg.modality_col))),
            F.when(ok2 & (F.col("tat_flag") != "OK"), sample("V05", F.col(cfg.key_col))),
        )).alias("s")).where(F.col("s").isNotNull()).select("s.*")
    pacs = (pacs_linked.where(~F.col("_v06_linked"))
            .select(F.lit("V06").alias("rule_id"), F.col(cfg.pacs_key_col).alias("sample"),
                    F.lit(None).cast(ord_type).alias("ord")))
    both = ris.unionByName(pacs)
    w = Window.partitionBy("rule_id").orderBy(F.col("ord").asc_nulls_last(),
                                              F.col("sample").asc_nulls_first())
    return (both.withColumn("sample_no", F.row_number().over(w))
            .where(F.col("sample_no") <= k).select("rule_id", "sample_no", "sample"))
