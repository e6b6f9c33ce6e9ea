"""KPI tables Q1-Q11 over the warehouse fact.

Plan shape: the fact is aggregated by its dimension key first (partial +
final hash aggregate), and only the per-key partial sums meet the dimension,
so the dimension join sees one row per member instead of one per study. The
modality dimension is bounded by the vocabulary (at most one row per standard
name plus UNKNOWN), which makes its broadcast safe at any data size; the
location join is left to AQE, which broadcasts it when its runtime size allows.

Averages are exact: turnaround is summed as integer microseconds in a decimal
(no overflow, no dependence on row order) and divided once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions import exprs as X


def _ok() -> Column:
    return F.col("tat_flag") == "OK"


BAND_ORDER = [label for _, label in C.TAT_BANDS] + [C.TAT_BAND_OVER]


def _parts() -> list[Column]:
    us = X.minutes_to_micros("turnaround_mins").cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("n"), F.sum(us).alias("s_us"),
            F.count("turnaround_mins").alias("c_us"),
            F.sum("report_issued_flag").cast("bigint").alias("r")]


def _merge_parts() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("s_us").alias("s_us"),
            F.sum("c_us").alias("c_us"), F.sum("r").alias("r")]


def _sums(src: DataFrame) -> list[Column]:
    """Sums over fact rows, or over the kept partial sums of :mod:`tessera.plans.kpi_parts`."""
    return _merge_parts() if "s_us" in src.columns else _parts()


def year_month() -> Column:
    return F.substring(F.col("date_key").cast("string"), 1, 6)


def _rows(src: DataFrame) -> Column:
    return F.sum("n") if "s_us" in src.columns else F.count(F.lit(1))


def avg_minutes(s_us: str = "s_us", c_us: str = "c_us", digits: int = 1,
                per: float = 1.0) -> Column:
    """Mean turnaround in minutes (or hours with ``per=60``), rounded."""
    mean = F.try_divide(F.col(s_us).cast("double"), F.col(c_us)) / F.lit(float(X.MICROS_PER_MINUTE))
    if per != 1.0:
        mean = mean / F.lit(per)
    return X.round_half_up(mean, digits)


def rate_pct(r: str = "r", n: str = "n") -> Column:
    return X.round_half_up(F.try_divide(F.col(r).cast("double"), F.col(n)) * F.lit(100.0), 1)


def summary(fact: DataFrame, radiologists: DataFrame | None = None) -> DataFrame:
    """Q1: one row of headline KPIs over studies with an OK turnaround. Partial sums come
    with ``radiologists``, the bitmaps of the radiologists of those studies."""
    ok = fact.where(_ok())
    if radiologists is None:
        agg = ok.agg(*_parts(), F.count_distinct("radiologist_key").alias("active_radiologists"))
    else:
        merged = radiologists.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        seen = merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("active_radiologists"))
        agg = (ok.agg(*_sums(fact)).withColumn("n", F.coalesce("n", F.lit(0)))
               .withColumn("active_radiologists", seen.scalar()))
    return agg.select(
        F.col("n").alias("total_studies"),
        avg_minutes().alias("avg_tat_mins"),
        avg_minutes(digits=2, per=60.0).alias("avg_tat_hours"),
        F.col("r").alias("reports_issued"),
        rate_pct().alias("report_rate_pct"),
        F.col("active_radiologists"),
    )


def by_modality(fact: DataFrame, dim_modality: DataFrame, ok_only: bool = True) -> DataFrame:
    """Q2: volume, TAT and report rate per modality (inner join)."""
    src = fact.where(_ok()) if ok_only else fact
    per_key = src.groupBy("modality_key").agg(*_sums(src))
    dims = dim_modality.select("modality_key", "modality_name", "modality_group")
    g = per_key.join(dims, "modality_key").groupBy("modality_name", "modality_group") \
        .agg(*_merge_parts())
    return g.select(
        "modality_name", "modality_group",
        F.col("n").alias("study_count"),
        avg_minutes().alias("avg_tat_mins"),
        F.col("r").alias("reports_issued"),
        rate_pct().alias("report_rate_pct"),
    ).orderBy(F.desc("study_count"), F.asc("modality_name"))


def by_site(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Q3: volume and TAT per site (inner join)."""
    per_key = fact.where(_ok()).groupBy("location_key").agg(*_sums(fact))
    g = per_key.join(dim_location.select("location_key", "site_code", "department"),
                     "location_key").groupBy("site_code", "department").agg(*_merge_parts())
    return g.select("site_code", "department", F.col("n").alias("study_count"),
                    avg_minutes().alias("avg_tat_mins")) \
        .orderBy(F.desc("study_count"), F.asc("site_code"))


def tat_distribution(fact: DataFrame) -> DataFrame:
    """Q4: studies per TAT band in band order, Invalid excluded."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(b) for b in BAND_ORDER]),
                                       F.col("tat_band")), F.lit(len(BAND_ORDER) + 1))
    return (fact.where(_ok() & (F.col("tat_band") != C.TAT_BAND_INVALID))
            .groupBy("tat_band").agg(_rows(fact).alias("study_count"))
            .orderBy(rank))


def by_priority(fact: DataFrame) -> DataFrame:
    """Q5."""
    g = fact.where(_ok()).groupBy("priority").agg(*_sums(fact))
    return g.select("priority", F.col("n").alias("study_count"),
                    avg_minutes().alias("avg_tat_mins")) \
        .orderBy(F.desc("study_count"), F.asc("priority"))


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Q6: per ``yyyyMM`` of the date key."""
    ym = F.col("year_month") if "year_month" in fact.columns else year_month()
    g = (fact.where(_ok() & ym.isNotNull())
         .groupBy(ym.alias("year_month")).agg(*_sums(fact)))
    return g.select("year_month", F.col("n").alias("study_count"),
                    avg_minutes().alias("avg_tat_mins")).orderBy("year_month")


def data_quality(fact: DataFrame) -> DataFrame:
    """Q7: rows per TAT flag, no filter."""
    return fact.groupBy("tat_flag").agg(_rows(fact).alias("record_count"))


def top_modalities(fact: DataFrame, dim_modality: DataFrame, k: int = 10) -> DataFrame:
    """Q8: the k largest modalities over all rows (no TAT filter)."""
    m = by_modality(fact, dim_modality, ok_only=False)
    return m.select("modality_name", "study_count", "avg_tat_mins", "report_rate_pct") \
        .orderBy(F.desc("study_count"), F.asc("modality_name")).limit(k)


def modality_head(fact: DataFrame, dim_modality: DataFrame, k: int = 8) -> DataFrame:
    """Q9: first k rows of Q2, three columns."""
    return by_modality(fact, dim_modality).select("modality_name", "study_count",
                                                  "avg_tat_mins").limit(k)


def cards(summary_df: DataFrame) -> DataFrame:
    """Q10: KPI cards ``(card_no, label, value, unit, display)`` from Q1."""
    rows = []
    for i, (label, col, unit) in enumerate(C.KPI_CARDS, 1):
        v = F.col(col)
        is_float = col in ("avg_tat_mins", "avg_tat_hours", "report_rate_pct")
        shown = F.format_number(v, 1) if is_float else F.format_number(v, 0)
        rows.append(F.struct(F.lit(i).alias("card_no"), F.lit(label).alias("label"),
                             v.cast("double").alias("value"), F.lit(unit).alias("unit"),
                             F.concat(shown, F.lit(unit)).alias("display")))
    return summary_df.select(F.inline(F.array(*rows)))


def fact_sample(fact: DataFrame, k: int = 10) -> DataFrame:
    """Q11: the first k fact rows by study id."""
    return fact.orderBy(F.asc_nulls_last("study_id")).limit(k)


def all_kpis(fact: DataFrame, dim_modality: DataFrame, dim_location: DataFrame,
             radiologists: DataFrame | None = None) -> dict:
    """All KPI tables of a fact, or of its kept partial sums and radiologist bitmaps."""
    s = summary(fact, radiologists)
    return {
        "summary": s,
        "by_modality": by_modality(fact, dim_modality),
        "by_site": by_site(fact, dim_location),
        "tat_distribution": tat_distribution(fact),
        "by_priority": by_priority(fact),
        "monthly_trend": monthly_trend(fact),
        "data_quality": data_quality(fact),
        "top_modalities": top_modalities(fact, dim_modality),
        "cards": cards(s),
    }
