"""T2, T3 and T9-T13 maintained by landing instead of recomputed from all rows.

Every model that adds rows up takes sums of them as well (``purchases`` of T2,
``holdings`` of T3, ``payments`` of T11; T9, T12 and T13 read staged rows whose
measures they only sum).  The sums of a landed batch are made once, from that
batch's rows alone, for each file and group of the models, and stored beside the
landed rows.  The manifest of the landing names the batch that holds each file
that is there now; sums of other batches of a re-sent file, and of files that are
gone, are no longer named.  Nothing is subtracted, so the models equal a
recomputation but for the order of floating-point additions.

A new month therefore costs its own rows plus one read of the sums, whose number is
that of files x groups of a file.

Defined cases: a batch without rows of a kind has empty sums; NULL groups are
groups; a measure that is NULL in all rows of a group is NULL in its sum; a batch
whose sums are missing (a run was killed) gets them on the next call.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import staging as S
from ..operators import transforms as T
from ..sinks.writers import exists, replace
from ..sources import incremental as INC
from ..sources import workbook as WB

P, FILE = T.P, T.FILE
NO_KEYS = "all"


@dataclass(frozen=True)
class Part:
    """Rows that models add up: what they are grouped by, what is summed, and how the
    rows come from the staged tables."""

    groups: tuple[str, ...]
    measures: tuple[str, ...]
    rows: Callable[[Mapping[str, DataFrame], Sequence[str]], DataFrame]


# dates that came as text stay apart by that text, as in T12 and T13
PARTS: dict[str, Part] = {
    "purchases": Part(
        ("ticker",), ("total_shares_bought", "total_invested"),
        lambda stg, keys: T.purchases(T.int_trades_clean(stg["stg_trades"], [*keys, FILE]), keys)),
    "holdings": Part(
        ("ticker", "asset_type", P), ("total_quantity", "close_x_quantity", "total_current_value"),
        lambda stg, keys: T.holdings(stg["stg_stock_positions"], stg["stg_etf_positions"], keys)),
    "treasury": Part(
        ("product_name", "index_type", "maturity_date", P, "_date_text"),
        ("quantity", "invested_value", "gross_value", "net_value", "current_value"),
        lambda stg, keys: stg["stg_treasury_bonds"]),
    "fixed_income": Part(
        (*T.FIXED_INCOME_KEYS, "_date_text"), ("quantity", "curva_value"),
        lambda stg, keys: stg["stg_fixed_income"]),
    "payments": Part(
        ("ticker", P, "event_type"), ("total_income", "total_shares", "num_payments"),
        lambda stg, keys: T.payments(stg["stg_dividends"], keys)),
}


def sums_by_file(staging: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The sums of every part for each file."""
    sums = {}
    for name, part in PARTS.items():
        rows = part.rows(staging, keys)
        missing = {c: F.lit(None).cast("string") for c in part.groups if c not in rows.columns}
        sums[name] = rows.withColumns(missing).groupBy(*keys, FILE, *part.groups) \
            .agg(*[F.sum(m).alias(m) for m in part.measures])
    return sums


def named(sums: DataFrame, manifest: DataFrame) -> DataFrame:
    """The sums of the batches that the manifest ``(source_file, batch)`` names."""
    files = manifest.select(F.col("source_file").alias(FILE), "batch")
    return sums.join(files, [FILE, "batch"], "left_semi").drop("batch")


def maintain(spark: SparkSession, root: str, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Make the sums that are missing for the landing at ``root``
    (:func:`..sources.incremental.land_changes`) and return those of the files that are
    there now, for ``build_marts(..., sums=)``."""
    manifest, landed = INC.manifest(spark, root), INC.batches(spark, root)
    # one number for each landing that still holds a file
    batches = sorted(r.batch for r in manifest.select("batch").distinct().collect())
    place, made = f"{root}/sums/{'+'.join(keys) or NO_KEYS}", {}
    for batch in batches:
        missing = [name for name in PARTS if not exists(spark, f"{place}/{name}/{batch}")]
        if missing:
            made = _sums_of_landed(landed, batch, keys)
        for name in missing:
            replace(spark, f"{place}/{name}/{batch}", lambda to, df=made[name]: df.write.parquet(to))
    made = made or _sums_of_landed(landed, -1, keys)                # their schemas
    return {name: named(spark.read.schema(df.schema).parquet(*[f"{place}/{name}/{b}" for b in batches])
                        if batches else df, manifest) for name, df in made.items()}


def _sums_of_landed(landed: DataFrame, batch: int, keys: Sequence[str]) -> dict[str, DataFrame]:
    rows = landed.where(F.col("batch") == batch)
    sums = sums_by_file(S.stage_all(WB.land_raw_tables(rows, keys), keys), keys)
    return {name: df.withColumn("batch", F.lit(batch).cast("long")) for name, df in sums.items()}
