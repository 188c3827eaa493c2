"""The nightly job: read, reconcile, check, write, read back."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.operators import ledger as L
from aislewise.sources.sinks import audit_written, write_dated
from aislewise.sources.tables import Sources


@dataclass(frozen=True)
class NightlyResult:
    rows: int
    checksum: int
    path: str | None


def stocked_pairs(inventory: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stores and items of the baseline whose store is known."""
    return inventory.select("store_id", "item_id").distinct().join(nodes.select("store_id").distinct(), "store_id", "left_semi")


def expected_positions(inventory: DataFrame, nodes: DataFrame, dates: DataFrame) -> DataFrame:
    """Days times stocked pairs: what the ledger must hold."""
    days = dates.agg(F.countDistinct("business_date")).scalar()
    return stocked_pairs(inventory, nodes).agg((F.count(F.lit(1)) * days).alias("positions"))


def parity_gate(found: int, expected: int) -> None:
    if found != expected:
        raise L.ContractError(f"{found:,} ledger rows, expected {expected:,}")


def run(
    spark: SparkSession,
    sources: Sources,
    target: str,
    settings: L.LedgerSettings = L.LedgerSettings(),
    form: str = "closed",
    dry_run: bool = False,
) -> NightlyResult:
    """Build the ledger once, in a staging folder beside the target; publish it only when it passed.

    The row count is compared with days times stocked pairs of the inputs, so a lost day or store is seen, and the
    staged files with what was written. Only then are the target's days replaced, from the staged files. A run
    that fails leaves the target as it was. The staging folder is removed by the file system's own owner.
    """
    silver = L.silver_sales(sources.pos, settings)
    led = L.ledger(L.positions(sources.inventory, sources.stores, silver), settings, form)
    if tuple(led.columns) != L.LEDGER_COLUMNS:
        raise L.ContractError(f"ledger columns are {led.columns}")
    if dry_run:
        return NightlyResult(L.check_contract(led), 0, None)
    staging = f"{target.rstrip('/')}.staging/{uuid.uuid4().hex}"
    order = ["store_id", "item_id"]
    staged = write_dated(led, staging, order=order)
    parity_gate(staged["n_rows"], expected_positions(sources.inventory, sources.stores, silver.dates).first()[0] or 0)
    if not staged["n_rows"]:
        return NightlyResult(0, 0, target)
    audit_written(spark, staging, L.LEDGER_COLUMNS, staged)
    written = write_dated(spark.read.parquet(staging).select(*L.LEDGER_COLUMNS), target, order=order)
    audit_written(spark, target, L.LEDGER_COLUMNS, written)
    return NightlyResult(written["n_rows"], int(written["checksum"]), target)
