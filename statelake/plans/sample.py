"""A fixed-size sample of orders and everything that belongs to it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from statelake.operators.sampling import ORDER_STATUS_CAPS, SEED, child_rows, stratified_sample
from statelake.session import materialized
from statelake.sources.files import write_csv


def stratified_orders(
    orders: DataFrame,
    children: Mapping[str, DataFrame],
    caps: Mapping[str, int] = ORDER_STATUS_CAPS,
    stratum: str = "order_status",
    key: str = "order_id",
    seed: int = SEED,
) -> dict[str, DataFrame]:
    """``orders`` sampled per stratum, and each child table cut down to the sampled orders."""
    sample = stratified_sample(orders, stratum, caps, key, seed)
    bound = sum(caps.values())
    return {"orders": sample, **{name: child_rows(df, sample, key, max_sample_rows=bound) for name, df in children.items()}}


def write_sample(sample: Mapping[str, DataFrame], folder: str) -> None:
    """One CSV folder per table."""
    for name, df in sample.items():
        write_csv(df, f"{folder}/{name}_sample")


def write_sampled_orders(
    orders: DataFrame,
    children: Mapping[str, tuple[DataFrame, str, str]],
    folder: str,
    caps: Mapping[str, int] = ORDER_STATUS_CAPS,
    stratum: str = "order_status",
    key: str = "order_id",
    seed: int = SEED,
) -> None:
    """A sample and the rows that belong to it, written; ``children`` has the table, the column of the
    sample and the column of the table. The sample is computed once, for however many tables."""
    with materialized(stratified_sample(orders, stratum, caps, key, seed), "sample") as sample:
        bound = sum(caps.values())
        write_sample({"orders": sample, **{name: child_rows(df, sample, own, theirs, bound) for name, (df, own, theirs) in children.items()}}, folder)
