"""From a raw table to balanced, fully numeric training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.columns import drop_by_name, drop_by_position
from ..operators.encode import TargetEncoder
from ..operators.impute import impute
from ..operators.oversample import split_and_oversample
from ..operators.profile import drop_sparse, label_distribution
from ..session import cut


@dataclass
class Cleaned:
    rows: DataFrame
    """``row_id, label, features..., synthetic, part``"""
    features: list[str]
    distribution: DataFrame
    encoder: TargetEncoder


def clean(
    df: DataFrame,
    row_id: str,
    label: str,
    categories: Sequence[str],
    drop_first: int = 3,
    drop_names: Sequence[str] = (),
    null_threshold: float = 30.0,
    test_size: float = 0.2,
    seed: int = 42,
) -> Cleaned:
    """Drop sparse columns, impute, drop columns, encode, split and balance, in this order.

    ``drop_first`` counts columns that survive the sparse ones, the row id
    aside. Category columns dropped on the way are skipped by the encoder.
    """
    df = cut(df, "raw")  # the steps below read their input several times
    kept = drop_sparse(df.drop(row_id), null_threshold).columns
    table = df.select(row_id, *kept)
    distribution = label_distribution(table, label)
    table = impute(table, skip=[row_id])
    table = drop_by_name(drop_by_position(table, 1, 1 + drop_first), *drop_names)
    encoder = TargetEncoder.fit(table, [c for c in categories if c in table.columns], label)
    table = cut(encoder.transform(table, row_id), "encoded")
    features = [c for c in table.columns if c not in (row_id, label)]
    rows = split_and_oversample(table, row_id, label, features, test_size, seed=seed)
    return Cleaned(rows, features, distribution, encoder)
