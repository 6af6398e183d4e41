"""Add a further release of a corpus to counts that are stored by decade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import broadcast_if_bounded
from .materialize import Workspace


def add_release(stored: DataFrame, path: str, delta: DataFrame, measure: str, workspace: Workspace) -> DataFrame:
    """Add the counts of ``delta`` to the table at ``path``; the decades that were written.

    stored  the table as its reader gives it; its columns but ``measure`` are the key
    delta   counts of the same columns: U, or B, of the new release alone
    path    parquet by decade, as ``write_unigrams`` lays it out

    Only decades of the delta are read and written: the others' files stay as they are. New
    counts are whole in the workspace before any of the old ones goes, and take their places
    decade by decade (dynamic partition overwrite). Adding a release twice counts it twice.
    """
    key = [c for c in stored.columns if c != measure]
    delta = workspace.materialize(delta.select(*key, measure))
    touched = workspace.materialize(delta.select("decade").distinct())
    own = stored.join(broadcast_if_bounded(touched), "decade", "left_semi").select(*key, measure)
    merged = own.unionByName(delta).groupBy(*key).agg(F.sum(measure).alias(measure))
    whole = workspace.materialize(merged)
    laid_out = whole.hint("rebalance", "decade").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    laid_out.partitionBy("decade").parquet(path)
    return touched
