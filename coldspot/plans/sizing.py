"""Size checks before broadcasting, and lineage cuts through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most
    ``max_rows + 1`` rows, so the check is cheap for any input size."""
    return df.limit(max_rows + 1).count() <= max_rows


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and continue from
    the written copy (reliable ``checkpoint``, never a local one).

    Used where one aggregated result feeds several branches of a plan (e.g.
    a report referenced by a subquery and a join): without it every branch
    recomputes the whole chain from the source tables. The folder is the one
    the cluster names in ``spark.checkpoint.dir``; see ``session.checkpoint_dir``.
    """
    from coldspot.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
