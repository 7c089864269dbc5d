"""Tables written once to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the session's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing), pins anything
    sampled or nondeterministic upstream, and lets every later pass read only the columns it uses.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
