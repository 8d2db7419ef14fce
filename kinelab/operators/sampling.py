"""Row sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab import config as C


def sample_rows(df: DataFrame, fraction: float = C.SAMPLE_RATE, seed: int = C.SEED,
                keys: Sequence[str] | None = None) -> DataFrame:
    """Bernoulli sample.

    At 1.0 no Sample node is added (it would block predicate pushdown).
    With ``keys`` the sample is a prefix of the MD5 of the keys, repeatable
    whatever the partitioning or the engine; without, Spark's seeded ``sample``.
    """
    if fraction >= 1.0:
        return df
    if keys:
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
        return df.where(F.substring(F.md5(text), 1, 8) < F.lit(f"{int(fraction * (1 << 32)):08x}"))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
