"""Per-distinct-value work: expensive scalar steps cost distinct values, not rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.session import materialise


def map_distinct(df: DataFrame, cols: str | Sequence[str], fn: Callable[[DataFrame], DataFrame],
                 out: str | Sequence[str]) -> DataFrame:
    """Add ``out`` column(s) computed by ``fn`` once per distinct value of ``cols``.

    ``fn`` maps a frame whose key columns are renamed ``_k0, _k1, ...`` to one
    that also has the ``out`` columns. Expensive scalar work (the similarity
    match, dictionary chains) then costs distinct values x dictionary instead
    of rows x dictionary. The distinct step aggregates partially on the map
    side (hot values collapse before the shuffle).

    Only the mapping is written to the shared folder and read back, so ``fn``
    runs exactly where it stands. The distinct step reads the input by itself,
    pruned to the key columns; the join reads it once more, whole, and no copy
    of it is made. The mapping joins back null-safely; the engine broadcasts it only under its own
    size threshold, else the join is a shuffle join with skew splitting."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    outs = [out] if isinstance(out, str) else list(out)
    keys = [f"_k{i}" for i in range(len(cols))]
    distinct = df.select(*[F.col(c).alias(k) for c, k in zip(cols, keys)]).distinct()
    # The keys are few bytes but CPU-heavy: deal them to as many tasks as the
    # session shuffles to (the cluster's setting follows its data). Hash of a
    # derived expression: the distinct already satisfies one on the keys.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.repartition(tasks, F.xxhash64(*[F.col(k) for k in keys]))
    mapping = materialise(fn(dealt).select(*keys, *outs), "distinct-mapping")
    cond = None
    for c, k in zip(cols, keys):
        e = df[c].eqNullSafe(mapping[k])
        cond = e if cond is None else (cond & e)
    return df.join(mapping, cond, "left").drop(*keys)
