"""Gates that are checked while tables are written.

Value gates and row counts are observed in the write itself: no row is read again. Keys need rows of one key
together, so each unique key costs one aggregate over its own columns of the stored table, and each reference
one anti join of distinct keys. A load that fails any gate is not published.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cadastra.functions.cols import as_list
from cadastra.operators import quality
from cadastra.sources import writers


@dataclass(frozen=True)
class Checks:
    """What must hold for a table.

    ``holds`` names conditions, as columns or SQL, that every row must meet (null is not met), ``unique`` lists keys that occur at
    most once (rows with a null in the key are left out), ``parents`` maps a table of the same load to
    ``{column: its column}``: keys without a parent are refused.
    """

    holds: dict[str, Column | str] = field(default_factory=dict)
    unique: tuple = ()
    parents: dict[str, dict[str, str]] = field(default_factory=dict)
    least_rows: int = 0


def write_observed(df: DataFrame, path: str, checks: Checks) -> dict[str, int]:
    """Write ``df`` once; the number of its rows (``rows``) and of rows that miss each condition come with the write."""
    seen = Observation()
    conditions = {name: F.expr(c) if isinstance(c, str) else c for name, c in checks.holds.items()}
    misses = {name: F.count_if(~F.coalesce(condition, F.lit(False))) for name, condition in conditions.items()}
    names = {f"c{i}": name for i, name in enumerate(misses)}
    counted = [misses[name].alias(key) for key, name in names.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counted).write.parquet(path)
    found = seen.get
    return {"rows": found["rows"], **{name: found[key] for key, name in names.items()}}


def _repeats(stored: DataFrame, key) -> int:
    """Rows that repeat a key, over the first of each."""
    columns = as_list(key)
    counts = stored.select(*columns).dropna().groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]


class RefusedLoad(quality.GateError):
    """A load that failed gates; ``report`` has (table, gate, rows) of all that were checked."""

    def __init__(self, report: list[tuple[str, str, int]]):
        failed = "; ".join(f"{table}: {gate} ({n})" for table, gate, n in report if n)
        super().__init__(f"refused load: {failed}")
        self.report = report


def publish_checked(spark: SparkSession, root: str, frames: dict[str, DataFrame], checks: dict[str, Checks]) -> list[tuple[str, str, int]]:
    """All-or-nothing load like :func:`writers.publish_tables`, checked while it is written.

    Every frame is evaluated once. Returns the report of all gates, each with 0 rows; raises
    :class:`RefusedLoad` with the counts otherwise, and readers keep the version before.
    """
    missing = {parent for check in checks.values() for parent in check.parents} | set(checks)
    if missing - set(frames):
        raise KeyError(f"checks name tables that are not in the load: {sorted(missing - set(frames))}")
    report: list[tuple[str, str, int]] = []

    def write(df: DataFrame, name: str, path: str) -> None:
        found = write_observed(df, path, checks.get(name, Checks()))
        rows = found.pop("rows")
        if name in checks:
            least = checks[name].least_rows
            report.extend([(name, f"at least {least} rows", max(0, least - rows))] if least else [])
            report.extend((name, gate, n) for gate, n in found.items())

    def keys(stored: dict[str, DataFrame]) -> None:
        for name, check in checks.items():
            report.extend((name, f"{'+'.join(as_list(key))} is unique", _repeats(stored[name], key)) for key in check.unique)
            for parent, on in check.parents.items():
                report.append((name, f"{'+'.join(on)} is in {parent}", quality.orphan_keys(stored[name], stored[parent], on).count()))
        if any(n for *_, n in report):
            raise RefusedLoad(report)

    writers.publish_tables(spark, root, frames, keys, write)
    return report
