"""Counts of a run, taken while its rows are written.

RunCounts hangs observed metrics on the frames that a job writes: the rows are counted in the tasks that produce them, so no row is
read or parsed a second time. A count stands for the first write of its frame; a task that is tried again is counted once,
a stage that is worked out again after a lost executor may count rows twice, so totals that must be exact come from what was stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

REPORT = "kind string, step string, source string, rows long"


class RunCounts:
    """Rows of each kind and step (items, accepted, quarantined) of one run.

    sources: names whose rows are counted apart as well, such as those of a registry. They are bounded, as each is one more metric.
    """

    def __init__(self, sources: Sequence[str] = ()):
        self.sources = list(dict.fromkeys(sources))
        self._watched: list[tuple[str, str, bool, Observation]] = []

    def watch(self, rows: DataFrame, kind: str, step: str, source: str | None = None) -> DataFrame:
        """rows, counted when they are first written; by the names in the column source if it is given."""
        seen = Observation(f"{kind}-{step}-{len(self._watched)}")
        by_name = [F.count_if(F.col(source).eqNullSafe(F.lit(name))).alias(f"source_{i}") for i, name in enumerate(self.sources)] if source else []
        self._watched.append((kind, step, bool(source), seen))
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *by_name)

    def totals(self) -> list[tuple[str, str, str | None, int]]:
        """(kind, step, source, rows) of all watched frames, which must have been written; source is None for all rows. Rejected
        rows are the items that were not accepted."""
        found: dict[tuple[str, str, str | None], int] = {}
        for kind, step, by_name, seen in self._watched:
            counts = seen.get
            named = [(name, counts[f"source_{i}"]) for i, name in enumerate(self.sources)] if by_name else []
            for name, n in [(None, counts["rows"]), *named]:
                found[kind, step, name] = found.get((kind, step, name), 0) + n
        for (kind, step, name), n in list(found.items()):
            if step == "items" and (kind, "accepted", name) in found:
                found[kind, "rejected", name] = n - found[kind, "accepted", name]
        return [(*key, n) for key, n in found.items()]

    def report(self, spark: SparkSession) -> DataFrame:
        """totals as rows: a few for each kind and source."""
        return spark.createDataFrame(self.totals(), REPORT)
