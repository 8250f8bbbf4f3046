"""A fact log that keeps itself small, with numbered generations.

Each micro-batch adds one folder of facts. Whenever FANOUT folders of one level stand, they are merged into
one of the next level, as in a counter, so after n batches there are at most (FANOUT - 1) folders a level and
log(n) levels. A generation is one small table that names the live folders; it is written last, so readers see
whole batches only, and a batch that is run again finds its generation and does nothing. Folders that no kept
generation names are deleted; KEPT generations stay for readers that have just looked.

The merge takes maxima only, so its order and repeats change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.operators.incremental import merge_facts, state_from_facts

FANOUT, KEPT = 8, 3


def due_merge(live: list[str]) -> tuple[list[str], str] | None:
    """The lowest level with FANOUT folders, and the folder they become."""
    levels: dict[int, list[str]] = {}
    for folder in sorted(live):
        levels.setdefault(int(folder.split("-")[0]), []).append(folder)
    for level, same in sorted(levels.items()):
        if len(same) >= FANOUT:
            return same, f"{level + 1}-{same[0].split('-')[1]}-{same[-1].split('-')[2]}"
    return None


class FactLog:
    """Facts by ``keys`` below ``path``: ``facts/<level>-<first batch>-<last batch>`` and
    ``generations/<batch>``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # --- folders -------------------------------------------------------------------------------

    def _fs(self, path: str):
        """The Hadoop file system of a path: the store may be any that Spark reads."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, name: str) -> None:
        fs, p = self._fs(f"{self.path}/{name}")
        fs.delete(p, True)

    def generations(self) -> list[int]:
        """Numbers of the finished generations, oldest first."""
        finished = []
        for name in self._names("generations"):
            fs, p = self._fs(f"{self.path}/generations/{name}/_SUCCESS")
            if fs.exists(p):
                finished.append(int(name))
        return sorted(finished)

    def live(self, generation: int | None = None) -> list[str]:
        """Fact folders of a generation, by default the newest."""
        known = self.generations()
        if generation is None and known:
            generation = known[-1]
        if generation not in known:
            return []
        rows = self.spark.read.schema("folder string").parquet(f"{self.path}/generations/{generation:012d}").collect()
        return sorted(r["folder"] for r in rows)  # a few folders a level

    # --- reading -------------------------------------------------------------------------------

    def facts(self, generation: int | None = None) -> DataFrame | None:
        folders = self.live(generation)
        if not folders:
            return None
        return merge_facts(self.spark.read.parquet(*[f"{self.path}/facts/{f}" for f in folders]), self.keys)

    def state(self, generation: int | None = None) -> DataFrame | None:
        """State as of a generation, None before the first."""
        facts = self.facts(generation)
        return None if facts is None else state_from_facts(facts, self.keys)

    # --- writing -------------------------------------------------------------------------------

    def add(self, facts: DataFrame, batch: int) -> None:
        """One micro-batch of facts; nothing happens when it is there already."""
        known = self.generations()
        if known and batch <= known[-1]:
            return
        folder = f"0-{batch:012d}-{batch:012d}"
        facts.write.mode("overwrite").parquet(f"{self.path}/facts/{folder}")
        live = self._merged([*self.live(), folder])
        rows = self.spark.createDataFrame([(f,) for f in live], "folder string").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/generations/{batch:012d}")
        self._sweep()

    def _merged(self, live: list[str]) -> list[str]:
        while (due := due_merge(live)) is not None:
            same, target = due
            read = self.spark.read.parquet(*[f"{self.path}/facts/{f}" for f in same])
            merge_facts(read, self.keys).write.mode("overwrite").parquet(f"{self.path}/facts/{target}")
            live = [f for f in live if f not in same] + [target]
        return live

    def _sweep(self) -> None:
        """Delete generations before the kept ones, and folders that none of those names."""
        known = self.generations()
        used = {f for g in known[-KEPT:] for f in self.live(g)}
        for name in self._names("facts"):
            if name not in used:
                self._delete(f"facts/{name}")
        for old in known[:-KEPT]:
            self._delete(f"generations/{old:012d}")
