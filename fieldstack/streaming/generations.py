"""Tables that grow by micro-batches, in a bounded number of partitions.

Every micro-batch writes one partition (``epoch``) of the open tail, replacing what an earlier try of it left. When the
tail has ``every`` epochs, those before the current one (all committed) are merged into a segment; ``fan`` segments of one level are
merged into one of the next, so a table of n micro-batches has at most ``every`` partitions and ``fan`` segments for each of log(n) levels, and
a row is rewritten log(n) times. A manifest names the segments, the last epoch they hold and the open tail. It is a small file under a
number of its own, moved into place when it is whole, so readers see one generation or the next.

A crash leaves the old manifest, with whatever was written unnamed, or the new one; the micro-batch that is tried again has the same
number and replaces its own partition, so no row is lost or counted twice. Unnamed and outdated folders stay for readers
that began before; ``unnamed`` lists them for whoever keeps the storage.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Manifest:
    generation: int = 0
    through: int = -1                                   # last epoch that the segments hold
    segments: list[list] = field(default_factory=list)  # [level, folder]
    tail: str = "tail-0"


class Generations:
    """A growing table at ``path`` with the columns of ``schema`` (DDL). ``merge`` makes rows of several epochs fewer; it
    must not depend on how epochs are grouped."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                 every: int = 50, fan: int = 8):
        self.spark, self.path, self.schema, self.merge, self.every, self.fan = spark, path.rstrip("/"), schema, merge, every, fan
        self._fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- the manifest

    def _names(self, folder: str) -> list[str]:
        p = self._fs_path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def manifest(self) -> Manifest:
        numbers = [int(n[2:-5]) for n in self._names("manifests") if n.startswith("g-") and n.endswith(".json")]
        if not numbers:
            return Manifest()
        text = self.spark.read.text(f"{self.path}/manifests/g-{max(numbers):012d}.json", wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def _commit(self, m: Manifest) -> None:
        whole = self._fs_path(f"{self.path}/manifests/g-{m.generation:012d}.json")
        part = self._fs_path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()
        if not self._fs.rename(part, whole):
            raise RuntimeError(f"generation {m.generation} of {self.path} was written by another stream")
        for old in range(m.generation - 20, m.generation - 10):     # so that listing stays short, too
            self._fs.delete(self._fs_path(f"{self.path}/manifests/g-{old:012d}.json"), False)

    def unnamed(self) -> list[str]:
        """Folders that the current generation doesn't use."""
        m = self.manifest()
        used = {m.tail, "manifests", *(name for _, name in m.segments)}
        return sorted(n for n in self._names("") if n not in used)

    # ---- writing

    def write(self, rows: DataFrame, epoch: int) -> None:
        """The rows of micro-batch ``epoch``."""
        m = self.manifest()
        if epoch <= m.through:
            raise RuntimeError(f"micro-batch {epoch} of a stream that began anew; {self.path} holds {m.through + 1} already")
        if epoch - m.through > self.every:
            m = self._compact(m, epoch)
        rows.write.mode("overwrite").parquet(f"{self.path}/{m.tail}/epoch={epoch}")

    def _segment(self, rows: DataFrame, level: int) -> list:
        name = f"segment-{level}-{uuid.uuid4().hex}"
        self.merge(rows).write.parquet(f"{self.path}/{name}")
        return [level, name]

    def _compact(self, m: Manifest, epoch: int) -> Manifest:
        segments = [*m.segments]
        if self._tail(m):
            segments.append(self._segment(self._read(self._tail(m)), 0))
        level = 0
        while len(same := [s for s in segments if s[0] == level]) >= self.fan:
            merged = self._segment(self._read([name for _, name in same]), level + 1)
            segments = [s for s in segments if s[0] != level] + [merged]
            level += 1
        m = replace(m, generation=m.generation + 1, through=epoch - 1, segments=segments, tail=f"tail-{m.generation + 1}")
        self._commit(m)
        return m

    # ---- reading

    def _tail(self, m: Manifest, before: int | None = None) -> list[str]:
        epochs = [int(n.split("=")[1]) for n in self._names(m.tail) if n.startswith("epoch=")]
        return [f"{m.tail}/epoch={e}" for e in sorted(epochs) if before is None or e < before]

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def epochs(self) -> tuple[int, int | None]:
        """The last epoch that was written whole, and the one that was begun after it, if any: whoever writes repeats that one first."""
        m = self.manifest()
        begun = sorted(int(n.split("=")[1]) for n in self._names(m.tail) if n.startswith("epoch="))
        whole = [e for e in begun if self._fs.exists(self._fs_path(f"{self.path}/{m.tail}/epoch={e}/_SUCCESS"))]
        last = max(whole, default=m.through)
        return last, min((e for e in begun if e > last), default=None)

    def partitions(self) -> list[str]:
        """Folders that a reader lists."""
        m = self.manifest()
        return [name for _, name in m.segments] + self._tail(m)

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, unmerged; ``before``: of earlier micro-batches only, whatever an interrupted try of this one wrote."""
        m = self.manifest()
        return self._read([name for _, name in m.segments] + self._tail(m, before))

    def current(self) -> DataFrame:
        return self.merge(self.rows())
