"""Builds that go on where they stopped, and outputs that appear together.

A :class:`Build` keeps its stages as tables in buckets of their key, and notes each finished one in a manifest.
Stages keyed alike need no exchange between them. A stage is noted after its files are committed, by one file that
is renamed into place, and each attempt writes a folder of its own: a build that died is simply started again.

:func:`publish` writes several outputs below a fresh version folder. The version counts from the moment an
empty marker file of the next number exists, which is the last thing that happens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MANIFEST, MARKERS = "_finished", "_published"


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


class Build:
    """The finished stages below ``root``. One root is one build: other inputs or settings need another root."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def finished(self, name: str) -> dict | None:
        fs, at = _fs(self.spark, f"{self.root}/{MANIFEST}/{name}")
        if not fs.exists(at):
            return None
        return json.loads(self.spark.read.text(str(at), wholetext=True).first()[0])

    def _note(self, name: str, entry: dict) -> None:
        fs, part = _fs(self.spark, f"{self.root}/{MANIFEST}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(part)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if not fs.rename(part, _fs(self.spark, f"{self.root}/{MANIFEST}/{name}")[1]):
            raise OSError(f"stage {name} could not be noted below {self.root}")

    def _table(self, entry: dict) -> DataFrame:
        name = f"panelwright_{uuid.uuid4().hex}"
        by, order = (", ".join(f"`{c}`" for c in entry[k]) for k in ("by", "sort"))
        self.spark.sql(
            f"CREATE TABLE {name} ({entry['schema']}) USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) INTO {entry['buckets']} BUCKETS LOCATION '{entry['path']}'"
        )
        return self.spark.table(name)

    def stage(self, name: str, make: Callable[[], DataFrame], by: list[str], sort: list[str] | None = None) -> DataFrame:
        """The table of a stage, dealt by ``by`` and sorted by ``sort`` inside a bucket; made only if not finished."""
        entry = self.finished(name)
        if entry is None:
            df = make()
            path, order = f"{self.root}/{name}-{uuid.uuid4().hex}", [*by, *(sort or [])]
            temporary = f"panelwright_{uuid.uuid4().hex}"
            dealt = df.repartition(self.buckets, *by).write.bucketBy(self.buckets, *by).sortBy(*order)
            dealt.format("parquet").option("path", path).saveAsTable(temporary)
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
            entry = {"path": path, "by": by, "sort": order, "buckets": self.buckets, "schema": schema}
            self._note(name, entry)
        return self._table(entry)


def latest(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and folder of the version that counts."""
    fs, at = _fs(spark, f"{root}/{MARKERS}")
    names = sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []
    return (int(names[-1][:8]), f"{root}/{names[-1][9:]}") if names else None


def publish(spark: SparkSession, root: str, outputs: dict[str, Callable[[str], None]]) -> str:
    """Write all outputs ({name: function of a path}) below a fresh folder, then make it the version that counts. If one
    fails, readers keep the former version."""
    root = root.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    for name, write in outputs.items():
        write(f"{root}/{version}/{name}")
    before = latest(spark, root)
    fs, marker = _fs(spark, f"{root}/{MARKERS}/{(before[0] if before else 0) + 1:08d}-{version}")
    if not fs.createNewFile(marker):
        raise OSError(f"{marker} exists")
    return f"{root}/{version}"


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of the version that counts."""
    found = latest(spark, root.rstrip("/"))
    if found is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    return spark.read.parquet(f"{found[1]}/{name}")
