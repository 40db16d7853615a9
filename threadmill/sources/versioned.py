"""A table of versions: each change publishes a whole new state, and of two writers that began from one version one wins."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from threadmill.session import hadoop_path


class Moved(RuntimeError):
    """Another writer published first: read again and retry."""


class Versions:
    """States under random names, published by creating the marker file ``v<N>``, which names one.

    Creation is exclusive, so a writer either publishes its version whole or
    raises ``Moved`` without having changed anything, and readers see a version
    whole or not at all. No folder is ever renamed.
    """

    schema: str

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self._fs, path = hadoop_path(spark, self.root)
        self._fs.mkdirs(path)
        self._local = self._fs.getUri().getScheme() == "file"

    def _at(self, name: str):
        return hadoop_path(self.spark, f"{self.root}/{name}")[1]

    def version(self) -> int:
        """The number of the latest version, -1 if there is none."""
        names = [x.getPath().getName() for x in self._fs.listStatus(hadoop_path(self.spark, self.root)[1])]
        return max((int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit()), default=-1)

    def _state(self, n: int) -> str:
        stream = self._fs.open(self._at(f"v{n}"))
        try:
            name = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        if not name:
            raise Moved(f"version {n} is being published; if its writer is gone, remove the empty marker v{n}")
        return name

    def read(self, version: int | None = None) -> DataFrame:
        """A version, the latest if none is given; an empty table before the first."""
        n = self.version() if version is None else version
        return self.spark.createDataFrame([], self.schema) if n < 0 else self.spark.read.schema(self.schema).parquet(f"{self.root}/{self._state(n)}")

    def _claim(self, n: int, name: str) -> bool:
        """Create the marker of version n, unless it exists."""
        if self._local:
            # a hard link is made whole or not at all, and never over another
            place = f"{self.root}/v{n}".removeprefix("file://").removeprefix("file:")
            draft = f"{place}.{uuid.uuid4().hex}"
            with open(draft, "w") as fh:
                fh.write(name)
            try:
                os.link(draft, place)
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(draft)
        try:
            stream = self._fs.create(self._at(f"v{n}"), False)
        except Exception:
            if self._fs.exists(self._at(f"v{n}")):
                return False
            raise
        stream.write(bytearray(name.encode()))
        stream.close()
        return True

    def publish(self, df: DataFrame, base: int) -> int:
        """Write a state and publish it as version base + 1, which is returned."""
        name = f"state-{uuid.uuid4().hex}"
        df.select(*self.columns).write.parquet(f"{self.root}/{name}")
        if not self._claim(base + 1, name):
            self._fs.delete(self._at(name), True)
            raise Moved(f"{self.root} moved past version {base}; read it again and retry")
        return base + 1

    def vacuum(self, keep: int = 2) -> None:
        """Remove the states of all but the latest ``keep`` versions. Markers stay, so no number is used again."""
        for n in range(self.version() - keep, -1, -1):
            path = self._at(self._state(n))
            if not self._fs.exists(path):
                break
            self._fs.delete(path, True)
