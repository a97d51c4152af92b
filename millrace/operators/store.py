"""A table on disk in buckets of its key, of which a change swaps only those it touches, at once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketStore:
    """Rows in ``buckets`` by the hash of their key columns.

    A generation is a manifest that names the folder of each bucket. A change writes new folders for the buckets it touches,
    then a new manifest, and renames the pointer file onto the old one: a reader sees all of a change or nothing
    of it, and a writer that dies leaves the old generation. The first writer to claim the next generation's number wins, any other
    is refused. Folders that neither this nor the last generation names are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 16) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(self._conf)

    def _text(self, name: str) -> str | None:
        at = self._Path(f"{self.path}/{name}")
        if not self._fs.exists(at):
            return None
        source = self._fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def _write(self, name: str, text: str, overwrite: bool) -> None:
        out = self._fs.create(self._Path(f"{self.path}/{name}"), overwrite)
        out.write(bytearray(text.encode()))
        out.close()

    def manifest(self, generation: int | None = None) -> dict | None:
        n = generation if generation is not None else self.generation()
        text = None if n is None else self._text(f"manifest-{n}")
        return json.loads(text) if text else None

    def generation(self) -> int | None:
        text = self._text("CURRENT")
        return int(text) if text else None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self, touched: list[int] | None = None) -> DataFrame:
        """All rows, or those of the buckets ``touched``."""
        now = self.manifest()
        folders = sorted({f for b, f in now["folders"].items() if touched is None or int(b) in touched})
        schema = self.spark.createDataFrame([], now["schema"]).schema
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets that rows with these keys lie in: ``buckets`` numbers at most."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def replace(self, rows: DataFrame) -> int:
        """A generation of ``rows`` alone."""
        return self.swap(rows, list(range(self.buckets)))

    def swap(self, rows: DataFrame, touched: list[int]) -> int:
        """A generation in which the buckets ``touched`` hold ``rows`` and all others what they held."""
        old = self.generation()
        new = (old or 0) + 1
        try:
            self._write(f"claim-{new}", uuid.uuid4().hex, False)
        except Exception as e:
            raise RuntimeError(f"another writer has claimed generation {new}") from e
        done = False
        folder = f"{self.path}/data-{new}-{uuid.uuid4().hex}"
        try:
            schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
            out = rows.withColumn("_bucket", self.bucket())
            out.repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
            written = [st.getPath().getName() for st in self._fs.listStatus(self._Path(folder))]
            if foreign := {b for b in written if b.startswith("_bucket=")} - {f"_bucket={b}" for b in touched}:
                raise ValueError(f"rows of buckets that aren't touched: {sorted(foreign)}")
            folders = dict((self.manifest(old) or {"folders": {}})["folders"]) if old else {}
            for b in touched:
                at = f"{folder}/_bucket={b}"
                folders.pop(str(b), None)
                if self._fs.exists(self._Path(at)):
                    folders[str(b)] = at
            self._write(f"manifest-{new}", json.dumps({"schema": schema, "folders": folders}), True)
            self._write(f".CURRENT-{new}", str(new), True)
            rename = self._jvm.org.apache.hadoop.fs.Options.Rename
            flags = self.spark.sparkContext._gateway.new_array(rename, 1)
            flags[0] = rename.OVERWRITE
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._Path(self.path).toUri(), self._conf)
            context.rename(self._Path(f"{self.path}/.CURRENT-{new}"), self._Path(f"{self.path}/CURRENT"), flags)
            done = True
        finally:
            if not done:  # the claim is given up, the pointer still names the old generation
                self._fs.delete(self._Path(f"{self.path}/claim-{new}"), False)
                self._fs.delete(self._Path(folder), True)
        self._clear(new)
        return new

    def _clear(self, current: int) -> None:
        keep = {f for n in (current, current - 1) for f in (self.manifest(n) or {"folders": {}})["folders"].values()}
        for status in self._fs.listStatus(self._Path(self.path)):
            name = status.getPath().getName()
            if name.startswith("data-") and int(name.split("-")[1]) <= current:
                if not any(f"/{name}/" in f for f in keep):
                    self._fs.delete(status.getPath(), True)
                else:
                    for part in self._fs.listStatus(status.getPath()):
                        at = part.getPath().getName()
                        if at.startswith("_bucket=") and not any(f.endswith(f"/{name}/{at}") for f in keep):
                            self._fs.delete(part.getPath(), True)
            elif name.startswith(("manifest-", "claim-")) and int(name.split("-")[1]) < current - 1:
                self._fs.delete(status.getPath(), False)
