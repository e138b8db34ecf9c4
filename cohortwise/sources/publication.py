"""All-or-nothing publication of layer tables, and layers stored alike.

``Publication`` keeps several layer tables under one root. A run writes every
layer into folders of its own and then one manifest that names, for each
layer, the folders that make up its state. Readers follow the newest manifest
only, so a run that breaks off between two layers, or in one, leaves the state
before it readable as a whole, and running it again starts from that state. A
manifest appears by a rename, after it has been written in full.

``write_copartitioned`` stores a layer in buckets of customers. Layers with the
same number of buckets join on ``customer_id`` without moving a row.

Layout: ``<root>/<layer>/run=<n>[/...]``, ``<root>/_manifests/<n>``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class Publication:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _numbers(self, folder: str, prefix: str = "") -> list[int]:
        p = self._path(folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []
        return sorted(int(x[len(prefix):]) for x in names if x.startswith(prefix) and x[len(prefix):].isdigit())

    def runs(self) -> list[int]:
        """Published runs, oldest first."""
        return self._numbers("_manifests")

    def manifest(self, run: int | None = None) -> dict[str, dict[str, str]]:
        """layer -> {part: folder} of a published run, the newest by default.
        A part is a day of a dated layer, or "" for a layer replaced as a whole."""
        runs = self.runs()
        if not runs:
            return {}
        rows = self.spark.read.text(f"{self.root}/_manifests/{run if run is not None else runs[-1]}", wholetext=True).collect()
        return json.loads(rows[0][0])  # one small file

    def read(self, layer: str, parts: list[str] | None = None, run: int | None = None) -> DataFrame:
        """A layer as published, or some of its parts."""
        folders = self.manifest(run).get(layer, {})
        chosen = [f"{self.root}/{f}" for p, f in sorted(folders.items()) if parts is None or p in parts]
        if not chosen:
            raise ValueError(f"{self.root} has published no {layer}" + (f" for {parts}" if parts else ""))
        return self.spark.read.parquet(*chosen)

    def begin(self) -> "Run":
        return Run(self)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes folders that none of the newest ``keep`` manifests names, and
        older manifests; also what runs that broke off left behind."""
        runs = self.runs()
        named = {"/".join(f.split("/")[:2]) for r in runs[-keep:] for folders in self.manifest(r).values() for f in folders.values()}
        gone = []
        for r in runs[:-keep]:
            self._fs.delete(self._path(f"_manifests/{r}"), False)
        for layer in {s.getPath().getName() for s in self._fs.listStatus(self._path(""))} - {"_manifests"}:
            for n in self._numbers(layer, "run="):
                folder = f"{layer}/run={n}"
                if folder not in named and n <= (runs[-1] if runs else -1):
                    self._fs.delete(self._path(folder), True)
                    gone.append(folder)
        return sorted(gone)


class Run:
    """One run: layers written to fresh folders, visible once ``publish`` has returned."""

    def __init__(self, table: Publication):
        self.table = table
        used = [*table.runs(), *(n for layer in table.manifest() for n in table._numbers(layer, "run="))]
        self.number = max(used, default=-1) + 1
        self.state = {layer: dict(parts) for layer, parts in table.manifest().items()}

    def write(self, df: DataFrame, layer: str, part: str = "") -> DataFrame:
        """Writes a layer, or one part of a dated layer, and reads it back for
        the layers above. Parts that the run does not write stay as they are."""
        folder = f"{layer}/run={self.number}" + (f"/{part}" if part else "")
        df.write.mode("overwrite").parquet(f"{self.table.root}/{folder}")
        whole = f"{layer}/run={self.number}"
        if part:
            self.state.setdefault(layer, {}).pop("", None)
            self.state[layer][part] = folder
        else:
            self.state[layer] = {"": whole}
        return self.table.spark.read.schema(df.schema).parquet(f"{self.table.root}/{folder}")

    def read(self, layer: str, parts: list[str] | None = None) -> DataFrame:
        """A layer as it will be published."""
        return self.table.spark.read.parquet(
            *[f"{self.table.root}/{f}" for p, f in sorted(self.state[layer].items()) if parts is None or p in parts])

    def keep(self, layer: str, parts_from: str) -> list[str]:
        """Leaves parts below ``parts_from`` out of the state."""
        old = sorted(p for p in self.state.get(layer, {}) if p < parts_from)
        for p in old:
            del self.state[layer][p]
        return old

    def publish(self) -> int:
        table = self.table
        temp, final = table._path(f"_manifests/.{self.number}.tmp"), table._path(f"_manifests/{self.number}")
        out = table._fs.create(temp, True)
        out.write(bytearray(json.dumps(self.state, sort_keys=True).encode()))
        out.close()
        if not table._fs.rename(temp, final):
            raise RuntimeError(f"run {self.number} of {table.root} was published by someone else")
        return self.number


# ---------------------------------------------------------------------------
# Layers stored alike
# ---------------------------------------------------------------------------
def write_copartitioned(df: DataFrame, name: str, path: str, buckets: int, by: str | None = None) -> None:
    """A layer as table ``name`` at ``path``, in ``buckets`` of ``customer_id``,
    sorted within; ``by`` partitions it as well (a day). One task writes each
    bucket, so a bucket is one file per partition and its order survives."""
    w = df.repartition(buckets, "customer_id").write.mode("overwrite").option("path", path)
    w = w.bucketBy(buckets, "customer_id").sortBy("customer_id")
    (w.partitionBy(by) if by else w).saveAsTable(name)


def open_copartitioned(spark: SparkSession, name: str, path: str, schema: str, buckets: int, by: str | None = None) -> DataFrame:
    """A layer written by another session: names its files in this session's catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet" + (f" PARTITIONED BY ({by})" if by else "")
              + f" CLUSTERED BY (customer_id) SORTED BY (customer_id) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
