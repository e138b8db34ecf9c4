"""Versioned tables for streaming merges.

A table is a folder of parts; every epoch writes its own part folders and
publishes itself last, by a marker file. A merge of epoch ``n`` reads only
published epochs below ``n``, so an epoch that runs again, after a crash at
any point or after it was already published, starts from the same state and
writes the same result. Nothing that a merge reads is ever overwritten by it.

Layout: ``<table>/<part>/epoch=<n>[/bucket=<b>]``, ``<table>/_epochs/<n>``, and
what is fixed for the life of a table as ``<table>/_settings/<name>=<value>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str, prefix: str = "") -> list[str]:
        p = self._path(folder)
        if not self._fs.exists(p):
            return []
        return [x[len(prefix):] for x in (s.getPath().getName() for s in self._fs.listStatus(p)) if x.startswith(prefix)]

    # -- epochs ---------------------------------------------------------
    def epochs(self, before: int | None = None) -> list[int]:
        """Published epochs, oldest first; only those below ``before`` if given."""
        found = sorted(int(x) for x in self._names("_epochs") if x.isdigit())
        return [e for e in found if before is None or e < before]

    def begin(self, epoch: int) -> None:
        """Withdraws the epoch's marker: until it is published again, readers
        see the epoch before it. Only the newest epoch can run again; what
        older ones started from may have expired."""
        if any(e > epoch for e in self.epochs()):
            raise ValueError(f"epoch {epoch} of {self.path} has successors: rebuild the table to replay it")
        self._fs.delete(self._path(f"_epochs/{epoch}"), False)

    def publish(self, epoch: int) -> None:
        self._fs.create(self._path(f"_epochs/{epoch}"), True).close()

    def refuse_fresh_checkpoint(self, checkpoint: str) -> None:
        """A stream that starts over counts its epochs from 0 again; over a
        table that already has epochs, its merges would see none of them."""
        p = self._jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + "/offsets")
        if self.epochs() and not p.getFileSystem(self._conf).exists(p):
            raise ValueError(f"{self.path} holds epochs of another run: give the checkpoint it was written with, or a new table")

    # -- settings -------------------------------------------------------
    def setting(self, name: str) -> str | None:
        found = self._names("_settings", f"{name}=")
        return found[0] if found else None

    def set_setting(self, name: str, value) -> None:
        if self.setting(name) is None:
            self._fs.create(self._path(f"_settings/{name}={value}"), True).close()

    # -- parts ----------------------------------------------------------
    def write(self, df: DataFrame, part: str, epoch: int, by: str | None = None) -> None:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(by) if by else w).parquet(f"{self.path}/{part}/epoch={epoch}")

    def newest(self, part: str, before: int | None = None) -> list[str]:
        """Paths that make up the newest published state: the last epoch's
        folder, or for a bucketed part the last one of each bucket."""
        paths: dict[str, str] = {}
        for e in self.epochs(before):
            folder = f"{part}/epoch={e}"
            buckets = self._names(folder, "bucket=")
            if not buckets and any(x.startswith("part-") for x in self._names(folder)):
                paths[""] = f"{self.path}/{folder}"
            for b in buckets:
                paths[b] = f"{self.path}/{folder}/bucket={b}"
        return [paths[k] for k in sorted(paths)]

    def parts_of(self, part: str, epoch: int, buckets: list[int]) -> list[str]:
        """Paths that one epoch wrote for some buckets, published or not."""
        held = set(self._names(f"{part}/epoch={epoch}", "bucket="))
        return [f"{self.path}/{part}/epoch={epoch}/bucket={b}" for b in buckets if str(b) in held]

    def all_parts(self, part: str, before: int | None = None, buckets: list[int] | None = None) -> list[str]:
        """Paths of every published epoch of an append-only bucketed part."""
        wanted = None if buckets is None else {str(b) for b in buckets}
        return [f"{self.path}/{part}/epoch={e}/bucket={b}" for e in self.epochs(before)
                for b in self._names(f"{part}/epoch={e}", "bucket=") if wanted is None or b in wanted]

    def expire(self, part: str, keep: int = 2) -> None:
        """Deletes versions that ``keep`` newer published ones replace: of the
        whole part, or of a bucket. The state any epoch from the newest on
        starts from stays readable, so that the newest can still be replayed."""
        seen: dict[str, int] = {}
        for e in reversed(self.epochs()):
            folder = f"{part}/epoch={e}"
            names = [f"bucket={b}" for b in self._names(folder, "bucket=")] or ([""] if self._fs.exists(self._path(folder)) else [])
            for name in names:
                seen[name] = seen.get(name, 0) + 1
                if seen[name] > keep:
                    self._fs.delete(self._path(f"{folder}/{name}".rstrip("/")), True)
