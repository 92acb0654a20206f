"""Results kept on shared storage, written once and read afterwards."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from carebundle.bundle import Bundle
from carebundle.sources import storage


class SupplyCache:
    """Keeps tables below a root folder.  A table counts as present once its success marker is there, so a write
    that was cut off is repeated.  The table returned is always the one read back: it is never computed twice,
    and losing an executor later does not bring the computation back."""

    def __init__(self, spark: SparkSession, root: str | None = None, data_format: str = "parquet") -> None:
        self.spark = spark
        self.root = (root or f"{storage.shared_folder(spark).rstrip('/')}/supply-cache").rstrip("/")
        self.data_format = data_format

    def _present(self, path: str) -> bool:
        return storage.exists(self.spark, f"{path}/_SUCCESS")

    def _write(self, frame: DataFrame, path: str) -> None:
        """Write aside, then rename: of two sessions that miss at once, the later one drops its own copy."""
        aside = f"{path}-{uuid4().hex}"
        frame.write.format(self.data_format).mode("errorifexists").save(aside)
        if not self._present(aside):
            storage.write_text(self.spark, f"{aside}/_SUCCESS", "")
        try:
            storage.rename(self.spark, aside, path)
        except FileExistsError:
            if self._present(path):
                storage.delete_folder(self.spark, aside)
                return
            storage.delete_folder(self.spark, path)  # left by a write that was cut off
            storage.rename(self.spark, aside, path)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.format(self.data_format).load(path)

    def table(self, name: str, supply: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if not self._present(path):
            self._write(supply(), path)
        return self._read(path)

    def bundle(self, name: str, tables: Iterable[str], supply: Callable[[], Bundle]) -> Bundle:
        """The tables of a bundle, one sub-folder each; only absent ones are written."""
        paths = {table: f"{self.root}/{name}/{table}" for table in tables}
        absent = [table for table, path in paths.items() if not self._present(path)]
        if absent:
            supplied = supply().require(paths)
            storage.for_each(self.spark, lambda table: self._write(supplied[table], paths[table]), absent)
        return Bundle({table: self._read(path) for table, path in paths.items()})
