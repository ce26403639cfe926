"""Stage tables as committed versions, so that a run that dies can be taken up again.

A stage is a folder of versions.  A version counts once its mark is there, which is put in
place by a rename after the last file is written; until then readers keep to the version
before, and a version without a mark is what a run that died has left.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docengine.sources.workspace import delete, folders, get_text, put_text

MARK = "_COMMITTED"


class StageFolder:
    """Stage tables below a folder that all executors reach.

    `run` names the data that the stages are made from.  With it, `once` takes a table that
    the same run has committed as it is, so that a run that died goes on at its first
    stage without a commit; without it every stage is written anew.
    """

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None):
        self.spark, self.folder, self.run = spark, folder.rstrip("/"), run

    def _versions(self, name: str) -> list[tuple[int, str, dict | None]]:
        """Number, folder and mark of each version, the latest first."""
        found = []
        for version in folders(self.spark, f"{self.folder}/{name}"):
            number = version.partition("-")[0]
            if number.isdigit():
                where = f"{self.folder}/{name}/{version}"
                mark = get_text(self.spark, f"{where}/{MARK}")
                found.append((int(number), where, None if mark is None else json.loads(mark)))
        return sorted(found, key=lambda v: v[:2], reverse=True)

    def committed(self, name: str, run: str | None = None) -> DataFrame | None:
        """The last committed version, or null; with `run`, only if that run made it."""
        for _, where, mark in self._versions(name):
            if mark is not None:
                if run is not None and mark["run"] != run:
                    return None
                schema = T.StructType.fromJson(mark["schema"])
                return self.spark.read.schema(schema).parquet(where)
        return None

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a version, commit it and go on from the written table.

        The committed version before stays, as someone may be reading it; what is older,
        or was never committed, goes.
        """
        before = self._versions(name)
        number = before[0][0] + 1 if before else 1
        where = f"{self.folder}/{name}/{number:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(where)
        mark = {"run": self.run, "schema": json.loads(df.schema.json())}
        put_text(self.spark, f"{where}/{MARK}", json.dumps(mark))
        kept = False
        for _, old, marked in before:
            if marked is not None and not kept:
                kept = True
            else:
                delete(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(where)

    def once(self, df: DataFrame, name: str) -> DataFrame:
        """The table that this run has committed, else the frame, written and committed."""
        done = self.committed(name, self.run) if self.run is not None else None
        return self.write(df, name) if done is None else done
