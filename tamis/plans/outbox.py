"""What an error topic has got of each run.

The published state of a run is its version and the multiset of envelopes that this version
holds.  When a newer version is published, each envelope is sent as many times as it occurs more
often than in the version published before: new rejects go out, repeated ones do not.

A publication first notes the envelopes' hashes and counts, below ``_sent``, then sends, then
commits one small record with the versions.  A crash in between sends again; readers that must
not count twice de-duplicate (see ``operators.identity``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.contracts import Contract
from tamis.functions.json import OK
from tamis.operators.identity import repeated
from tamis.plans.lake import Lake
from tamis.sources import store

_RECORD = "sent string, at long, runs map<string, long>"
_SENT = "run string, first long, second long, n long"
#: Two 64-bit hashes name an envelope.
_NAME = {"first": 1, "second": 2}


@dataclass(frozen=True)
class Outbox:
    lake: Lake
    stage: str
    contract: Contract

    def _path(self, name: str) -> str:
        return f"{self.lake.path(self.stage, self.contract.topic)}/{name}"

    def published(self, spark: SparkSession) -> DataFrame | None:
        """``run, version, sent``: the last published version of each run, and where its
        envelopes are noted; None where nothing was published yet."""
        try:
            records = spark.read.schema(_RECORD).json(self._path("_published"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        each = records.select("sent", "at", F.explode("runs").alias("run", "version"))
        last = F.max(F.struct("version", "at", "sent")).alias("last")
        return each.groupBy("run").agg(last).select("run", "last.version", "last.sent")

    def pending(self, spark: SparkSession, run: str | None = None) -> dict[str, tuple[int, str | None]]:
        """Runs with a version that was not published: the version, and where that of the version
        before is noted."""
        runs = self.lake.runs(spark, self.stage, self.contract, run)
        if runs is None:
            return {}
        # promoting a run again makes rows anew of the same version; compaction makes none
        states, done = runs.select("run", F.col("made").alias("version")), self.published(spark)
        if done is None:
            return {r.run: (r.version, None) for r in states.collect()}
        done = done.select("run", F.col("version").alias("done"), "sent")
        newer = states.join(done, "run", "left").where("done IS NULL OR done < version")
        return {r.run: (r.version, r.sent) for r in newer.collect()}

    def publish(
        self, spark: SparkSession, send: Callable[[DataFrame], None], *, run: str | None = None
    ) -> None:
        """Hand ``key, value`` messages of all pending runs, or one, to ``send``."""
        pending = self.pending(spark, run)
        if not pending:
            return
        own = uuid.uuid4().hex
        rows = self.lake.table(spark, self.stage, self.contract, pending.keys())
        rejects = rows.where(F.col("outcome") != OK).select("run", "envelope")
        # equal envelopes become one row before they are shuffled
        counted = rejects.groupBy("run", "envelope").agg(F.count("*").alias("n"))
        named = counted.withColumns({name: F.xxhash64(F.lit(seed), "envelope") for name, seed in _NAME.items()})
        sent = self._path(f"_sent/{own}")
        named.select("run", *_NAME, "n").write.parquet(sent)
        earlier = [(r, place) for r, (_, place) in pending.items() if place is not None]
        messages = rejects.select("envelope")
        if earlier:
            replaced = F.broadcast(spark.createDataFrame(earlier, "run string, place string"))
            paths = [self._path(f"_sent/{place}") for place in sorted({place for _, place in earlier})]
            place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("place")
            held = spark.read.schema(_SENT).parquet(*paths).select("*", place)
            held = held.join(replaced, ["run", "place"], "left_semi")
            before = held.select("run", *_NAME, F.col("n").alias("before"))
            again = named.join(replaced, "run", "left_semi").join(before, ["run", *_NAME], "left")
            more = again.withColumn("n", F.col("n") - F.coalesce("before", F.lit(0)))
            fresh = rejects.join(replaced, "run", "left_anti").select("envelope")
            messages = fresh.unionByName(repeated(more, "n").select("envelope"))
        send(messages.select(F.lit(None).cast("string").alias("key"), F.col("envelope").alias("value")))
        record = {"sent": own, "at": self.lake.now(), "runs": {r: version for r, (version, _) in pending.items()}}
        store.put(spark, self._path(f"_published/{own}.json"), json.dumps(record))
        for place in {place for _, place in earlier}:
            self._forget(spark, place)

    def _forget(self, spark: SparkSession, place: str) -> None:
        """Delete what a publication noted if every run in it was published again since."""
        done = self.published(spark)
        if done.where(F.col("sent") == place).isEmpty():
            store.remove(spark, self._path(f"_sent/{place}"))
