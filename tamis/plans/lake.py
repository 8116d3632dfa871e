"""The lake layout: ``<root>/<stage>/<topic>/attempt=<id>/outcome=<outcome>/*.parquet``.

One stage table holds the accepted rows and the error envelopes side by side,
split by the ``outcome`` partition, so both are written by one pass over the
input: no caching, no second parse, and no bronze without its envelopes after a
crash.  Accepted rows and errors are then partition filters.

Every write goes to a folder of its own and is published afterwards by one small
commit record that names its runs.  Readers take, for each run, the committed
attempt of the newest version; a failed or unfinished write changes nothing, and
repeating a run replaces its rows only once the new ones are complete.  ``compact``
puts many small attempts into one, ``vacuum`` deletes what no record needs.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tamis.contracts import Contract
from tamis.functions.json import EXTRA_COLUMNS, MISSING_COLUMNS, OK, TYPE_CAST_ERROR
from tamis.sources import store

BRONZE, SILVER = "bronze", "silver"
OUTCOMES = {BRONZE: (OK, EXTRA_COLUMNS, MISSING_COLUMNS), SILVER: (OK, TYPE_CAST_ERROR)}
#: Attempts that are named one by one, and runs whose names may be broadcast to their rows.
FEW, BROADCAST_RUNS = 1_000, 2_000_000
#: Outcomes whose rows hold the contract columns.
ACCEPTED = {BRONZE: (OK, EXTRA_COLUMNS), SILVER: (OK,)}

_RUN = re.compile(r"[A-Za-z0-9._-]+")
_RECORD = "attempt string, written long, runs map<string, long>, made map<string, long>"


@dataclass(frozen=True)
class Live:
    """The committed state of a run: its version, when its rows were made, and the attempt that
    holds it, with how many runs."""

    version: int
    made: int
    attempt: str
    runs: int


def _now() -> int:
    return time.time_ns()


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, stage: str, topic: str, attempt: str | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{stage}/{topic}"
        return base if attempt is None else f"{base}/attempt={attempt}"

    @staticmethod
    def now() -> int:
        return _now()

    def checkpoint(self, query: str, topic: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{query}/{topic}"

    # --- writing --------------------------------------------------------------

    def write(self, table: DataFrame, stage: str, contract: Contract, run: str) -> dict[str, int]:
        """Replace one run of a stage table; returns the rows per outcome."""
        return self.write_runs(table.withColumn("run", F.lit(run)), stage, contract, {run: None})

    def write_runs(
        self,
        table: DataFrame,
        stage: str,
        contract: Contract,
        runs: Mapping[str, int | None],
        *,
        written: int | None = None,
        made: Mapping[str, int] | None = None,
    ) -> dict[str, int]:
        """Replace the given runs; ``table`` has a ``run`` column.

        ``runs`` says which version of each run the rows stand for; None is a new one.
        ``made`` says since when these rows have been the run's, if that is not now.
        """
        for run in runs:
            if not _RUN.fullmatch(run):
                raise ValueError(f"run id {run!r} may hold letters, digits, '.', '_' and '-' only")
        attempt = uuid.uuid4().hex
        # The counts are observed while writing, they cost no extra job.
        observed = Observation()
        counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES[stage]]
        (
            table.observe(observed, *counts)
            .write.partitionBy("outcome")
            .parquet(self.path(stage, contract.topic, attempt))
        )
        done = _now()
        record = {
            "attempt": attempt,
            "written": done if written is None else written,
            "runs": {run: done if version is None else version for run, version in runs.items()},
            "made": dict(made or dict.fromkeys(runs, done)),
        }
        commits = f"{self.path(stage, contract.topic)}/_commits"
        store.put(table.sparkSession, f"{commits}/{attempt}.json", json.dumps(record))
        return observed.get

    def compact(self, spark: SparkSession, stage: str, contract: Contract) -> int:
        """Rewrite a stage table of several attempts as one; returns how many there were.

        Rows are rebalanced by outcome, which merges small files and splits large ones.
        What is written meanwhile stays the newer version.
        """
        started = _now()
        live = self.live(spark, stage, contract)
        attempts = len({state.attempt for state in live.values()})
        if attempts > 1:
            versions = {run: state.version for run, state in live.items()}
            rows = self.table(spark, stage, contract).hint("rebalance", "outcome")
            made = {run: state.made for run, state in live.items()}
            self.write_runs(rows, stage, contract, versions, written=started, made=made)
        return attempts

    def vacuum(
        self, spark: SparkSession, stage: str, contract: Contract, *, hours: float = 24
    ) -> int:
        """Delete attempts and records that are not live and unchanged for ``hours``.

        The time must exceed that of any write or query which is under way.
        """
        base = self.path(stage, contract.topic)
        live = {state.attempt for state in self.live(spark, stage, contract).values()}
        records = {f"_commits/{n}": age for n, age in store.names(spark, f"{base}/_commits").items()}
        gone = 0
        # records first: a record without its rows would break readers
        for name, age in [*records.items(), *store.names(spark, base).items()]:
            owner = name.removeprefix("_commits/").removesuffix(".json").removeprefix("attempt=")
            if "/" not in name and not name.startswith("attempt="):
                continue
            if owner not in live and age >= hours * 3600:
                store.remove(spark, f"{base}/{name}")
                gone += 1
        return gone

    # --- reading --------------------------------------------------------------

    def runs(
        self,
        spark: SparkSession,
        stage: str,
        contract: Contract,
        run: str | Collection[str] | None = None,
    ) -> DataFrame | None:
        """``run, version, written, made, attempt, of``: the newest committed version of each run,
        when its rows were made, and how many runs its attempt was committed with; None where
        nothing was written yet."""
        path = f"{self.path(stage, contract.topic)}/_commits"
        try:
            records = spark.read.schema(_RECORD).json(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        each = records.select(
            "attempt", "written", "made", F.size("runs").alias("of"), F.explode("runs").alias("run", "version")
        ).withColumn("made", F.col("made")[F.col("run")])
        if run is not None:
            each = each.where(F.col("run").isin([run] if isinstance(run, str) else list(run)))
        state = F.max(F.struct("version", "written", "made", "attempt", "of")).alias("state")
        return each.groupBy("run").agg(state).select("run", "state.*")

    def live(self, spark: SparkSession, stage: str, contract: Contract) -> dict[str, Live]:
        """The newest committed version of each run, for maintenance."""
        runs = self.runs(spark, stage, contract)
        found = [] if runs is None else runs.collect()
        return {r.run: Live(r.version, r.made, r.attempt, r.of) for r in found}

    def table(
        self,
        spark: SparkSession,
        stage: str,
        contract: Contract,
        run: str | Collection[str] | None = None,
    ) -> DataFrame | None:
        """A stage table of a topic, or None where nothing was written yet.

        ``run`` is one run or several, as a rule all.  The attempts' folders are a partition
        filter; of more than ``FEW`` attempts their names are joined, which prunes folders when it
        runs.  Where an attempt holds runs that are not wanted, the rows' own run is joined, too.
        """
        runs = self.runs(spark, stage, contract, run)
        if runs is None:
            return None
        held = runs.groupBy("attempt").agg(F.count("*").alias("live"), F.first("of").alias("of"))
        found = held.limit(FEW + 1).collect()
        if not found:
            return None
        fields = contract.bronze if stage == BRONZE else contract.silver
        columns = ("envelope", "run", "attempt", "outcome")
        schema = StructType([*fields.fields, *(StructField(c, StringType()) for c in columns)])
        rows = spark.read.schema(schema).parquet(self.path(stage, contract.topic))
        if len(found) <= FEW:
            rows = rows.where(F.col("attempt").isin([r.attempt for r in found]))
            if all(r.live == r.of for r in found):
                return rows.drop("attempt")
        # folders are pruned by a join only if its other side is filtered
        wanted = runs.select("attempt", "run").where(F.length("attempt") > 0)
        if runs.count() <= BROADCAST_RUNS:
            wanted = F.broadcast(wanted)
        names = [name for name in rows.columns if name != "attempt"]
        return rows.join(wanted, ["attempt", "run"], "left_semi").select(*names)

    def rows(
        self,
        spark: SparkSession,
        stage: str,
        contract: Contract,
        run: str | Collection[str] | None = None,
        keep: tuple[str, ...] = (),
    ) -> DataFrame | None:
        """Accepted rows, contract columns only.  Reject partitions are not read."""
        table = self.table(spark, stage, contract, run)
        if table is None:
            return None
        accepted = table.where(F.col("outcome").isin(*ACCEPTED[stage]))
        return accepted.select(*keep, *contract.names)

    def errors(
        self,
        spark: SparkSession,
        stage: str,
        contract: Contract,
        run: str | Collection[str] | None = None,
    ) -> DataFrame | None:
        """Error envelopes as ``key, value``.  Partitions of clean rows are not read."""
        table = self.table(spark, stage, contract, run)
        if table is None:
            return None
        return table.where(F.col("outcome") != OK).select(
            F.lit(None).cast("string").alias("key"), F.col("envelope").alias("value")
        )
