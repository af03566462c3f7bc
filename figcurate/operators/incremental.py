"""Work-item ledger: process only what is new or changed, exactly once, across failures.

A work item is a key with the version that has to be handled.  Its state follows from the events written about it:

* ``pending``  no run has handled this version, or every run that tried failed, rolled back or let its lease expire;
* ``leased``   a live run holds it under a fencing token until the lease ends;
* ``done``     a successful run has handled this version.

``work_items`` folds a history of runs into these states as one aggregation and one join, whatever the number of runs.
``WorkLedger`` is the writing side: an append-only event log in a folder that all executors share.  Every claim writes to a
path made from (batch, token), so that a repeated task overwrites its own output and never adds rows; a claim gets a token
greater than any before it, and a completion whose token is not the item's latest is ignored when states are folded.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate.functions import ids
from figcurate.sources.files import Files

PENDING, LEASED, DONE = "pending", "leased", "done"


def current_figures(records: DataFrame) -> DataFrame:
    """One row per figure with its current version: the greatest version of any of its rows.

    Rows without an article or figure id name no figure and are left out.  A figure none of whose rows has a version has
    the version null; no run of ``run_ledger`` can have handled it, and a ``WorkLedger`` handles it once.
    """
    return (
        records.select(
            ids.canonical_pmcid(F.col("pmcid")).alias("pmcid"),
            ids.blank_to_null(F.col("figure_id")).alias("figure_id"),
            ids.current_version(F.col("resolved_article_version"), F.col("article_version")).alias("version"),
        )
        .where(F.col("pmcid").isNotNull() & F.col("figure_id").isNotNull())
        .groupBy("pmcid", "figure_id")
        .agg(F.max("version").alias("version"))
    )


def handled_versions(ledger: DataFrame, runs: DataFrame, lease_hours: float = 24.0, now: Column | None = None) -> DataFrame:
    """Per (figure, version): whether a successful run handled it, and whether a live lease is held on it.

    ``now`` defaults to the latest time in ``runs``; a running run holds its items for ``lease_hours`` from its start.
    """
    if now is None:
        now = runs.agg(F.max(F.greatest("run_started_at", F.coalesce("run_ended_at", "run_started_at")))).scalar()
    held = (F.col("run_status") == "running") & (
        F.col("run_started_at") + F.expr(f"make_dt_interval(0, {int(lease_hours)})") >= now
    )
    state = runs.select("run_id", (F.col("run_status") == "succeeded").alias("succeeded"), held.alias("held"))
    return (
        ledger.select(
            "run_id",
            ids.canonical_pmcid(F.col("pmcid")).alias("pmcid"),
            ids.blank_to_null(F.col("figure_id")).alias("figure_id"),
            ids.version_of(F.col("processed_version")).alias("version"),
        )
        .join(state, "run_id")
        .groupBy("pmcid", "figure_id", "version")
        .agg(
            F.bool_or("succeeded").alias("succeeded"),
            F.bool_or("held").alias("held"),
            F.max("run_id").alias("token"),
        )
    )


def work_items(records: DataFrame, ledger: DataFrame, runs: DataFrame, lease_hours: float = 24.0) -> DataFrame:
    """Every figure with its current version, state and fencing token (the greatest run that touched it; null if none)."""
    history = handled_versions(ledger, runs, lease_hours)
    state = (
        F.when(F.col("succeeded"), F.lit(DONE)).when(F.col("held"), F.lit(LEASED)).otherwise(F.lit(PENDING))
    )
    return current_figures(records).join(history, ["pmcid", "figure_id", "version"], "left").select(
        "pmcid", "figure_id", "version", state.alias("state"), "token"
    )


def unhandled(records: DataFrame, ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """The figures that no successful run has handled in their current version: those not in the state done."""
    return work_items(records, ledger, runs).where(F.col("state") != DONE).select("pmcid", "figure_id")


class StaleToken(RuntimeError):
    """A writer came back with a token that a later claim has fenced off."""


class WorkLedger:
    """Append-only ledger of claims and completions under ``folder``.

    ==================  =======================================================================
    tokens/N.json       claim N: its holder, the end of its lease, how far it read the records
    failed/N            claim N gave its items back
    claims/token=N      the items of claim N
    done/token=N        the items completed under claim N
    state/upto=N        claims 1 to N folded: each item once with its last token and whether done
    ==================  =======================================================================

    Token files are created exclusively, so two writers never get the same token.  Every data path is made of a token, so a task
    or call that runs again replaces its own output.  ``compact`` folds settled claims into one table; from then on only younger
    ones are read, so the work of a run does not grow with the number of runs before it.  Keys and versions may be null: a figure
    without a version is an item like any other and is handled once.
    """

    def __init__(self, spark: SparkSession, folder: str, key: list[str]):
        self.spark, self.key, self.files = spark, key, Files(spark, folder)

    # what is on record
    @property
    def _on(self) -> list[str]:
        return [*self.key, "version"]

    def _folded(self) -> int:
        """The last token that ``state`` holds."""
        known = (n for n in self.files.names("state") if self.files.exists(f"state/{n}/_SUCCESS"))
        return max((int(n.partition("=")[2]) for n in known), default=0)

    def _tokens(self, after: int) -> list[dict]:
        """The claims younger than ``after``; their number is that of runs since the last ``compact``."""
        names = [n for n in self.files.names("tokens") if int(n[:-5]) > after]
        failed = set(self.files.names("failed"))
        found = [json.loads(self.files.read(f"tokens/{n}")) for n in names]
        return sorted(({**t, "failed": str(t["token"]) in failed} for t in found), key=lambda t: t["token"])

    def _schema(self, items: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name in self._on)

    def _written(self, part: str, token: int) -> bool:
        """Whether the part was written in whole; a run that died while writing counts for nothing."""
        return self.files.exists(f"{part}/token={token}/_SUCCESS")

    def _read(self, part: str, tokens: list[int], schema: str) -> DataFrame:
        whole = schema + ", token bigint"
        paths = [self._path(part, t) for t in tokens if self._written(part, t)]
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", self.files.path(part)).parquet(*paths)

    def _path(self, part: str, token: int) -> str:
        return self.files.path(f"{part}/token={token}")

    def _history(self, schema: str, tokens: list[int], folded: int) -> DataFrame:
        """(key, version, token, done): every item ever claimed with its last token, and whether it was done under that token."""
        events = self._read("claims", tokens, schema).withColumn("done", F.lit(False))
        events = events.unionByName(self._read("done", tokens, schema).withColumn("done", F.lit(True)))
        if folded:
            events = events.unionByName(self.spark.read.schema(schema + ", token bigint, done boolean").parquet(self.files.path(f"state/upto={folded}")))
        last = F.max(F.struct("token", "done"))  # of one token, done outranks claimed
        return events.groupBy(*self._on).agg(last.alias("last")).select(*self._on, "last.token", "last.done")

    def _states(self, schema: str, now: float) -> DataFrame:
        """(key, version, token, state) of every item ever claimed."""
        folded = self._folded()
        tokens = self._tokens(folded)
        live = [t["token"] for t in tokens if t["lease_until"] > now and not t["failed"]]
        is_live = F.col("token").isin(live) if live else F.lit(False)
        state = F.when(F.col("done"), F.lit(DONE)).when(is_live, F.lit(LEASED)).otherwise(F.lit(PENDING))
        return self._history(schema, [t["token"] for t in tokens], folded).select(*self._on, "token", state.alias("state"))

    def states(self, items: DataFrame, now: float | None = None) -> DataFrame:
        """``items`` (key columns and ``version``, null or not) with ``state`` and the latest ``token``."""
        known = self._states(self._schema(items), time.time() if now is None else now)
        renamed = known.select(*(F.col(c).alias(f"_{c}") for c in self._on), "token", "state")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self._on]
        joined = items.drop("token", "state").join(renamed, same, "left").drop(*(f"_{c}" for c in self._on))
        return joined.withColumn("state", F.coalesce("state", F.lit(PENDING)))

    # claiming
    def _new_token(self, about: dict, now: float) -> int:
        names = self.files.names("tokens")
        token = max((int(n[:-5]) for n in names), default=self._folded()) + 1
        about = {**about, "at": dt.datetime.fromtimestamp(now, dt.UTC).isoformat()}
        while not self.files.create(self._token_file(token), json.dumps({"token": token, **about})):
            token += 1
        return token

    def _take(self, token: int, pending: DataFrame, schema: str) -> DataFrame:
        pending.select(*self._on).write.mode("overwrite").parquet(self._path("claims", token))
        return self.spark.read.schema(schema).parquet(self._path("claims", token))

    def claim(self, items: DataFrame, holder: str, lease_seconds: float, now: float | None = None) -> tuple[int, DataFrame]:
        """Lease every pending item of ``items`` to ``holder``; returns the fencing token and the leased items."""
        now = time.time() if now is None else now
        token = self._new_token({"holder": holder, "lease_until": now + lease_seconds}, now)
        pending = self.states(items, now).where(F.col("state") == PENDING)
        return token, self._take(token, pending, self._schema(items))

    def claim_landed(
        self, records: DataFrame, to_items: Callable[[DataFrame], DataFrame], holder: str, lease_seconds: float, now: float | None = None,
        landed: str = "landed_at", late_seconds: float = 0.0,
    ) -> tuple[int, DataFrame]:
        """Lease what ``records`` bring since the last claim, and what earlier runs left behind.

        Only records that landed after the greatest time any claim has read (less ``late_seconds``) are read, a filter that
        reaches the scan; records without a time are read each time.  ``to_items`` makes them items; of each key only the
        greatest version, on record or new, may be leased.  Records read twice change nothing, as the ledger knows their items.
        """
        now = time.time() if now is None else now
        tokens = self._tokens(self._folded())
        read = [t["read_until"] for t in tokens if t.get("read_until") is not None and self._written("claims", t["token"])]
        mark = self.files.names("read")
        read += [int(self.files.read(f"read/{n}")) for n in mark[-1:]]
        kind = records.schema[landed].dataType.simpleString()

        def at(micros: int) -> Column:
            return F.timestamp_micros(F.lit(micros)).cast(kind)

        until = records.agg(F.max(landed).cast("timestamp").alias("until")).select(F.unix_micros("until")).first()[0]
        fresh = records
        if read:
            fresh = records.where((F.col(landed) > at(max(read) - int(late_seconds * 1e6))) | F.col(landed).isNull())
        if until is not None:  # what lands while this runs is left to the next claim
            fresh = fresh.where((F.col(landed) <= at(until)) | F.col(landed).isNull())
        items = to_items(fresh).select(*self._on)
        schema = self._schema(items)
        about = {"holder": holder, "lease_until": now + lease_seconds, "read_until": max([*read, *([until] if until is not None else [])], default=None)}
        token = self._new_token(about, now)
        rank = F.when(F.col("state") == DONE, 2).when(F.col("state") == LEASED, 1).otherwise(0)
        known = self._states(schema, now).select(*self._on, rank.alias("rank"))
        both = known.unionByName(items.withColumn("rank", F.lit(0)))
        top = both.groupBy(*self.key).agg(F.max(F.struct("version", "rank")).alias("top"))
        pending = top.where("top.rank = 0").select(*self.key, "top.version")
        return token, self._take(token, pending, schema)

    def fail(self, token: int) -> None:
        """Give the items of ``token`` back at once, without waiting for its lease to end."""
        self.files.create(f"failed/{token}", "")

    @staticmethod
    def _token_file(token: int) -> str:
        return f"tokens/{token:012d}.json"

    # finishing
    def complete(self, token: int, handled: DataFrame, now: float | None = None) -> None:
        """Record ``handled`` as done under ``token``; a repeated call writes the same path again.

        Raises ``StaleToken`` if a later claim holds any of the items or may be about to, or the claim was given back or folded.
        """
        folded = self._folded()
        tokens = self._tokens(folded)
        own = next((t for t in tokens if t["token"] == token), None)
        if own is None or own["failed"]:
            raise StaleToken(f"token {token} was given back or folded away")
        later = [t["token"] for t in tokens if t["token"] > token and not t["failed"]]
        ended = own["lease_until"] <= (time.time() if now is None else now)
        if ended and not all(self._written("claims", t) for t in later):
            raise StaleToken(f"the lease of token {token} has ended and a later claim is under way")
        claims = self._read("claims", later, self._schema(handled))
        same = [handled[c].eqNullSafe(claims[c]) for c in self._on]
        if later and not handled.join(claims, same, "left_semi").isEmpty():
            raise StaleToken(f"token {token} is fenced off by a later claim")
        handled.select(*self._on).write.mode("overwrite").parquet(self._path("done", token))

    def compact(self, items: DataFrame, now: float | None = None) -> int:
        """Fold the oldest claims that can no longer change (failed, or their lease has ended) into one table.

        Returns the last token folded.  ``items`` gives the types of the key and version.  Their writers are fenced off:
        ``complete`` refuses a folded token.
        """
        now = time.time() if now is None else now
        folded = self._folded()
        tokens, last = self._tokens(folded), folded
        for t in tokens:
            if not (t["failed"] or t["lease_until"] <= now):
                break
            last = t["token"]
        if last == folded:
            return folded
        old = [t for t in tokens if t["token"] <= last]
        history = self._history(self._schema(items), [t["token"] for t in old], folded)
        read = max((t["read_until"] for t in old if t.get("read_until") is not None and self._written("claims", t["token"])), default=None)
        if read is not None:
            self.files.create(f"read/{last:012d}", str(read))
        history.write.mode("overwrite").parquet(self.files.path(f"state/upto={last}"))
        return last

    def process(
        self, items: DataFrame, holder: str, handle: Callable[[DataFrame], DataFrame], output: str, lease_seconds: float = 3600.0,
        now: float | None = None,
    ) -> int | None:
        """Claim what is pending, write ``handle`` of it under a path made of the token, and record it as done.

        Returns the token, or None if nothing was pending.  A run that dies anywhere leaves output that ``results`` ignores and
        a lease that ends; one that is repeated under the same token replaces its own output.
        """
        token, taken = self.claim(items, holder, lease_seconds, now)
        return self._run(token, taken, handle, output, now)

    def process_landed(
        self, records: DataFrame, to_items: Callable[[DataFrame], DataFrame], holder: str, handle: Callable[[DataFrame], DataFrame], output: str,
        lease_seconds: float = 3600.0, now: float | None = None, late_seconds: float = 0.0,
    ) -> int | None:
        """``process`` for what ``claim_landed`` leases."""
        token, taken = self.claim_landed(records, to_items, holder, lease_seconds, now, late_seconds=late_seconds)
        return self._run(token, taken, handle, output, now)

    def _run(self, token: int, taken: DataFrame, handle: Callable[[DataFrame], DataFrame], output: str, now: float | None) -> int | None:
        if taken.isEmpty():
            self.fail(token)
            return None
        handle(taken).write.mode("overwrite").parquet(self.output_path(output, token))
        self.complete(token, taken, now)
        return token

    @staticmethod
    def output_path(output: str, token: int) -> str:
        return f"{output.rstrip('/')}/token={token}"

    def results(self, items: DataFrame, output: str) -> DataFrame:
        """The output rows that count: those of the token under which their item was last claimed and done.

        Output rows carry the key columns and ``version``.  What a fenced-off or failed run wrote is not among them.
        """
        folded = self._folded()
        schema = self._schema(items)
        history = self._history(schema, [t["token"] for t in self._tokens(folded)], folded).where("done").drop("done")
        written = Files(self.spark, output)
        paths = [f"{written.root}/{n}" for n in written.names("") if n.startswith("token=") and written.exists(f"{n}/_SUCCESS")]
        if not paths:
            return history.limit(0)
        rows = self.spark.read.option("basePath", output).option("mergeSchema", True).parquet(*paths).withColumn("token", F.col("token").cast("bigint"))
        return rows.join(history, [rows[c].eqNullSafe(history[c]) for c in (*self._on, "token")], "left_semi")
