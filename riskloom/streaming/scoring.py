"""Continuous scoring of requests into the prediction log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.months import BILL, PAY
from riskloom.operators.joins import join_hot_split
from riskloom.operators.log import (
    CLUSTERING,
    LOG_INPUTS,
    by_day,
    day_of,
    declared,
    log_schema,
)
from riskloom.operators.scoring import RECORD_FIELDS, Scorer, fixture_scorer, rejection_reasons, score_requests
from riskloom.sources.requests import event_requests
from riskloom.sources.tables import SCHEMAS
from riskloom.streaming.arrivals import FIRST, REPEATS_WITHIN, first_arrivals
from riskloom.streaming.sink import ONCE, write_batch

MONEY_FIELDS = ("limit_bal", *BILL, *PAY)
KEPT = ("event_id", "predicted_at", *LOG_INPUTS)
#: Columns of an event that make a request; two events with one id differ if these do.
EVENT_FIELDS = ("event_id", "ts", "user_id", "value")
SCORED, REJECTED, UNKNOWN = "scored", "rejected", "unknown_client"


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Events as they arrive; times as instants.

    ``path`` is a folder, or a pattern of files and folders.
    """
    stream = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def answers(
    asked: DataFrame,
    threshold: float,
    model_version: str,
    scorer: Scorer = fixture_scorer,
    keep: Sequence[str] = KEPT,
    features: Sequence[str] = (),
) -> DataFrame:
    """One row per request of ``asked`` (see ``ask``): the result, or why there is none.

    ``status`` is scored, rejected (``reasons`` names the fields out of bounds) or
    unknown_client.
    """
    scored = score_requests(asked.filter("known"), threshold, model_version, scorer, keep, features=features)
    scored = scored.withColumns({"status": F.lit(SCORED), "reasons": F.array().cast("array<string>")})
    return scored.unionByName(refused(asked).select(*_common(keep), "status", "reasons"), allowMissingColumns=True)


def _common(keep: Sequence[str]) -> list[str]:
    return list(dict.fromkeys((*keep, "client_id")))


def refused(asked: DataFrame) -> DataFrame:
    """Requests without a result, whole, with ``status`` and ``reasons``."""
    known = F.col("known")
    checked = asked.withColumns(
        {
            "reasons": F.when(known, rejection_reasons()).otherwise(F.array(F.lit("client_id"))),
            "status": F.when(known, F.lit(REJECTED)).otherwise(F.lit(UNKNOWN)),
        }
    )
    return checked.filter("size(reasons) > 0").drop("known")


def ask(headers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every request with the record of its account, and ``known``: whether there is one.

    Requests that name no client are not joined; they would all meet in one task.
    """
    record = accounts.select(*RECORD_FIELDS).withColumn("known", F.lit(True))
    named = join_hot_split(headers.filter("client_id IS NOT NULL"), record, "client_id", "left")
    asked = named.unionByName(headers.filter("client_id IS NULL"), allowMissingColumns=True)
    return asked.withColumn("known", F.coalesce("known", F.lit(False)))


def score_stream(
    events: DataFrame,
    accounts: DataFrame,
    out: str,
    checkpoint: str,
    threshold: float,
    model_version: str,
    scorer: Scorer = fixture_scorer,
    keep: Sequence[str] = KEPT,
    trigger: dict = ONCE,
    features: Sequence[str] = (),
    quarantine: str | None = None,
    repeats_within: timedelta = REPEATS_WITHIN,
) -> StreamingQuery:
    """Answer every event id once, under ``out/batch=<id>``; see ``answers``.

    Repeats are told by the ids of earlier batches, stored beside the checkpoint (``first_arrivals``). Under ``quarantine`` (``<out>-quarantine``)
    goes, whole and with its reasons, what has no result: refused requests, repeats of an id with
    other content, and events without an id; only the refused ones have an answer as well. An event
    is one message of one request, so the rules for batches of requests hold by themselves.

    ``accounts`` is a stored table with one row per client. Joining inside the batch
    lets the hot-key split and AQE work on each batch. Every batch owns a folder, so a
    retry neither doubles nor loses rows. ``features`` are kept with the results, so that
    the log and its drift can watch them.
    """
    quarantine = quarantine or f"{out}-quarantine"

    def write(batch: DataFrame, batch_id: int) -> None:
        # Sorted out once, and looked at several times.
        arrived = first_arrivals(batch, batch_id, f"{checkpoint}/first", EVENT_FIELDS, within=repeats_within).persist()
        first = arrived.filter(F.col("arrival") == FIRST)
        asked = ask(event_requests(first), accounts).persist()
        results = answers(asked, threshold, model_version, scorer, keep, features)
        typed = {f: F.col(f).cast("double") for f in features if f not in keep}
        day = results.withColumns({**typed, "day": day_of("predicted_at")})
        write_batch(day, f"{out}/batch={batch_id}", ["day"])
        odd = event_requests(arrived.filter(F.col("arrival") != FIRST), "arrival").withColumnRenamed("arrival", "status")
        odd = odd.withColumn("reasons", F.array(F.lit("event_id")))
        held = refused(asked).unionByName(odd, allowMissingColumns=True)
        write_batch(held, f"{quarantine}/batch={batch_id}")
        asked.unpersist()
        arrived.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def quarantine_schema() -> str:
    """Column declaration of quarantined rows: the request, its account's record, and why."""
    records = ", ".join(f"{n} {'double' if n in MONEY_FIELDS else 'bigint' if n == 'client_id' else 'int'}" for n in RECORD_FIELDS)
    return f"event_id bigint, batch_id string, predicted_at timestamp, shift double, {records}, reasons array<string>, status string, batch bigint"


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Everything that has no result so far."""
    return spark.read.schema(quarantine_schema()).option("basePath", path).parquet(path)


def results_schema(keep: Sequence[str] = KEPT, features: Sequence[str] = ()) -> str:
    """Column declaration of the scored results."""
    types = {**log_schema(features), "event_id": "bigint"}
    result = ("client_id", "default_probability", "decision", "threshold", "risk_band")
    names = dict.fromkeys((*keep, *features, *result, "model_version"))
    columns = ", ".join(f"{n} {types[n]}" for n in names)
    return f"{columns}, status string, reasons array<string>, day string, batch bigint"


def read_results(spark: SparkSession, out: str, features: Sequence[str] = ()) -> DataFrame:
    """Every answer so far, one per event id."""
    schema = results_schema(features=features)
    return spark.read.schema(schema).option("basePath", out).parquet(out)


def log_stream(
    spark: SparkSession,
    scored: str,
    log: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
    trigger: dict = ONCE,
    features: Sequence[str] = (),
) -> StreamingQuery:
    """Copy scored results into the prediction log, partitioned by day; refusals are left out.

    A query of its own: when the log cannot be written, it stops and later resumes where
    it was, while scoring goes on. Stateless: results hold each event once.
    """
    stream = (
        spark.readStream.schema(results_schema(features=features))
        .option("basePath", scored)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(scored)
        .filter(F.col("status") == SCORED)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = by_day(declared(batch, log_schema(features)), "predicted_at", CLUSTERING)
        write_batch(rows, f"{log}/load={batch_id}", ["day"])

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_loads(spark: SparkSession, log: str, features: Sequence[str] = ()) -> DataFrame:
    """The log written by ``log_stream``."""
    ddl = ", ".join(f"{c} {t}" for c, t in log_schema(features).items())
    schema = f"{ddl}, load bigint, day string"
    return spark.read.schema(schema).option("basePath", log).parquet(log)
