"""Every operator as a named query over the supplied tables.

Each takes (spark, sf_dir) and returns a DataFrame. Doubles are rounded to six places
and times shown as text, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from dataclasses import replace
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType, TimestampType

from riskloom.config import (
    SEX_LABELS,
    TRACKED_FEATURES,
    CostMatrix,
    ModelConfig,
    Monitoring,
    Settings,
    SplitRule,
)
from riskloom.functions.features import FAMILIES, all_features
from riskloom.operators import audits, boosting, clean, drift, evaluate, log, prep, scoring, validate
from riskloom.operators.calibration import calibration_table
from riskloom.operators.features import (
    feature_family,
    features,
    helpers,
    model_columns,
    split_frame,
    split_name,
)
from riskloom.plans import train as training
from riskloom.plans.drift_job import drift_check
from riskloom.plans.pipeline import run_pipeline
from riskloom.plans.registry import load_model, read_metadata, save_model
from riskloom.plans.report import report_tables, write_reports
from riskloom.session import materialise, new_path
from riskloom.sources import catalog, landing, newest
from riskloom.sources.panel import (
    FIXTURE_SCORE,
    INGESTED_AT,
    PANEL_URI,
    accounts,
    raw_panel,
)
from riskloom.sources.requests import attach_records, event_requests, shift_limits
from riskloom.sources.tables import read_table
from riskloom.streaming import drift as drift_streaming
from riskloom.streaming import scoring as score_streaming
from riskloom.operators.ranks import rank_plan
from riskloom.streaming.sink import finish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COST = CostMatrix()
VERSION = "fixture-1"
FIXED_THRESHOLD = 0.3
KEPT = ("event_id", "batch_id", "predicted_at", *log.LOG_INPUTS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Doubles to six places (but for ``exact`` columns), times as text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType) and f.name not in exact:
            out.append(f"round({f.name}, 6) AS {f.name}")
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            out.append(f"date_format({f.name}, 'yyyy-MM-dd HH:mm:ss') AS {f.name}")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


# ---- shared inputs -------------------------------------------------------------------
# Where a query needs the accounts more than once, they are stored first: in production
# these are the warehouse tables that every later step reads.


def latest_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_latest(raw_panel(spark, sf))


def stored_latest(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(latest_accounts(spark, sf))


def clean_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean(raw_panel(spark, sf))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return features(clean_accounts(spark, sf))


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table, in folders by split, so that a fit reads the training part alone."""
    return materialise(feature_table(spark, sf), ["split_name"])


def scored(latest: DataFrame, score: str = FIXTURE_SCORE) -> DataFrame:
    """Scored accounts: id, group, split, label and probability."""
    return clean.clean_rows(latest).selectExpr(
        "client_id",
        "sex",
        f"{split_name(SplitRule())} AS split_name",
        "default_next_month AS y",
        f"{score} AS p",
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(latest_accounts(spark, sf))


def valid_threshold(latest: DataFrame) -> float:
    """Cheapest threshold on the validation split."""
    return evaluate.fit_threshold(split_frame(scored(latest), "valid"), COST)


def requests(spark: SparkSession, sf: str, latest: DataFrame | None = None) -> DataFrame:
    """Events with the record of the account they ask about."""
    headers = event_requests(read_table(spark, sf, "events"))
    return attach_records(headers, stored_latest(spark, sf) if latest is None else latest)


def results(
    spark: SparkSession,
    sf: str,
    keep: Sequence[str] = KEPT,
    latest: DataFrame | None = None,
    features: Sequence[str] = (),
) -> DataFrame:
    """Scored requests with their inputs."""
    latest = stored_latest(spark, sf) if latest is None else latest
    asked = requests(spark, sf, latest)
    return scoring.score_requests(
        asked, valid_threshold(latest), VERSION, keep=keep, features=features
    )


def profile(latest: DataFrame, names: Sequence[str] = TRACKED_FEATURES):
    """Drift baseline of the training split."""
    baseline = split_frame(features(clean.clean_rows(latest)), "train").select(*names)
    return drift.fit_profile(materialise(baseline), names)


def profile_and_traffic(spark: SparkSession, sf: str, shifted: bool = False):
    """The baseline, and the features of the accepted requests; ``shifted`` moves their
    limits."""
    latest = stored_latest(spark, sf)
    asked = scoring.accepted(requests(spark, sf, latest))
    served = scoring.request_features(asked, keep=("event_id", "shift"))
    return profile(latest), shift_limits(served) if shifted else served


# ---- sources, sinks, tables ----------------------------------------------------------


@query
def panel(spark: SparkSession, sf: str) -> DataFrame:
    return shown(accounts(spark, sf))


@query
def land_raw(spark: SparkSession, sf: str) -> DataFrame:
    delivered = landing.as_delivered(accounts(spark, sf))
    return shown(landing.land(delivered, INGESTED_AT, PANEL_URI))


@query
def delivery_report(spark: SparkSession, sf: str) -> DataFrame:
    """Schema and row-count guards against one row per customer."""
    expected = read_table(spark, sf, "customer").count()
    delivered = landing.as_delivered(accounts(spark, sf))
    landing.check_columns(delivered)
    landing.check_row_count(delivered, expected)
    return landing.delivery_report(delivered, expected)


@query
def source_checksums(spark: SparkSession, sf: str) -> DataFrame:
    return landing.file_checksums(spark, sf)


@query
def write_read_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "raw")
    raw = raw_panel(spark, sf)
    landing.write_once(raw, path)
    landing.write_once(raw.filter("false"), path)  # already there: keeps the first output
    return shown(spark.read.schema(raw.schema).parquet(path))


@query
def dated_replay(spark: SparkSession, sf: str) -> DataFrame:
    path, raw = new_path(spark, "dated"), materialise(raw_panel(spark, sf))
    days = ("2026-01-01", "2026-01-02")
    for day in (*days, days[0]):  # the first day is delivered twice
        of_day = raw.filter(F.to_date("ingested_at") == F.to_date(F.lit(day)))
        landing.write_dated(of_day, path, day)
    loads = [
        landing.replay(spark, path, day, raw.schema).withColumn("dt", F.lit(day)) for day in days
    ]
    return loads[0].unionByName(loads[1]).groupBy("dt").agg(
        F.count("*").alias("n"), F.sum("limit_bal").alias("limits")
    )


@query
def table_operations(spark: SparkSession, sf: str) -> DataFrame:
    name = f"raw_accounts_{uuid.uuid4().hex}"
    raw = materialise(raw_panel(spark, sf))
    first, second = raw.filter("client_id % 10 <> 0"), raw.filter("client_id % 10 = 0")
    catalog.write_table(first, name, path=new_path(spark, "table"))
    swapped = second.select(*reversed(second.columns))  # appended by name
    catalog.write_table(swapped, name, mode="append")
    if not catalog.table_exists(spark, name):
        raise RuntimeError(f"table {name} is missing")
    return catalog.query(
        spark,
        "SELECT count(*) AS n, sum(limit_bal) AS limits, "
        "count_if(source_uri = :uri) AS from_panel FROM IDENTIFIER(:name)",
        name=name,
        uri=PANEL_URI,
    )


@query
def raw_load(spark: SparkSession, sf: str) -> DataFrame:
    name, path = f"raw_load_{uuid.uuid4().hex}", new_path(spark, "landed")
    raw = raw_panel(spark, sf)
    raw.write.parquet(path)
    target = new_path(spark, "table")
    for _ in range(2):  # a rerun must not double the rows
        catalog.load_raw(spark, path, name, raw.schema, target)
    return shown(spark.table(name))


@query
def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row per client after loading two days, the later one first, and a part again."""
    raw = materialise(raw_panel(spark, sf))
    kept = newest.new_table(spark, f"newest_{uuid.uuid4().hex}", raw.schema, slices=8, buckets=4)
    second = F.to_date("ingested_at") == F.to_date(F.lit("2026-01-02"))
    for part in (second, ~second, F.col("client_id") % 50 == 0):
        kept.load(raw.filter(part))
    return shown(kept.read())


# ---- cleaning and features -----------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return shown(latest_accounts(spark, sf))


@query
def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    return shown(clean_accounts(spark, sf))


@query
def clean_audit(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_audit(raw_panel(spark, sf))


@query
def month_helpers(spark: SparkSession, sf: str) -> DataFrame:
    return shown(helpers(clean_accounts(spark, sf)), exact=("avg_bill_amt_sq",))


@query
def features_all(spark: SparkSession, sf: str) -> DataFrame:
    return shown(feature_table(spark, sf))


def _family(name: str) -> Query:
    return lambda spark, sf: shown(feature_family(clean_accounts(spark, sf), name))


for _name in FAMILIES:
    QUERIES[f"features_{_name}"] = _family(_name)


@query
def split_balance(spark: SparkSession, sf: str) -> DataFrame:
    return shown(audits.split_balance(feature_table(spark, sf)))


@query
def split_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Clients, clients in two splits, and clients moved by a rebuild with new arrivals."""
    ids = materialise(clean_accounts(spark, sf).select("client_id"))
    rule = split_name(SplitRule())
    before = ids.selectExpr("client_id", f"{rule} AS split_name")
    last = ids.agg(F.max("client_id")).scalar()
    arrivals = ids.select((F.col("client_id") + last).alias("client_id"))
    after = ids.unionByName(arrivals).selectExpr("client_id", f"{rule} AS split_name")
    overlap = audits.split_overlap(after).agg(F.count("*")).scalar()
    moved = audits.split_moves(before, after).agg(F.count("*")).scalar()
    return after.agg(F.count("*").alias("clients")).select(
        "clients", overlap.alias("in_two_splits"), moved.alias("moved")
    )


@query
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each split frame, read back from a table partitioned by split."""
    path = new_path(spark, "features")
    feature_table(spark, sf).write.partitionBy("split_name").parquet(path)
    stored = spark.read.parquet(path)
    parts = [split_frame(stored, name) for name in ("train", "valid", "test")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy(F.col("split_name").cast("string").alias("split_name")).agg(
        F.count("*").alias("n"), F.sum("months_delinquent").cast("bigint").alias("months_delinquent")
    )


@query
def validate_features(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validation_report(stored_features(spark, sf))


# ---- documented figures --------------------------------------------------------------


@query
def dormancy_rate(spark: SparkSession, sf: str) -> DataFrame:
    return shown(audits.default_rate_by_history(feature_table(spark, sf)))


@query
def lgd_stats(spark: SparkSession, sf: str) -> DataFrame:
    return shown(audits.loss_given_default(clean_accounts(spark, sf)))


@query
def payment_flow(spark: SparkSession, sf: str) -> DataFrame:
    return shown(audits.payment_flow(clean_accounts(spark, sf)))


@query
def base_rate(spark: SparkSession, sf: str) -> DataFrame:
    return shown(audits.base_rate(feature_table(spark, sf)))


# ---- evaluation ----------------------------------------------------------------------

BY_SPLIT = ("split_name",)


def ranked(spark: SparkSession, sf: str, by: Sequence[str] = BY_SPLIT) -> DataFrame:
    return evaluate.ranked_scores(scores(spark, sf), by)


@query
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(scores(spark, sf), FIXED_THRESHOLD, BY_SPLIT)


@query
def cost_curve(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.cost_curve(ranked(spark, sf, ()), COST)


@query
def optimal_threshold(spark: SparkSession, sf: str) -> DataFrame:
    curve = evaluate.cost_curve(ranked(spark, sf), COST, BY_SPLIT)
    return evaluate.optimal_threshold(curve, BY_SPLIT)


@query
def baseline_costs(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.baseline_costs(scores(spark, sf), COST, BY_SPLIT)


@query
def ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return shown(evaluate.ranking_metrics(ranked(spark, sf), BY_SPLIT))


@query
def metrics_row(spark: SparkSession, sf: str) -> DataFrame:
    table = materialise(scores(spark, sf))
    threshold = evaluate.fit_threshold(split_frame(table, "valid"), COST)
    ranked_table = evaluate.ranked_scores(table, BY_SPLIT)
    return shown(evaluate.metrics(ranked_table, COST, threshold, BY_SPLIT))


@query
def cost_boundary(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts at or above the probability where acting pays."""
    at_least = F.col("p") >= COST.boundary
    return shown(
        scores(spark, sf).agg(
            F.max(F.lit(COST.boundary)).alias("boundary"),
            F.count_if(at_least).alias("flagged"),
            F.avg(F.when(at_least, F.col("y").cast("double"))).alias("flagged_default_rate"),
        )
    )


@query
def calibration(spark: SparkSession, sf: str) -> DataFrame:
    return shown(calibration_table(materialise(scores(spark, sf))))


@query
def fairness(spark: SparkSession, sf: str) -> DataFrame:
    report = evaluate.fairness(scores(spark, sf), FIXED_THRESHOLD, "sex", SEX_LABELS, BY_SPLIT)
    return shown(report)


@query
def cost_sweep(spark: SparkSession, sf: str) -> DataFrame:
    table = materialise(scores(spark, sf))
    fit, test = (evaluate.ranked_scores(split_frame(table, s)) for s in ("valid", "test"))
    return shown(evaluate.cost_sweep(fit, test, COST))


# The second flavour scores by the newest status alone.
STATUS_SCORE = "round(1.0D / (1.0D + exp(-(-2.0D + 0.55D * pay_status_1))), 4)"


@query
def model_compare(spark: SparkSession, sf: str) -> DataFrame:
    latest, test, thresholds = stored_latest(spark, sf), {}, {}
    for flavor, score in (("behaviour", FIXTURE_SCORE), ("status_only", STATUS_SCORE)):
        table = scored(latest, score)
        thresholds[flavor] = evaluate.fit_threshold(split_frame(table, "valid"), COST)
        test[flavor] = split_frame(table, "test")
    return shown(evaluate.compare_models(test, COST, thresholds))


@query
def report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics written as report files and read back."""
    path = new_path(spark, "report")
    table = evaluate.metrics(ranked(spark, sf), COST, FIXED_THRESHOLD, BY_SPLIT)
    write_reports({"models": table}, path)
    return shown(spark.read.schema(table.schema).json(f"{path}/metrics_json"))


# ---- scoring -------------------------------------------------------------------------


@query
def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.quarantined(requests(spark, sf)).select(
        "event_id", "client_id", F.array_join("reasons", ",").alias("reasons")
    )


@query
def duplicate_requests(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.duplicate_ids(event_requests(read_table(spark, sf, "events")))


@query
def batch_status(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.batch_status(event_requests(read_table(spark, sf, "events")))


@query
def accepted_batches(spark: SparkSession, sf: str) -> DataFrame:
    headers = event_requests(read_table(spark, sf, "events"))
    return scoring.keep_ok_batches(headers).select("event_id", "batch_id", "client_id")


@query
def request_features(spark: SparkSession, sf: str) -> DataFrame:
    served = scoring.request_features(
        scoring.accepted(requests(spark, sf)), keep=("event_id",)
    )
    return shown(served)


@query
def request_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Valid requests, results, and valid requests without a result."""
    asked = materialise(requests(spark, sf))
    answers = scoring.score_requests(asked, FIXED_THRESHOLD, VERSION, keep=("event_id",))
    lost = scoring.lost_requests(asked, answers, "event_id").agg(F.count("*")).scalar()
    valid = scoring.accepted(asked).agg(F.count("*")).scalar()
    return answers.agg(F.count("*").alias("scored")).select(
        valid.alias("valid"), "scored", lost.alias("lost")
    )


@query
def score_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return shown(results(spark, sf, ("event_id",)))


@query
def risk_bands(spark: SparkSession, sf: str) -> DataFrame:
    return shown(
        results(spark, sf)
        .groupBy("risk_band", "decision")
        .agg(F.count("*").alias("n"), F.avg("default_probability").alias("mean_probability"))
    )


@query
def score_counters(spark: SparkSession, sf: str) -> DataFrame:
    daily = results(spark, sf).withColumn("day", log.day_of("predicted_at"))
    return scoring.score_counters(daily, ("day", "model_version"))


@query
def prob_summary(spark: SparkSession, sf: str) -> DataFrame:
    answers = results(spark, sf, ()).select("default_probability")
    return shown(scoring.probability_summary(materialise(answers)))


@query
def skew_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Features served from account records against the stored feature table."""
    latest = stored_latest(spark, sf)
    stored = materialise(features(clean.clean_rows(latest)))
    served = scoring.request_features(scoring.accepted(latest))
    return shown(audits.skew_audit(served, stored, list(all_features())))


# ---- prediction log ------------------------------------------------------------------


@query
def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """Results appended to the day-partitioned log in two loads and read back."""
    path = new_path(spark, "log")
    answers = materialise(results(spark, sf))
    for flagged in (True, False):
        log.append_log(answers.filter((F.col("decision") == "flag") == flagged), path)
    return shown(log.read_log(spark, path))


@query
def flag_rate(spark: SparkSession, sf: str) -> DataFrame:
    return shown(log.flag_rate(results(spark, sf)))


@query
def latest_decision(spark: SparkSession, sf: str) -> DataFrame:
    return shown(
        log.latest_decision(results(spark, sf)).select(
            "client_id", "predicted_at", "model_version", "decision", "default_probability"
        )
    )


@query
def client_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every logged decision on the client with the most of them (then the smallest id)."""
    answers = materialise(results(spark, sf))
    counts = answers.groupBy("client_id").agg(F.count("*").alias("n"))
    busiest = counts.agg(F.max_by("client_id", F.struct("n", -F.col("client_id")))).first()[0]
    rows = log.decisions_of(answers, busiest)
    return shown(rows.select("event_id", "client_id", "predicted_at", "model_version", "decision", "default_probability"))


@query
def decision_history(spark: SparkSession, sf: str) -> DataFrame:
    return shown(log.version_history(results(spark, sf)))


# ---- drift ---------------------------------------------------------------------------


@query
def drift_table(spark: SparkSession, sf: str) -> DataFrame:
    return shown(drift.drift_table(*profile_and_traffic(spark, sf)))


@query
def drift_shifted(spark: SparkSession, sf: str) -> DataFrame:
    return shown(drift.drift_table(*profile_and_traffic(spark, sf, shifted=True)))


@query
def psi_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return shown(drift.psi_breakdown(*profile_and_traffic(spark, sf, shifted=True)))


@query
def drift_alerts(spark: SparkSession, sf: str) -> DataFrame:
    table = drift.drift_table(*profile_and_traffic(spark, sf, shifted=True))
    return shown(drift.drift_alerts(table))


@query
def drift_by_day(spark: SparkSession, sf: str) -> DataFrame:
    latest = stored_latest(spark, sf)
    logged = results(spark, sf, latest=latest, features=TRACKED_FEATURES)
    logged = logged.withColumn("day", log.day_of("predicted_at"))
    return shown(drift.drift_table(profile(latest), logged, ("day",)))


@query
def drift_job(spark: SparkSession, sf: str) -> DataFrame:
    """The scheduled check over a stored log, appended to the drift table."""
    path, out = new_path(spark, "log"), new_path(spark, "drift")
    latest = stored_latest(spark, sf)
    log.append_log(results(spark, sf, latest=latest), path)
    drift_check(
        materialise(features(clean.clean_rows(latest))),
        log.read_log(spark, path),
        Monitoring(),
        since="2024-01-15",
        persist_to=out,
    )
    return shown(spark.read.parquet(out).drop("computed_at", "day"))


@query
def drift_job_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The check over the whole log, without a first day."""
    path, latest = new_path(spark, "log"), stored_latest(spark, sf)
    log.append_log(results(spark, sf, latest=latest), path)
    found = drift_check(
        materialise(features(clean.clean_rows(latest))), log.read_log(spark, path), Monitoring()
    )
    return shown(found.select("feature", "psi", "status", "baseline_n", "current_n"))


@query
def drift_edge_cases(spark: SparkSession, sf: str) -> DataFrame:
    """A constant baseline, a side without values, and NaN among the traffic."""
    train = split_frame(stored_features(spark, sf), "train")
    nothing, number = "cast(null as double)", "cast(limit_bal as double)"
    baseline = train.selectExpr(
        "1.0D AS constant", f"{nothing} AS no_baseline", f"{number} AS no_traffic", f"{number} AS some_nan"
    )
    traffic = train.selectExpr(
        f"{number} AS constant", f"{number} AS no_baseline", f"{nothing} AS no_traffic", f"{number} AS some_nan"
    ).unionByName(train.selectExpr(f"{number} AS constant", *(
        f"{t} AS {n}" for n, t in (
            ("no_baseline", number), ("no_traffic", nothing), ("some_nan", "cast('NaN' as double)")
        )
    )))
    names = ("constant", "no_baseline", "no_traffic", "some_nan")
    found = drift.drift_table(drift.fit_profile(baseline, names), traffic)
    return shown(found.select("feature", "psi", "status", "constant_baseline"))


@query
def drift_job_features(spark: SparkSession, sf: str) -> DataFrame:
    """The check over a log that keeps the tracked features, so that all are watched."""
    path = new_path(spark, "log")
    latest = stored_latest(spark, sf)
    table = materialise(features(clean.clean_rows(latest)))
    asked = scoring.request_features(
        scoring.accepted(requests(spark, sf, latest)), keep=("predicted_at", *scoring.RAW_INPUTS)
    )
    answers = scoring.decide(
        scoring.fixture_scorer(asked),
        valid_threshold(latest),
        VERSION,
        keep=("predicted_at", *log.LOG_INPUTS, *(f for f in TRACKED_FEATURES if f not in log.LOG_INPUTS)),
    )
    log.append_log(answers, path, TRACKED_FEATURES)
    logged = log.read_log(spark, path, features=TRACKED_FEATURES)
    return shown(drift_check(table, logged).drop("computed_at"))


# ---- streams -------------------------------------------------------------------------


def _score_stream(spark: SparkSession, events: str, latest: DataFrame, out: str, checkpoint: str) -> None:
    finish(
        score_streaming.score_stream(
            score_streaming.event_stream(spark, events), latest, out, checkpoint,
            valid_threshold(latest), VERSION, features=TRACKED_FEATURES,
        )
    )


def _scored_stream(spark: SparkSession, sf: str, latest: DataFrame) -> str:
    out = new_path(spark, "scored")
    # A pattern, as the table may be one file or a folder of files.
    _score_stream(spark, f"{sf}/events.parquet*", latest, out, new_path(spark, "checkpoint"))
    return out


def _disturbed_stream(spark: SparkSession, sf: str) -> str:
    """All events, some of them without a client or with one that nobody knows; then, after a
    restart, a tenth of them again, half of those changed."""
    events = read_table(spark, sf, "events")
    client = F.when(F.col("event_id") % 89 == 0, F.col("user_id") + 1_000_000_000).when(F.col("event_id") % 97 != 0, F.col("user_id"))
    first = events.withColumn("user_id", client)
    again = first.filter("event_id % 10 = 0").withColumn("value", F.when(F.col("event_id") % 20 == 0, F.col("value") + 1).otherwise(F.col("value")))
    latest = stored_latest(spark, sf)
    folder, out, checkpoint = (new_path(spark, n) for n in ("events", "scored", "checkpoint"))
    for delivery in (first, again):
        delivery.write.mode("append").parquet(folder)
        _score_stream(spark, folder, latest, out, checkpoint)
    return out


@query
def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per event id: its result, or why it has none."""
    answers = score_streaming.read_results(spark, _disturbed_stream(spark, sf), TRACKED_FEATURES)
    return shown(
        answers.select(
            "event_id", "client_id", "status", F.array_join("reasons", ",").alias("reasons"), "default_probability",
            "decision", "threshold", "risk_band", "model_version",
        )
    )


@query
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of the same stream that have no result, and repeats with other content."""
    held = score_streaming.read_quarantine(spark, f"{_disturbed_stream(spark, sf)}-quarantine")
    return shown(
        held.select("event_id", "client_id", "shift", "limit_bal", "age", "status", F.array_join("reasons", ",").alias("reasons"))
    )


def _logged_stream(spark: SparkSession, sf: str, latest: DataFrame) -> str:
    out = new_path(spark, "log")
    answers = _scored_stream(spark, sf, latest)
    finish(
        score_streaming.log_stream(
            spark, answers, out, new_path(spark, "checkpoint"), features=TRACKED_FEATURES
        )
    )
    return out


@query
def stream_log(spark: SparkSession, sf: str) -> DataFrame:
    logged = score_streaming.read_loads(
        spark, _logged_stream(spark, sf, stored_latest(spark, sf))
    )
    return scoring.score_counters(logged, ("day", "model_version"))


@query
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    latest = stored_latest(spark, sf)
    path = _logged_stream(spark, sf, latest)
    schema = score_streaming.read_loads(spark, path, TRACKED_FEATURES).schema
    stream = spark.readStream.schema(schema).option("basePath", path).parquet(path)
    out = new_path(spark, "daily")
    finish(
        drift_streaming.drift_stream(
            stream, profile(latest), out, new_path(spark, "checkpoint")
        )
    )
    return shown(drift_streaming.read_daily_drift(spark, out))


# ---- model preparation and training --------------------------------------------------


def fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, prep.Preparation]:
    table = stored_features(spark, sf)
    return table, prep.fit_preparation(split_frame(table, "train"), model_columns(table))


@query
def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """The required inputs of a model in training order, and how many values each has."""
    table = stored_features(spark, sf)
    names = model_columns(table)
    inputs = scoring.require_columns(table, names)
    counts = inputs.agg(*(F.count(c).alias(c) for c in names))
    rows = ", ".join(
        f"named_struct('position', {k}, 'name', '{c}', 'n', {c})" for k, c in enumerate(names)
    )
    return counts.selectExpr(f"inline(array({rows}))")


@query
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    table, p = fitted(spark, sf)
    return prep.apply_columns(table, p.one_hot(), ["client_id"])


@query
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    table, p = fitted(spark, sf)
    return shown(prep.apply_columns(table, p.imputed(), ["client_id"]))


@query
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    table, p = fitted(spark, sf)
    return shown(prep.apply_columns(table, p.standardised(), ["client_id"]))


@query
def tree_inputs(spark: SparkSession, sf: str) -> DataFrame:
    table, p = fitted(spark, sf)
    return shown(prep.apply_columns(table, p.with_sentinel(), ["client_id"]))


@query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return shown(prep.class_weights(split_frame(feature_table(spark, sf), "train")))


@query
def oversampled(spark: SparkSession, sf: str) -> DataFrame:
    train = materialise(split_frame(feature_table(spark, sf), "train"))
    return prep.oversample_positives(train).groupBy("default_next_month").agg(
        F.count("*").alias("n")
    )


@query
def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    train = materialise(split_frame(feature_table(spark, sf), "train"))
    folded = prep.stratified_folds(train, ModelConfig().cv_folds, ModelConfig().seed)
    return folded.groupBy("default_next_month", "fold").agg(F.count("*").alias("n"))


# Iterations end by tolerance, by early stop or at the number declared in ``ModelConfig``.
# ``search_settings`` and ``boosted_search`` run the whole searches; the others fit one stated
# setting of each candidate.
FULL = Settings()
STATED_BOOSTING = {
    "step": (0.1,), "depth": (4,), "leaves": (15,), "least": (50,), "l2": (1.0,), "rounds": (200,)
}


def stated_linear() -> training.Candidate:
    """The linear candidate at one penalty, C = 1."""
    return replace(training.logistic_candidate(FULL), grid=lambda lr, n: [{lr.regParam: 1.0 / n}])


def linear_model(table: DataFrame) -> training.SearchResult:
    train = split_frame(table, "train")
    return training.search(stated_linear(), train, model_columns(table), FULL)


@query
def train_select(spark: SparkSession, sf: str) -> DataFrame:
    """A stated linear setting against a stated boosted one on valid.

    The winner is calibrated and measured on test.
    """
    table = stored_features(spark, sf)
    candidates = [stated_linear(), training.boosted_candidate(FULL, STATED_BOOSTING)]
    outcome = training.train(table, candidates, FULL, "trees")
    won = max(outcome.candidates, key=outcome.candidates.get)
    return report_tables({"trees": outcome}, FULL)["models"].select(
        "flavor",
        F.lit(len(outcome.candidates)).alias("candidates"),
        F.lit(won == outcome.algorithm).alias("best_on_valid"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("tn") + F.col("fp")).alias("negatives"),
        (F.col("roc_auc") > 0.5).alias("better_than_chance"),
    )


@query
def train_network(spark: SparkSession, sf: str) -> DataFrame:
    """The network, stopped by its watched rows; one sweep row per cost ratio."""
    table = stored_features(spark, sf)
    outcome = training.train(table, [training.network_candidate(FULL)], FULL, "network")
    sweep = report_tables({"network": outcome}, FULL)["cost_sweep"]
    return sweep.select(
        "flavor",
        "fn_fp_ratio",
        F.col("threshold").between(0, 1).alias("threshold_ok"),
        F.col("flagged_pct").between(0, 100).alias("share_ok"),
    )


@query
def search_settings(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cross-validated search of the linear candidate: 20 penalties on 4 folds."""
    train = split_frame(stored_features(spark, sf), "train")
    found = training.search(
        training.logistic_candidate(FULL), train, model_columns(train), FULL
    )
    return train.groupBy().agg(
        F.count("*").alias("n"),
        F.max(F.lit(len(found.tried))).alias("settings"),
        F.max(F.lit(found.folds)).alias("folds"),
        F.max(F.lit(found.cv_pr_auc == max(found.tried))).alias("best_chosen"),
    )


@query
def boosted_search(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cross-validated search of the boosted candidate: 25 drawn settings on 4 folds."""
    train = split_frame(stored_features(spark, sf), "train")
    found = training.search(training.boosted_candidate(FULL), train, model_columns(train), FULL)
    return train.groupBy().agg(
        F.count("*").alias("n"),
        F.max(F.lit(len(found.tried))).alias("settings"),
        F.max(F.lit(found.folds)).alias("folds"),
        F.max(F.lit(found.cv_pr_auc == max(found.tried))).alias("best_chosen"),
        # By chance the average precision is the share of positives.
        (F.lit(found.cv_pr_auc) > F.avg("default_next_month")).alias("better_than_chance"),
    )


@query
def boosted_gains(spark: SparkSession, sf: str) -> DataFrame:
    """The best first split of each feature in boosting: 16 bins at exact quantiles, balanced
    weights, L2 of 1, at least 20 rows a side."""
    train = materialise(split_frame(feature_table(spark, sf), "train"))
    names = model_columns(train)
    edges = boosting.column_edges(train, names, 16, exact=True)
    weighted = prep.with_class_weight(train).withColumn("x", F.array(*(F.col(c).cast("double") for c in names)))
    table = boosting.binned(weighted, "x", edges, "default_next_month", "weight")
    return shown(boosting.root_gains(table, boosting.Setting(l2=1.0, least=20), names, edges))


@query
def linear_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The slope of the penalised loss at the fitted linear model; zero at the optimum."""
    table = stored_features(spark, sf)
    train = split_frame(table, "train")
    found = linear_model(table)
    scored = found.pipeline.transform(prep.with_class_weight(train)).withColumn("x", vector_to_array("features"))
    fitted_model = found.pipeline.stages[-1]
    rest = F.col("weight") * (training.margin("probability") - F.col("default_next_month"))
    penalty = fitted_model.getRegParam()
    slopes = [
        (F.sum(rest * F.col("x")[k]) / F.sum("weight") + F.lit(penalty * float(b))).alias(f"s{k}")
        for k, b in enumerate(fitted_model.coefficients)
    ]
    row = scored.agg((F.sum(rest) / F.sum("weight")).alias("s"), *slopes)
    largest = F.greatest(*(F.abs(c) for c in row.columns))
    return row.select((largest < 1e-4).alias("at_optimum"), F.lit(len(slopes)).alias("inputs"))


def tied_valid(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(evaluate.tied_counts(split_frame(scores(spark, sf), "valid")))


@query
def isotonic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Isotonic calibration of the fixture score on valid, per distinct score."""
    counts = tied_valid(spark, sf)
    fitted_steps = training.fit_isotonic(counts, "p").transform(counts)
    return shown(fitted_steps.select("p", F.col("n").cast("bigint").alias("n"), "calibrated"))


@query
def sigmoid_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The slopes of the loss at the fitted sigmoid; zero at the optimum."""
    counts = tied_valid(spark, sf)
    curve = training.fit_sigmoid(counts)
    a, b = float(curve.coefficients[0]), float(curve.intercept)
    rest = F.expr(f"w * (1.0D / (1.0D + exp(-({a!r}D * p + {b!r}D))) - y)")
    total = F.sum("w")
    return training.sigmoid_points(counts).agg(
        (F.abs(F.sum(rest) / total) < 1e-5).alias("level_ok"),
        (F.abs(F.sum(rest * F.col("p")) / total) < 1e-5).alias("slope_ok"),
        F.round(total).cast("bigint").alias("n"),
    )


@query
def calibrated_brier(spark: SparkSession, sf: str) -> DataFrame:
    """Brier score on valid before and after calibration, isotonic and sigmoid.

    Of all monotone maps the isotonic one has the smallest Brier score on its own rows.
    """
    table = stored_features(spark, sf)
    valid = split_frame(table, "valid")
    base = linear_model(table).pipeline
    frames = {"none": training.score_frame(base, valid, FULL, uncalibrated=True)}
    for method in ("isotonic", "sigmoid"):
        settings = Settings(model=ModelConfig(calibration=method))
        frames[method] = training.score_frame(training.calibrate(base, valid, settings), valid, settings)
    brier = {
        method: evaluate.ranking_metrics(evaluate.ranked_scores(frame)).first()["brier"]
        for method, frame in frames.items()
    }
    return valid.groupBy().agg(
        F.count("*").alias("n"),
        *(
            F.max(F.lit(brier["isotonic"] <= brier[m] + 1e-12)).alias(f"isotonic_below_{m}")
            for m in ("none", "sigmoid")
        ),
    )


@query
def model_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Register two versions, load the newest, and score the requests with it."""
    latest = stored_latest(spark, sf)
    table = materialise(features(clean.clean_rows(latest)))
    names = model_columns(table)
    found = linear_model(table)
    model = training.calibrate(found.pipeline, split_frame(table, "valid"), FULL)
    root = new_path(spark, "models")
    save_model(spark, root, "linear", model, names, 0.2, COST, version="20260101T000000Z")
    save_model(spark, root, "linear", model, names, 0.25, COST, version="20260102T000000Z")
    loaded, card = load_model(spark, root, "linear")
    answers = scoring.score_requests(
        requests(spark, sf, latest),
        card["threshold"],
        card["version"],
        training.model_scorer(loaded, card["feature_names"]),
        keep=("event_id",),
    )
    return answers.groupBy("model_version").agg(
        F.lit(len(card["feature_names"])).alias("inputs"),
        F.max("threshold").alias("threshold"),
        F.count("*").alias("scored"),
        F.count_if(F.col("default_probability").between(0, 1)).alias("probabilities"),
    )


@query
def pipeline_run(spark: SparkSession, sf: str) -> DataFrame:
    """Raw table to registered models and reports, both flavours, one stated setting each.

    A row per flavour, from the stored metadata and the report tables as read back.
    """
    root = new_path(spark, "run")
    flavors = {
        "trees": [stated_linear(), training.boosted_candidate(FULL, STATED_BOOSTING)],
        "network": [training.network_candidate(FULL)],
    }
    done = run_pipeline(spark, raw_panel(spark, sf), root, flavors, FULL)
    cards = None
    for flavor, version in done.versions.items():
        row = read_metadata(spark, f"{root}/models", flavor, version)
        cards = row if cards is None else cards.unionByName(row)

    def stored(path: str, kind: str):
        return F.get_json_object("document", f"$.{path}").cast(kind)

    out = cards.select(
        "flavor",
        F.col("n_features").alias("inputs"),
        *(stored(f"split_sizes.{s}", "bigint").alias(s) for s in ("train", "valid", "test")),
        stored("test_metrics.pr_auc", "double").alias("_pr_auc"),
    )
    counted = {
        "models": F.max("pr_auc").alias("_reported"),
        "confusion": F.sum(F.expr("tn + fp + fn + tp")).cast("bigint").alias("decided"),
        "calibration": F.sum("n").cast("bigint").alias("calibrated"),
        "fairness": F.count("*").alias("groups"),
        "cost_sweep": F.count("*").alias("ratios"),
    }
    for name, measure in counted.items():
        out = out.join(done.reports[name].groupBy("flavor").agg(measure), "flavor", "left")
    same = (F.abs(F.col("_pr_auc") - F.col("_reported")) < 1e-12).alias("metrics_stored")
    return out.select("*", same).drop("_pr_auc", "_reported")


__all__ = ["QUERIES"]


# ---- the plan of large tables, checked on small ones ---------------------------------

#: These run cut into ranges, and with quantiles narrowed by a sample, at every size.
RANGED = (
    "cv_folds", "cost_curve", "optimal_threshold", "ranking_metrics", "metrics_row", "calibration", "fairness",
    "cost_sweep", "lgd_stats", "prob_summary", "impute_median", "standardise", "drift_table",
    "isotonic_fit",
)


def ranged(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        with rank_plan(least_ranges=4, whole_rows=0):
            return fn(spark, sf)

    return run


QUERIES.update({name: ranged(QUERIES[name]) for name in RANGED})
