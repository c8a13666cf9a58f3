"""SQL twins of the registered queries, for an independent engine over the same tables.

Written from the definitions of the results, not from the Spark code: running totals are
plain windows, quantiles plain row numbers, and bins plain counts of edges.
"""

from __future__ import annotations

MONTHS = range(1, 7)
STATUS = [f"pay_status_{i}" for i in MONTHS]
BILL = [f"bill_amt_{i}" for i in MONTHS]
PAY = [f"pay_amt_{i}" for i in MONTHS]
TRACKED = [
    "limit_bal", "age", "avg_utilization", "max_delinquency", "months_delinquent",
    "avg_payment_ratio", "utilization_trend",
]
BASE = ["client_id", "limit_bal", "sex", "education", "marriage", "age", *STATUS, *BILL, *PAY]
RAW = [*BASE, "default_next_month", "ingested_at", "source_uri"]
CLEAN = RAW[:-1]

FN, FP, TP, TN = 16000, 3000, 1500, 0
RATIOS = (2, 3, 5, 8, 10, 15, 20, 30)

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTE[name] = (needs, body)


def sql(needs: str, body: str, local: dict[str, str] | None = None) -> str:
    """``body`` behind the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in CTE[name][0]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({CTE[n][1]})" for n in ordered]
    parts += [f"{n} AS MATERIALIZED ({b})" for n, b in (local or {}).items()]
    return f"WITH {', '.join(parts)} {body}"


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def stamp(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


# ---- account panel -------------------------------------------------------------------


def period(date: str) -> str:
    return f"((2001 - year({date})) * 12 + (7 - month({date}))) // 6 + 1"


def within(date: str) -> str:
    return f"{date} >= TIMESTAMP '1998-08-01' AND {date} < TIMESTAMP '2001-08-01'"


def per_period(expr: str, prefix: str) -> str:
    return ", ".join(f"sum(CASE WHEN period = {i} THEN {expr} END) AS {prefix}_{i}" for i in MONTHS)


cte(
    "bills",
    (),
    "SELECT o_custkey, "
    + per_period("cents", "bill")
    + ", "
    + per_period("1", "orders")
    + ", "
    + per_period("CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END", "open")
    + f" FROM (SELECT *, floor(o_totalprice * 100 + 0.5) AS cents, {period('o_orderdate')} AS period"
    f" FROM orders WHERE {within('o_orderdate')}) GROUP BY o_custkey",
)
cte(
    "payments",
    (),
    "SELECT o_custkey, "
    + per_period("paid", "paid")
    + " FROM (SELECT o_custkey, floor(l_extendedprice * 100 + 0.5)"
    f" * (100 - floor(l_discount * 100 + 0.5)) AS paid, {period('l_shipdate')} AS period"
    " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    f" WHERE l_returnflag = 'N' AND l_linestatus = 'F' AND {within('l_shipdate')})"
    " GROUP BY o_custkey",
)
cte(
    "money",
    ("bills", "payments"),
    "SELECT c_custkey AS client_id, round(c_acctbal * 100) AS limit_bal,"
    " CAST(c_nationkey % 2 + 1 AS INTEGER) AS sex, CAST(c_nationkey % 7 AS INTEGER) AS education,"
    " CAST((c_custkey // 3) % 4 AS INTEGER) AS marriage,"
    " CAST(16 + (c_custkey * 7) % 70 AS INTEGER) AS age, "
    + ", ".join(f"round(coalesce(bill_{i}, 0) / 100) AS bill_amt_{i}" for i in MONTHS)
    + ", "
    + ", ".join(f"round(coalesce(paid_{i}, 0) / 10000) AS pay_amt_{i}" for i in MONTHS)
    + ", "
    + ", ".join(f"coalesce(orders_{i}, 0) AS orders_{i}" for i in MONTHS)
    + ", "
    + ", ".join(f"coalesce(open_{i}, 0) AS open_{i}" for i in MONTHS)
    + " FROM customer LEFT JOIN bills ON bills.o_custkey = c_custkey"
    " LEFT JOIN payments ON payments.o_custkey = c_custkey",
)
cte(
    "statuses",
    ("money",),
    "SELECT client_id, limit_bal, sex, education, marriage, age, "
    + ", ".join(
        f"CAST(CASE WHEN orders_{i} = 0 THEN -2 WHEN pay_amt_{i} >= bill_amt_{i} THEN -1"
        f" WHEN open_{i} = 0 THEN 0 ELSE least(open_{i}, 9) END AS INTEGER) AS pay_status_{i}"
        for i in MONTHS
    )
    + ", "
    + ", ".join((*BILL, *PAY))
    + " FROM money",
)
SCORE = (
    "CASE WHEN limit_bal > 0 THEN round(1e0 / (1e0 + exp(-(-2e0 + 0.55e0 * pay_status_1"
    " + 1.2e0 * least(bill_amt_1 / limit_bal, 2e0)))), 4) END"
)
STATUS_SCORE = "round(1e0 / (1e0 + exp(-(-2e0 + 0.55e0 * pay_status_1))), 4)"
cte(
    "accounts",
    ("statuses",),
    "SELECT *, CAST(CASE WHEN (client_id * 7919 + 13) % 10000 <"
    f" CAST(round(({SCORE}) * 10000) AS BIGINT) THEN 1 ELSE 0 END AS INTEGER) AS default_next_month"
    " FROM statuses",
)
cte(
    "raw",
    ("accounts",),
    f"SELECT {', '.join(BASE)}, default_next_month, TIMESTAMP '2026-01-02' AS ingested_at,"
    " 'panel://accounts' AS source_uri FROM accounts UNION ALL SELECT "
    + ", ".join(f"{c} * 2 AS {c}" if c == "limit_bal" else c for c in BASE)
    + ", default_next_month, TIMESTAMP '2026-01-01', 'panel://accounts'"
    " FROM accounts WHERE client_id % 10 = 0",
)
cte(
    "latest",
    ("raw",),
    f"SELECT {', '.join(RAW)} FROM (SELECT *, row_number() OVER (PARTITION BY client_id"
    " ORDER BY ingested_at DESC) AS row_rank FROM raw) WHERE row_rank = 1",
)


def cleaned(source: str, extra: str = "") -> str:
    columns = []
    for c in CLEAN:
        if c == "education":
            columns.append("CASE WHEN education IN (1, 2, 3) THEN education ELSE 4 END AS education")
        elif c == "marriage":
            columns.append("CASE WHEN marriage IN (1, 2, 3) THEN marriage ELSE 3 END AS marriage")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)}{extra} FROM {source} WHERE limit_bal > 0 AND age BETWEEN 18 AND 100"


cte("clean", ("latest",), cleaned("latest"))

# ---- features ------------------------------------------------------------------------

UTIL = [f"(bill_amt_{i} / nullif(limit_bal, 0))" for i in MONTHS]
RATIO = [f"(pay_amt_{i} / nullif(bill_amt_{i + 1}, 0))" for i in range(1, 6)]
MEAN_BILL = f"(({' + '.join(BILL)}) / 6)"
BILLED = f"({' + '.join(BILL[1:])})"


def counted(names: list[str], test: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {n} {test} THEN 1 ELSE 0 END" for n in names) + ")"


FEATURES = {
    "limit_bal": "limit_bal",
    "education": "education",
    "marriage": "marriage",
    "age": "age",
    **{s: s for s in STATUS},
    "avg_utilization": f"({' + '.join(UTIL)}) / 6",
    "max_utilization": f"greatest({', '.join(UTIL)})",
    "utilization_trend": f"{UTIL[0]} - {UTIL[5]}",
    "credit_headroom": "(limit_bal - bill_amt_1) / nullif(limit_bal, 0)",
    "avg_payment_ratio": "(" + " + ".join(f"coalesce({r}, 0)" for r in RATIO) + ") / 5",
    "overall_payment_ratio": f"({' + '.join(PAY)}) / nullif({BILLED}, 0)",
    "has_billing_history": f"CASE WHEN {BILLED} <> 0 THEN 1 ELSE 0 END",
    "months_zero_payment": counted(PAY, "= 0"),
    "total_paid_6m": " + ".join(PAY),
    "recent_delinquency": "pay_status_1",
    "max_delinquency": f"greatest({', '.join(STATUS)})",
    "months_delinquent": counted(STATUS, ">= 1"),
    "delinquency_trend": "pay_status_1 - pay_status_6",
    "months_revolving": counted(STATUS, "= 0"),
    "months_paid_duly": counted(STATUS, "= -1"),
    "months_no_consumption": counted(STATUS, "= -2"),
    "ever_delinquent": f"CASE WHEN {counted(STATUS, '>= 1')} > 0 THEN 1 ELSE 0 END",
    "avg_bill_amt": MEAN_BILL,
    "bill_volatility": "sqrt(("
    + " + ".join(f"({b} - {MEAN_BILL}) * ({b} - {MEAN_BILL})" for b in BILL)
    + ") / 6)",
    "months_over_limit": counted(BILL, "> limit_bal"),
    "ever_over_limit": f"CASE WHEN {counted(BILL, '> limit_bal')} > 0 THEN 1 ELSE 0 END",
    "net_balance_ratio": "(bill_amt_1 - pay_amt_1) / nullif(limit_bal, 0)",
}
FAMILY = {
    "demographics": ["limit_bal", "education", "marriage", "age"],
    "status": STATUS,
    "utilization": ["avg_utilization", "max_utilization", "utilization_trend", "credit_headroom"],
    "payment": [
        "avg_payment_ratio", "overall_payment_ratio", "has_billing_history",
        "months_zero_payment", "total_paid_6m",
    ],
    "delinquency": [
        "recent_delinquency", "max_delinquency", "months_delinquent", "delinquency_trend",
        "months_revolving", "months_paid_duly", "months_no_consumption", "ever_delinquent",
    ],
    "dynamics": [
        "avg_bill_amt", "bill_volatility", "months_over_limit", "ever_over_limit",
        "net_balance_ratio",
    ],
}
INTEGER = {
    "education", "marriage", "age", *STATUS, "has_billing_history", "months_zero_payment",
    *FAMILY["delinquency"], "months_over_limit", "ever_over_limit",
}
DOUBLE = [f for f in FEATURES if f not in INTEGER]
# The published multiplier, reduced by the modulus so that the product stays small.
BUCKET = "((client_id % 100) * (2654435761 % 100)) % 100"
SPLIT = f"CASE WHEN {BUCKET} <= 69 THEN 'train' WHEN {BUCKET} <= 84 THEN 'valid' ELSE 'test' END"


def featured(source: str, extra: str = "") -> str:
    columns = ", ".join(f"{text} AS {name}" for name, text in FEATURES.items())
    return (
        f"SELECT client_id, sex, {columns}, default_next_month, {SPLIT} AS split_name{extra}"
        f" FROM {source}"
    )


def shown_feature(name: str) -> str:
    return name if name in INTEGER else r6(name, name)


cte("feat", ("clean",), featured("clean"))
FEATURE_ROW = (
    "client_id, sex, "
    + ", ".join(shown_feature(f) for f in FEATURES)
    + ", default_next_month, split_name"
)

# ---- scores --------------------------------------------------------------------------

cte(
    "scores",
    ("clean",),
    f"SELECT client_id, sex, {SPLIT} AS split_name, default_next_month AS y, {SCORE} AS p FROM clean",
)


def ranked(source: str, by: str = "") -> str:
    """Counts per distinct score, running from the highest score down."""
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"SELECT {lead}p, n, pos, sum(n) OVER ({part}ORDER BY p DESC) AS flagged,"
        f" sum(pos) OVER ({part}ORDER BY p DESC) AS caught,"
        f" sum(n) OVER ({part}) AS total, sum(pos) OVER ({part}) AS total_pos"
        f" FROM (SELECT {lead}p, count(*) AS n, sum(y) AS pos FROM {source} GROUP BY {lead}p)"
    )


def curve(source: str, by: str = "") -> str:
    """Outcome counts at every distinct score, and just above the highest."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {lead}threshold, {big('total - total_pos - fp', 'tn')}, {big('fp', 'fp')},"
        f" {big('total_pos - tp', 'fn')}, {big('tp', 'tp')},"
        f" CAST((total - total_pos - fp) * {TN} + fp * {FP} + (total_pos - tp) * {FN} + tp * {TP}"
        f" AS DOUBLE) AS cost FROM (SELECT {lead}p AS threshold, flagged - caught AS fp,"
        f" caught AS tp, total, total_pos FROM {source} UNION ALL SELECT {lead}"
        " nextafter(max(p), CAST('infinity' AS DOUBLE)), 0, 0, max(total), max(total_pos)"
        f" FROM {source}{group})"
    )


cte("ranked", ("scores",), ranked("scores"))
cte("ranked_split", ("scores",), ranked("scores", "split_name"))
cte("curve", ("ranked",), curve("ranked"))
cte("curve_split", ("ranked_split",), curve("ranked_split", "split_name"))
cte(
    "best_split",
    ("curve_split",),
    "SELECT split_name, threshold, cost FROM (SELECT *, row_number() OVER (PARTITION BY split_name"
    " ORDER BY cost, threshold DESC) AS k FROM curve_split) WHERE k = 1",
)
cte("thr", ("best_split",), "SELECT threshold AS t FROM best_split WHERE split_name = 'valid'")

AUC = (
    "sum((n - pos) * (caught - pos + pos / 2e0)) / nullif(CAST(sum(pos) * sum(n - pos) AS DOUBLE), 0)"
)
AP = "coalesce(sum(pos * (caught / flagged)) / nullif(sum(pos), 0), 0)"
BRIER = "sum(pos * (p - 1) * (p - 1) + (n - pos) * p * p) / sum(n)"


def outcome_counts(threshold: str) -> str:
    return (
        f"CAST(sum(CASE WHEN p >= {threshold} THEN 0 ELSE n - pos END) AS BIGINT) AS tn,"
        f" CAST(sum(CASE WHEN p >= {threshold} THEN n - pos ELSE 0 END) AS BIGINT) AS fp,"
        f" CAST(sum(CASE WHEN p >= {threshold} THEN 0 ELSE pos END) AS BIGINT) AS fn,"
        f" CAST(sum(CASE WHEN p >= {threshold} THEN pos ELSE 0 END) AS BIGINT) AS tp"
    )


def metric_row(source: str, by: str, threshold: str) -> str:
    """The full metric row per group of a ranked frame."""
    cost = f"(tn * {TN} + fp * {FP} + fn * {FN} + tp * {TP})"
    none = f"(pos * {FN} + (n - pos) * {TN})"
    everyone = f"(pos * {TP} + (n - pos) * {FP})"
    best = f"least({none}, {everyone})"
    return (
        f"SELECT {by}, n, {r6('pos / n', 'positive_rate')}, {r6('t', 'threshold')},"
        f" {r6('roc_auc', 'roc_auc')}, {r6('pr_auc', 'pr_auc')}, {r6('brier', 'brier')},"
        f" {r6('(tp + tn) / n', 'accuracy')},"
        f" {r6('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')},"
        f" {r6('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')},"
        f" {r6('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)', 'f1')}, tn, fp, fn, tp,"
        f" CAST({cost} AS DOUBLE) AS total_cost, {r6(f'{cost} / n', 'cost_per_client')},"
        f" CAST({none} AS DOUBLE) AS baseline_intervene_none,"
        f" CAST({everyone} AS DOUBLE) AS baseline_intervene_all,"
        f" CAST({best} - {cost} AS DOUBLE) AS savings_vs_best_baseline,"
        f" {r6(f'coalesce(({best} - {cost}) / nullif({best}, 0), 0) * 100', 'savings_pct')}"
        f" FROM (SELECT {by}, CAST(sum(n) AS BIGINT) AS n, sum(pos) AS pos, max({threshold}) AS t,"
        f" {AUC} AS roc_auc, {AP} AS pr_auc, {BRIER} AS brier, {outcome_counts(threshold)}"
        f" FROM {source} GROUP BY {by})"
    )


# ---- traffic -------------------------------------------------------------------------

BOUND = {
    "client_id": "client_id >= 0",
    "limit_bal": "limit_bal > 0 AND limit_bal <= 100000000",
    "sex": "sex BETWEEN 1 AND 2",
    "education": "education BETWEEN 0 AND 6",
    "marriage": "marriage BETWEEN 0 AND 3",
    "age": "age BETWEEN 18 AND 100",
    **{s: f"{s} BETWEEN -2 AND 9" for s in STATUS},
    **{b: f"{b} BETWEEN -1000000 AND 100000000" for b in BILL},
    **{p: f"{p} BETWEEN 0 AND 100000000" for p in PAY},
}
VALID = " AND ".join(f"({b})" for b in BOUND.values())
HEADER = (
    "event_id, strftime(ts, '%Y-%m-%d %H') AS batch_id, ts AS predicted_at,"
    " user_id AS client_id, value AS shift"
)
cte("headers", (), f"SELECT {HEADER} FROM events")
cte(
    "requests",
    ("headers", "latest"),
    "SELECT h.event_id, h.batch_id, h.predicted_at, h.shift, l.*, "
    "0 AS placeholder FROM headers h JOIN latest l ON l.client_id = h.client_id",
)
cte("valid_requests", ("requests",), f"SELECT * FROM requests WHERE {VALID}")
cte(
    "served_clean",
    ("valid_requests",),
    cleaned("valid_requests", ", event_id, batch_id, predicted_at, shift").replace(
        "default_next_month", "placeholder AS default_next_month"
    ),
)
cte(
    "served",
    ("served_clean",),
    featured("served_clean", ", event_id, batch_id, predicted_at, shift, bill_amt_1, pay_amt_1"),
)
DECIDE = (
    "CASE WHEN p >= t THEN 'flag' ELSE 'no_flag' END AS decision, t AS threshold,"
    " CASE WHEN p < t * 0.5e0 THEN 'low' WHEN p < t * 2e0 THEN 'medium' ELSE 'high' END AS risk_band,"
    " 'fixture-1' AS model_version"
)
cte(
    "results",
    ("served", "thr"),
    f"SELECT *, p AS default_probability, {DECIDE} FROM (SELECT *, {SCORE} AS p FROM served), thr",
)

# ---- drift ---------------------------------------------------------------------------


def long(source: str, names: list[str], extra: str = "", where: str = "") -> str:
    shift = {"limit_bal": "limit_bal * (1e0 + shift / 100e0)"} if "shifted" in where else {}
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST({shift.get(n, n)} AS DOUBLE) AS value{extra} FROM {source}"
        f"{'' if 'shifted' in where else where}"
        for n in names
    )


def edge_ctes(names: list[str]) -> dict[str, str]:
    """Inner bin edges from interpolated deciles of the training rows."""
    deciles = " UNION ALL ".join(f"SELECT {i} AS i" for i in range(11))
    return {
        "base": long("feat", names, "", " WHERE split_name = 'train'"),
        "ordered": "SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value)"
        " - 1 AS k, count(*) OVER (PARTITION BY feature) AS n FROM base WHERE value IS NOT NULL",
        "steps": "SELECT feature, i, ((n - 1) * i) // 10 AS lo, (((n - 1) * i) % 10) / 10 AS frac"
        f" FROM (SELECT feature, max(n) AS n FROM ordered GROUP BY feature), ({deciles})",
        "all_edges": "SELECT DISTINCT s.feature, CASE WHEN frac = 0 THEN a.value"
        " ELSE a.value + (b.value - a.value) * frac END AS edge FROM steps s"
        " JOIN ordered a ON a.feature = s.feature AND a.k = s.lo"
        " LEFT JOIN ordered b ON b.feature = s.feature AND b.k = s.lo + 1",
        "edges": "SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) AS bin"
        " FROM all_edges e WHERE edge > (SELECT min(edge) FROM all_edges m WHERE m.feature = e.feature)"
        " AND edge < (SELECT max(edge) FROM all_edges m WHERE m.feature = e.feature)",
        "bins": "SELECT feature, bin FROM edges UNION ALL SELECT DISTINCT feature, 0 FROM edges",
        "base_stats": "SELECT feature, avg(value) AS baseline_mean, count(*) AS baseline_n,"
        " count(value) AS valid FROM base GROUP BY feature",
        "base_bins": "SELECT feature, bin, count(*) AS c FROM (SELECT v.feature, (SELECT count(*)"
        " FROM edges e WHERE e.feature = v.feature AND e.edge <= v.value) AS bin FROM base v"
        " WHERE v.value IS NOT NULL) GROUP BY feature, bin",
    }


def drift_ctes(names: list[str], current: str, by: str = "") -> dict[str, str]:
    """PSI terms of a long frame ``current`` (feature, value and grouping columns)."""
    lead = f"{by}, " if by else ""
    on = f" AND c.{by} = s.{by}" if by else ""
    pick = f"s.{by}, " if by else ""
    return {
        **edge_ctes(names),
        "cur": current,
        "cur_stats": f"SELECT {lead}feature, avg(value) AS current_mean, count(*) AS current_n,"
        f" count(value) AS valid FROM cur GROUP BY {lead}feature",
        "cur_bins": f"SELECT {lead}feature, bin, count(*) AS c FROM (SELECT {lead}v.feature,"
        " (SELECT count(*) FROM edges e WHERE e.feature = v.feature AND e.edge <= v.value) AS bin"
        f" FROM cur v WHERE v.value IS NOT NULL) GROUP BY {lead}feature, bin",
        "shares": f"SELECT {pick}s.feature, g.bin, greatest(coalesce(b.c, 0) / q.valid, 1e-6) AS e,"
        " greatest(coalesce(c.c, 0) / s.valid, 1e-6) AS a FROM cur_stats s"
        " JOIN bins g ON g.feature = s.feature JOIN base_stats q ON q.feature = s.feature"
        " LEFT JOIN base_bins b ON b.feature = s.feature AND b.bin = g.bin"
        f" LEFT JOIN cur_bins c ON c.feature = s.feature AND c.bin = g.bin{on}",
        "psi": f"SELECT {lead}feature, sum((a - e) * ln(a / e)) AS psi FROM shares"
        f" GROUP BY {lead}feature",
        "drift": f"SELECT {pick}s.feature, {r6('p.psi', 'psi')}, CASE WHEN p.psi IS NULL THEN"
        " 'unknown' WHEN p.psi >= 0.25 THEN 'alert' WHEN p.psi >= 0.10 THEN 'warn' ELSE 'stable'"
        f" END AS status, {r6('q.baseline_mean', 'baseline_mean')},"
        f" {r6('s.current_mean', 'current_mean')}, q.baseline_n, s.current_n,"
        " (SELECT count(*) = 1 FROM all_edges x WHERE x.feature = s.feature) AS constant_baseline"
        " FROM cur_stats s JOIN base_stats q ON q.feature = s.feature"
        f" LEFT JOIN psi p ON p.feature = s.feature{on.replace('c.', 'p.')}",
    }


# ---- preparation ---------------------------------------------------------------------

NUMERIC = [f for f in FEATURES if f not in ("education", "marriage")]


def medians(names: list[str], source: str) -> str:
    """One row with the interpolated median of each column."""
    return "SELECT " + ", ".join(f"quantile_cont(CAST({n} AS DOUBLE), 0.5) AS {n}" for n in names) + f" FROM {source}"


cte("train", ("feat",), "SELECT * FROM feat WHERE split_name = 'train'")
cte("mid", ("train",), medians(NUMERIC, "train"))
FILLED = {n: f"coalesce(CAST(f.{n} AS DOUBLE), mid.{n})" for n in NUMERIC}
cte(
    "moments",
    ("train", "mid"),
    "SELECT "
    + ", ".join(
        f"avg({t}) AS m_{n}, CASE WHEN stddev_pop({t}) = 0 THEN 1 ELSE stddev_pop({t}) END AS s_{n},"
        f" min(CAST(f.{n} AS DOUBLE)) AS low_{n}"
        for n, t in FILLED.items()
    )
    + " FROM train f, mid",
)
cte(
    "classes",
    ("train",),
    "SELECT default_next_month AS label, count(*) AS n FROM train GROUP BY default_next_month",
)

# ---- the twins -----------------------------------------------------------------------

ORACLE: dict[str, str] = {}

ACCOUNT_ROW = ", ".join((*BASE, "default_next_month"))
RAW_ROW = f"{ACCOUNT_ROW}, {stamp('ingested_at', 'ingested_at')}, source_uri"
CLEAN_ROW = f"{ACCOUNT_ROW}, {stamp('ingested_at', 'ingested_at')}"

ORACLE["panel"] = sql("accounts", f"SELECT {ACCOUNT_ROW} FROM accounts")
ORACLE["land_raw"] = sql(
    "accounts",
    f"SELECT {ACCOUNT_ROW}, '2026-01-02 00:00:00' AS ingested_at, 'panel://accounts' AS source_uri"
    " FROM accounts",
)
ORACLE["delivery_report"] = sql(
    "accounts",
    "SELECT '' AS missing_columns, count(*) AS n, (SELECT count(*) FROM customer) AS expected,"
    " count(*) = (SELECT count(*) FROM customer) AS complete FROM accounts",
)
ORACLE["write_read_parquet"] = sql("raw", f"SELECT {RAW_ROW} FROM raw")
ORACLE["dated_replay"] = sql(
    "raw",
    "SELECT strftime(ingested_at, '%Y-%m-%d') AS dt, count(*) AS n, sum(limit_bal) AS limits"
    " FROM raw GROUP BY dt",
)
ORACLE["table_operations"] = sql(
    "raw",
    "SELECT count(*) AS n, sum(limit_bal) AS limits,"
    " count(*) FILTER (WHERE source_uri = 'panel://accounts') AS from_panel FROM raw",
)
ORACLE["raw_load"] = ORACLE["write_read_parquet"]

ORACLE["dedup_latest"] = sql("latest", f"SELECT {RAW_ROW} FROM latest")
ORACLE["incremental_load"] = ORACLE["dedup_latest"]
ORACLE["clean_table"] = sql("clean", f"SELECT {CLEAN_ROW} FROM clean")
ORACLE["clean_audit"] = sql(
    "latest raw",
    "SELECT count(*) AS distinct_clients,"
    " count(*) FILTER (WHERE education NOT IN (1, 2, 3, 4)) AS undocumented_education,"
    " count(*) FILTER (WHERE marriage NOT IN (1, 2, 3)) AS undocumented_marriage,"
    " count(*) FILTER (WHERE NOT (limit_bal > 0 AND age BETWEEN 18 AND 100)) AS implausible_rows,"
    " count(*) FILTER (WHERE limit_bal > 0 AND age BETWEEN 18 AND 100) AS kept_rows,"
    " (SELECT count(*) - count(DISTINCT client_id) FROM raw) AS duplicate_rows FROM latest",
)
ORACLE["month_helpers"] = sql(
    "clean",
    "SELECT client_id, "
    + ", ".join(r6(u, f"utilization_{i}") for i, u in enumerate(UTIL, 1))
    + ", "
    + ", ".join(r6(r, f"payment_ratio_{i}") for i, r in enumerate(RATIO, 1))
    + ", "
    + "(" + " + ".join(f"{b} * {b}" for b in BILL) + ") / 6 AS avg_bill_amt_sq FROM clean",
)
ORACLE["features_all"] = sql("feat", f"SELECT {FEATURE_ROW} FROM feat")
for _family, _names in FAMILY.items():
    ORACLE[f"features_{_family}"] = sql(
        "feat", f"SELECT client_id, {', '.join(shown_feature(n) for n in _names)} FROM feat"
    )
ORACLE["split_balance"] = sql(
    "feat",
    f"SELECT split_name, count(*) AS n, {big('sum(default_next_month)', 'positives')},"
    f" {r6('avg(default_next_month)', 'positive_rate')} FROM feat GROUP BY split_name",
)
ORACLE["split_audit"] = sql(
    "clean",
    "SELECT count(*) AS clients,"
    " (SELECT count(*) FROM (SELECT client_id FROM after GROUP BY client_id"
    " HAVING count(DISTINCT split_name) > 1)) AS in_two_splits,"
    " (SELECT count(*) FROM before JOIN after USING (client_id)"
    " WHERE before.split_name <> after.split_name) AS moved FROM after",
    {
        "before": f"SELECT client_id, {SPLIT} AS split_name FROM clean",
        "after": f"SELECT client_id, {SPLIT} AS split_name FROM (SELECT client_id FROM clean"
        " UNION ALL SELECT client_id + (SELECT max(client_id) FROM clean) FROM clean)",
    },
)
ORACLE["split_sizes"] = sql(
    "feat",
    f"SELECT split_name, count(*) AS n, {big('sum(months_delinquent)', 'months_delinquent')}"
    " FROM feat GROUP BY split_name",
)
TABLE_COLUMNS = ["client_id", "sex", *FEATURES, "default_next_month", "split_name"]


def _check(name: str, column: str, bad: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", {big(bad, 'bad_rows')} FROM feat"


ORACLE["validate_features"] = sql(
    "feat",
    " UNION ALL ".join(
        [
            _check("empty_table", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
            _check(
                "binary_target",
                "default_next_month",
                "count(*) FILTER (WHERE default_next_month NOT IN (0, 1))",
            ),
            _check(
                "positive_rate",
                "default_next_month",
                "CASE WHEN avg(default_next_month) > 0.01 AND avg(default_next_month) < 0.99"
                " THEN 0 ELSE 1 END",
            ),
            _check(
                "known_splits",
                "split_name",
                "count(*) FILTER (WHERE split_name NOT IN ('train', 'valid', 'test'))",
            ),
            _check("all_splits", "split_name", "3 - count(DISTINCT split_name)"),
            _check("unique_id", "client_id", "count(*) - count(DISTINCT client_id)"),
            *(
                _check("all_null", c, f"CASE WHEN count({c}) = 0 THEN count(*) ELSE 0 END")
                for c in TABLE_COLUMNS
            ),
            *(
                _check(
                    "infinite", c, f"count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE)))"
                )
                for c in TABLE_COLUMNS
                if c != "split_name"
            ),
        ]
    ),
)

ORACLE["dormancy_rate"] = sql(
    "feat",
    f"SELECT has_billing_history, count(*) AS n, {big('sum(default_next_month)', 'defaults')},"
    f" {r6('avg(default_next_month)', 'default_rate')} FROM feat GROUP BY has_billing_history",
)
ORACLE["lgd_stats"] = sql(
    "clean",
    f"SELECT count(*) AS defaults, {r6('quantile_cont(bill_amt_1, 0.5)', 'median_balance')},"
    f" {r6('avg(bill_amt_1)', 'mean_balance')},"
    f" {r6('quantile_cont(bill_amt_1, 0.5) * 0.8', 'loss_given_default')}"
    " FROM clean WHERE default_next_month = 1",
)
_paid = f"avg(({' + '.join(PAY)}) / 6)"
ORACLE["payment_flow"] = sql(
    "clean",
    f"SELECT count(*) AS n, {r6(_paid, 'mean_monthly_payment')}"
    " FROM clean WHERE default_next_month = 0",
)
ORACLE["base_rate"] = sql(
    "feat",
    f"SELECT count(*) AS n, {big('sum(default_next_month)', 'positives')},"
    f" {r6('avg(default_next_month)', 'positive_rate')} FROM feat",
)

ORACLE["confusion"] = sql(
    "scores",
    "SELECT split_name, count(*) FILTER (WHERE y = 0 AND p < 0.3e0) AS tn,"
    " count(*) FILTER (WHERE y = 0 AND p >= 0.3e0) AS fp,"
    " count(*) FILTER (WHERE y = 1 AND p < 0.3e0) AS fn,"
    " count(*) FILTER (WHERE y = 1 AND p >= 0.3e0) AS tp FROM scores GROUP BY split_name",
)
ORACLE["cost_curve"] = sql("curve", "SELECT threshold, tn, fp, fn, tp, cost FROM curve")
ORACLE["optimal_threshold"] = sql(
    "best_split", "SELECT split_name, threshold, cost FROM best_split"
)
ORACLE["baseline_costs"] = sql(
    "scores",
    f"SELECT split_name, CAST(sum(CASE WHEN y = 1 THEN {FN} ELSE {TN} END) AS DOUBLE)"
    f" AS intervene_none, CAST(sum(CASE WHEN y = 1 THEN {TP} ELSE {FP} END) AS DOUBLE)"
    " AS intervene_all FROM scores GROUP BY split_name",
)
ORACLE["ranking_metrics"] = sql(
    "ranked_split",
    f"SELECT split_name, {big('sum(n)', 'n')}, {r6(AUC, 'roc_auc')}, {r6(AP, 'pr_auc')},"
    f" {r6(BRIER, 'brier')} FROM ranked_split GROUP BY split_name",
)
ORACLE["metrics_row"] = sql(
    "ranked_split thr", metric_row("ranked_split, thr", "split_name", "t")
)
ORACLE["report_sink"] = sql("ranked_split", metric_row("ranked_split", "split_name", "0.3e0"))
_boundary = f"{FP}e0 / ({FN}e0 - {TP}e0 + {FP}e0)"
ORACLE["cost_boundary"] = sql(
    "scores",
    f"SELECT {r6(f'max({_boundary})', 'boundary')},"
    f" count(*) FILTER (WHERE p >= {_boundary}) AS flagged,"
    f" round(avg(y) FILTER (WHERE p >= {_boundary}), 6) AS flagged_default_rate FROM scores",
)
ORACLE["calibration"] = sql(
    "scores",
    f"SELECT bin, count(*) AS n, {r6('avg(p)', 'mean_predicted')},"
    f" {r6('avg(y)', 'observed_rate')}, {r6('avg(p) - avg(y)', 'gap')} FROM binned GROUP BY bin",
    {
        "binned": "SELECT y, p, CAST(greatest((((k - 1) * 10 + n - 2) // (n - 1)) - 1, 0) AS INTEGER)"
        " AS bin FROM (SELECT y, p, row_number() OVER (ORDER BY p, client_id) AS k,"
        " count(*) OVER () AS n FROM scores)"
    },
)
ORACLE["fairness"] = sql(
    "scores",
    "SELECT split_name, sex AS code, CASE sex WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS \"group\","
    f" {big('n', 'n')}, {r6('pos / n', 'actual_default_rate')},"
    f" {r6('(tp + fp) / n', 'selection_rate')},"
    f" {r6('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')},"
    f" {r6('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')}, {r6('auc', 'roc_auc')}"
    f" FROM (SELECT split_name, sex, sum(n) AS n, sum(pos) AS pos, {AUC} AS auc,"
    f" {outcome_counts('0.3e0')} FROM by_group GROUP BY split_name, sex)",
    {"by_group": ranked("scores", "split_name, sex")},
)
_sweep_ratio = " UNION ALL ".join(f"SELECT {r} AS ratio" for r in RATIOS)
ORACLE["cost_sweep"] = sql(
    "curve_split ranked_split",
    f"SELECT CAST(ratio AS DOUBLE) AS fn_fp_ratio, {r6('threshold', 'threshold')},"
    f" {r6('(tp + fp) / n * 100', 'flagged_pct')},"
    f" {r6('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')},"
    f" {r6('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')},"
    f" {r6('(best - cost) / best * 100', 'savings_pct')}"
    f" FROM (SELECT *, tn * {TN} + fp * {FP} + fn * {FP} * ratio + tp * {TP} AS cost,"
    f" least(pos * {FP} * ratio, pos * {TP} + (n - pos) * {FP}) AS best FROM at_test)",
    {
        "ratios": _sweep_ratio,
        "priced": "SELECT ratio, threshold, row_number() OVER (PARTITION BY ratio ORDER BY"
        f" tn * {TN} + fp * {FP} + fn * {FP} * ratio + tp * {TP}, threshold DESC) AS k"
        " FROM curve_split, ratios WHERE split_name = 'valid'",
        "at_test": "SELECT ratio, threshold, sum(n) AS n, sum(pos) AS pos,"
        f" {outcome_counts('threshold')} FROM ranked_split, priced"
        " WHERE k = 1 AND split_name = 'test' GROUP BY ratio, threshold",
    },
)


_flavors = {"behaviour": SCORE, "status_only": STATUS_SCORE}
_compare: dict[str, str] = {
    "flavors": " UNION ALL ".join(
        f"SELECT '{f}' AS flavor, {SPLIT} AS split_name, default_next_month AS y, {s} AS p FROM clean"
        for f, s in _flavors.items()
    )
}
_compare["ranked_both"] = ranked("flavors", "flavor, split_name")
_compare["curve_both"] = curve("ranked_both", "flavor, split_name")
_compare["best_both"] = (
    "SELECT flavor, threshold AS t FROM (SELECT *, row_number() OVER (PARTITION BY flavor"
    " ORDER BY cost, threshold DESC) AS k FROM curve_both WHERE split_name = 'valid') WHERE k = 1"
)
_compare["test_both"] = (
    "SELECT r.*, b.t FROM ranked_both r JOIN best_both b ON b.flavor = r.flavor"
    " WHERE split_name = 'test'"
)
ORACLE["model_compare"] = sql("clean", metric_row("test_both", "flavor", "t"), _compare)

_reasons = ", ".join(f"CASE WHEN {b} THEN NULL ELSE '{n}' END" for n, b in BOUND.items())
ORACLE["request_validation"] = sql(
    "requests",
    f"SELECT event_id, client_id, concat_ws(',', {_reasons}) AS reasons FROM requests"
    f" WHERE NOT ({VALID})",
)
ORACLE["duplicate_requests"] = sql(
    "headers",
    "SELECT batch_id, client_id, count(*) AS copies FROM headers GROUP BY batch_id, client_id"
    " HAVING count(*) > 1",
)
_batches = {
    "batches": "SELECT batch_id, CAST(sum(copies) AS BIGINT) AS records,"
    " count(*) FILTER (WHERE copies > 1) AS duplicated_clients FROM (SELECT batch_id, client_id,"
    " count(*) AS copies FROM headers GROUP BY batch_id, client_id) GROUP BY batch_id"
}
ORACLE["batch_status"] = sql(
    "headers",
    "SELECT *, CASE WHEN records > 500 THEN 'oversized' WHEN duplicated_clients > 0 THEN"
    " 'duplicate_ids' ELSE 'ok' END AS status FROM batches",
    _batches,
)
ORACLE["accepted_batches"] = sql(
    "headers",
    "SELECT event_id, batch_id, client_id FROM headers WHERE batch_id IN (SELECT batch_id"
    " FROM batches WHERE records <= 500 AND duplicated_clients = 0)",
    _batches,
)
ORACLE["request_features"] = sql("served", f"SELECT {FEATURE_ROW}, event_id FROM served")
ORACLE["request_guard"] = sql(
    "valid_requests served",
    "SELECT (SELECT count(*) FROM valid_requests) AS valid, (SELECT count(*) FROM served) AS scored,"
    " (SELECT count(*) FROM valid_requests WHERE event_id NOT IN (SELECT event_id FROM served))"
    " AS lost",
)
RESULT = (
    "event_id, client_id, round(default_probability, 6) AS default_probability, decision,"
    " round(threshold, 6) AS threshold, risk_band, model_version"
)
ORACLE["score_decisions"] = sql("results", f"SELECT {RESULT} FROM results")
ORACLE["risk_bands"] = sql(
    "results",
    f"SELECT risk_band, decision, count(*) AS n, {r6('avg(p)', 'mean_probability')}"
    " FROM results GROUP BY risk_band, decision",
)
DAY = "strftime(predicted_at, '%Y-%m-%d')"
ORACLE["score_counters"] = sql(
    "results",
    f"SELECT {DAY} AS day, model_version, count(*) AS predictions,"
    " count(*) FILTER (WHERE decision = 'flag') AS flagged FROM results GROUP BY ALL",
)
ORACLE["prob_summary"] = sql(
    "results",
    f"SELECT count(p) AS n, {r6('avg(p)', 'mean')}, {r6('quantile_cont(p, 0.5)', 'p50')},"
    f" {r6('quantile_cont(p, 0.95)', 'p95')}, {r6('max(p)', 'max')} FROM results",
)
ORACLE["skew_audit"] = sql(
    "feat latest",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) AS n,"
        f" count(*) FILTER (WHERE s.{f} IS DISTINCT FROM f.{f}) AS differing,"
        f" coalesce(max(abs(CAST(s.{f} AS DOUBLE) - CAST(f.{f} AS DOUBLE))), 0) AS max_abs_diff"
        " FROM served_accounts s JOIN feat f ON f.client_id = s.client_id"
        for f in FEATURES
    ),
    {
        "accepted_accounts": f"SELECT * FROM latest WHERE {VALID}",
        "clean_accounts": cleaned("accepted_accounts"),
        "served_accounts": featured("clean_accounts"),
    },
)
LOG_ROW = (
    f"{stamp('predicted_at', 'predicted_at')}, client_id, model_version,"
    " round(default_probability, 6) AS default_probability, decision, risk_band,"
    " round(threshold, 6) AS threshold, limit_bal, age, pay_status_1, bill_amt_1, pay_amt_1"
)
ORACLE["prediction_log"] = sql("results", f"SELECT {LOG_ROW}, {DAY} AS day FROM results")
ORACLE["flag_rate"] = sql(
    "results",
    "SELECT day, model_version, predictions, round(rate, 6) AS flag_rate, round(rate - lag(rate)"
    " OVER (PARTITION BY model_version ORDER BY day), 6) AS change"
    f" FROM (SELECT {DAY} AS day, model_version, count(*) AS predictions,"
    " avg(CASE WHEN decision = 'flag' THEN 1 ELSE 0 END) AS rate FROM results GROUP BY ALL)",
)
ORACLE["latest_decision"] = sql(
    "results",
    f"SELECT client_id, {stamp('predicted_at', 'predicted_at')}, model_version, decision,"
    " round(default_probability, 6) AS default_probability FROM (SELECT *, row_number() OVER"
    " (PARTITION BY client_id ORDER BY predicted_at DESC, default_probability) AS k FROM results)"
    " WHERE k = 1",
)
ORACLE["decision_history"] = sql(
    "results",
    "SELECT client_id, model_version, count(*) AS decisions,"
    " count(*) FILTER (WHERE decision = 'flag') AS flagged,"
    f" {stamp('min(predicted_at)', 'first_at')}, {stamp('max(predicted_at)', 'last_at')},"
    " arg_max(decision, predicted_at) AS last_decision FROM results GROUP BY client_id, model_version",
)

DRIFT_ROW = (
    "feature, psi, status, baseline_mean, current_mean, baseline_n, current_n, constant_baseline"
)
ORACLE["drift_table"] = sql(
    "feat served", f"SELECT {DRIFT_ROW} FROM drift", drift_ctes(TRACKED, long("served", TRACKED))
)
_shifted = drift_ctes(TRACKED, long("served", TRACKED, "", "shifted"))
ORACLE["drift_shifted"] = sql("feat served", f"SELECT {DRIFT_ROW} FROM drift", _shifted)
ORACLE["psi_breakdown"] = sql(
    "feat served",
    f"SELECT s.feature, CAST(s.bin AS INTEGER) AS bin, {r6('l.edge', 'bin_lower')},"
    f" {r6('u.edge', 'bin_upper')}, {r6('e', 'expected_pct')}, {r6('a', 'actual_pct')},"
    f" {r6('(a - e) * ln(a / e)', 'psi_contribution')} FROM shares s"
    " LEFT JOIN edges l ON l.feature = s.feature AND l.bin = s.bin"
    " LEFT JOIN edges u ON u.feature = s.feature AND u.bin = s.bin + 1",
    _shifted,
)
ORACLE["drift_alerts"] = sql(
    "feat served",
    "SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'alert'), '')"
    " AS alerting, count(*) FILTER (WHERE status = 'alert') AS n_alerts, max(psi) AS max_psi FROM drift",
    _shifted,
)
_daily = drift_ctes(TRACKED, long("served", TRACKED, f", {DAY} AS day"), "day")
ORACLE["drift_by_day"] = sql("feat served", f"SELECT day, {DRIFT_ROW} FROM drift", _daily)
_since = drift_ctes(
    ["limit_bal", "age"],
    long("results", ["limit_bal", "age"], "", " WHERE predicted_at >= TIMESTAMP '2024-01-15'"),
)
ORACLE["drift_job"] = sql(
    "feat results",
    "SELECT feature, psi, status, baseline_mean, current_mean, baseline_n, current_n FROM drift",
    _since,
)

ORACLE["drift_job_whole"] = sql(
    "feat results",
    "SELECT feature, psi, status, baseline_n, current_n FROM drift",
    drift_ctes(["limit_bal", "age"], long("results", ["limit_bal", "age"])),
)
ORACLE["drift_edge_cases"] = (
    "SELECT * FROM (VALUES ('constant', 0e0, 'stable', true), ('no_baseline', NULL, 'unknown', false),"
    " ('no_traffic', NULL, 'unknown', false), ('some_nan', 0e0, 'stable', false))"
    " AS t(feature, psi, status, constant_baseline)"
)
ORACLE["client_history"] = sql(
    "results",
    f"SELECT event_id, client_id, {stamp('predicted_at', 'predicted_at')}, model_version, decision,"
    " round(default_probability, 6) AS default_probability FROM results WHERE client_id = (SELECT"
    " client_id FROM results GROUP BY client_id ORDER BY count(*) DESC, client_id LIMIT 1)",
)
ORACLE["model_inputs"] = sql(
    "feat",
    " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS name, count({c}) AS n FROM feat"
        for k, c in enumerate(FEATURES)
    ),
)
ORACLE["drift_job_features"] = ORACLE["drift_table"]

_named = "event_id % 89 <> 0 AND event_id % 97 <> 0"
_client = "CASE WHEN event_id % 89 = 0 THEN user_id + 1000000000 WHEN event_id % 97 <> 0 THEN user_id END"
_no_result = "NULL, NULL, NULL, NULL, NULL"
ORACLE["stream_scoring"] = sql(
    "results requests",
    f"SELECT event_id, client_id, 'scored' AS status, '' AS reasons, {RESULT.split(', ', 2)[2]} FROM results WHERE {_named}"
    f" UNION ALL SELECT event_id, client_id, 'rejected', concat_ws(',', {_reasons}), {_no_result}"
    f" FROM requests WHERE {_named} AND NOT ({VALID})"
    f" UNION ALL SELECT event_id, {_client}, 'unknown_client', 'client_id', {_no_result}"
    f" FROM events WHERE NOT ({_named})",
)
ORACLE["stream_quarantine"] = sql(
    "requests",
    f"SELECT event_id, client_id, {r6('shift', 'shift')}, {r6('limit_bal', 'limit_bal')}, age, 'rejected' AS status,"
    f" concat_ws(',', {_reasons}) AS reasons FROM requests WHERE {_named} AND NOT ({VALID})"
    f" UNION ALL SELECT event_id, {_client}, round(value, 6), NULL, NULL, 'unknown_client', 'client_id'"
    f" FROM events WHERE NOT ({_named})"
    f" UNION ALL SELECT event_id, {_client}, round(value + 1, 6), NULL, NULL, 'conflicting_repeat', 'event_id'"
    " FROM events WHERE event_id % 20 = 0",
)
ORACLE["stream_log"] = ORACLE["score_counters"]
ORACLE["stream_drift"] = ORACLE["drift_by_day"]

ORACLE["one_hot"] = sql(
    "feat",
    "SELECT client_id, "
    + ", ".join(
        f"CAST(CASE WHEN {c} = {level} THEN 1 ELSE 0 END AS DOUBLE) AS {c}_{level}"
        for c, levels in (("education", (2, 3, 4)), ("marriage", (2, 3)))
        for level in levels
    )
    + " FROM feat",
)
ORACLE["impute_median"] = sql(
    "feat mid",
    f"SELECT client_id, {', '.join(r6(t, n) for n, t in FILLED.items())} FROM feat f, mid",
)
ORACLE["standardise"] = sql(
    "feat mid moments",
    "SELECT client_id, "
    + ", ".join(r6(f"({t} - m_{n}) / s_{n}", n) for n, t in FILLED.items())
    + " FROM feat f, mid, moments",
)
ORACLE["tree_inputs"] = sql(
    "feat moments",
    "SELECT client_id, "
    + ", ".join(r6(f"coalesce(CAST(f.{n} AS DOUBLE), low_{n} - 1)", n) for n in NUMERIC)
    + " FROM feat f, moments",
)
ORACLE["class_weights"] = sql(
    "classes",
    f"SELECT label, n, {r6('(SELECT sum(n) FROM classes) / (2 * n)', 'weight')},"
    " round((SELECT n FROM classes WHERE label = 0) / (SELECT n FROM classes WHERE label = 1), 6)"
    " AS pos_weight FROM classes",
)
ORACLE["oversampled"] = sql(
    "classes",
    "SELECT label AS default_next_month, CAST(CASE WHEN label = 1 THEN n * greatest(round_even("
    "(SELECT n FROM classes WHERE label = 0) / (SELECT n FROM classes WHERE label = 1), 0), 1)"
    " ELSE n END AS BIGINT) AS n FROM classes",
)
ORACLE["cv_folds"] = sql(
    "train",
    "SELECT default_next_month, CAST(k % 4 AS INTEGER) AS fold, count(*) AS n"
    " FROM (SELECT default_next_month, row_number() OVER (PARTITION BY default_next_month"
    " ORDER BY client_id) - 1 AS k FROM train) GROUP BY ALL",
)

# ---- training ------------------------------------------------------------------------
# Fitted numbers differ between engines; what must hold of them does not.

_split = "(SELECT count(*) FROM feat WHERE split_name = '{}'{})"
ORACLE["train_select"] = sql(
    "feat",
    "SELECT 'trees' AS flavor, 2 AS candidates, true AS best_on_valid,"
    f" {_split.format('test', ' AND default_next_month = 1')} AS positives,"
    f" {_split.format('test', ' AND default_next_month = 0')} AS negatives, true AS better_than_chance",
)
ORACLE["train_network"] = (
    "SELECT 'network' AS flavor, CAST(r AS DOUBLE) AS fn_fp_ratio, true AS threshold_ok, true AS share_ok"
    f" FROM (SELECT unnest([{', '.join(map(str, RATIOS))}]) AS r)"
)
ORACLE["search_settings"] = sql(
    "train", "SELECT count(*) AS n, 20 AS settings, 4 AS folds, true AS best_chosen FROM train"
)
ORACLE["boosted_search"] = sql(
    "train",
    "SELECT count(*) AS n, 25 AS settings, 4 AS folds, true AS best_chosen, true AS better_than_chance FROM train",
)
_sixteenths = ", ".join(f"{k / 16}e0" for k in range(1, 16))
ORACLE["boosted_gains"] = sql(
    "train",
    "SELECT feature, round(gain, 6) AS gain, CASE WHEN e < 1e300 THEN round(e, 6) END AS threshold, side = 1 AS missing_left"
    " FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY e, side) AS k FROM (SELECT *, max(gain) OVER"
    " (PARTITION BY feature) AS top FROM gains) WHERE gain >= top - 1e-9) WHERE k = 1",
    {
        "balanced": "SELECT *, count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY default_next_month)) AS w FROM train",
        "cell": " UNION ALL ".join(
            f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, w * (0.5e0 - default_next_month) AS g, w * 0.25e0 AS h FROM balanced"
            for f in FEATURES
        ),
        "edge": " UNION ALL ".join(
            f"SELECT DISTINCT '{f}' AS feature, unnest(quantile_cont(CAST({f} AS DOUBLE), [{_sixteenths}])) AS e FROM train"
            f" UNION ALL SELECT '{f}', 1e308"
            for f in FEATURES
        ),
        "part": "SELECT feature, e, side, sum(g) AS ga, sum(h) AS ha, count(*) AS na, sum(g) FILTER (l) AS gl,"
        " sum(h) FILTER (l) AS hl, count(*) FILTER (l) AS nl FROM (SELECT c.*, e, side, coalesce(x <= e, side = 1) AS l"
        " FROM cell c JOIN edge USING (feature), (SELECT unnest([0, 1]) AS side)) GROUP BY feature, e, side",
        "gains": "SELECT feature, e, side, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1) AS gain"
        " FROM part WHERE nl >= 20 AND na - nl >= 20 AND hl >= 1e-3 AND ha - hl >= 1e-3",
    },
)
# Five indicators and the columns that are not nominal.
ORACLE["linear_optimum"] = f"SELECT true AS at_optimum, {len(NUMERIC) + 5} AS inputs"
_tied = {
    "tied": "SELECT p, sum(y) AS pos, count(*) AS n FROM scores WHERE split_name = 'valid' GROUP BY p",
    "summed": "SELECT p, n, row_number() OVER w AS k, sum(pos) OVER w AS pos, sum(n) OVER w AS upto,"
    " sum(pos) OVER w - pos AS pos0, sum(n) OVER w - n AS upto0 FROM tied WINDOW w AS (ORDER BY p)",
    "means": "SELECT i.k AS i, j.k AS j, (j.pos - i.pos0) / (j.upto - i.upto0) AS mean"
    " FROM summed i JOIN summed j ON j.k >= i.k",
    "least": "SELECT i, j, min(mean) OVER (PARTITION BY i ORDER BY j ROWS BETWEEN CURRENT ROW AND"
    " UNBOUNDED FOLLOWING) AS mean FROM means",
}
ORACLE["isotonic_fit"] = sql(
    "scores",
    f"SELECT round(p, 6) AS p, n, {r6('mean', 'calibrated')} FROM summed JOIN"
    " (SELECT j, max(mean) AS mean FROM least GROUP BY j) ON j = k",
    _tied,
)
ORACLE["sigmoid_fit"] = sql(
    "scores",
    "SELECT true AS level_ok, true AS slope_ok, count(*) AS n FROM scores WHERE split_name = 'valid'",
)
ORACLE["calibrated_brier"] = sql(
    "feat",
    f"SELECT {_split.format('valid', '')} AS n, true AS isotonic_below_none, true AS isotonic_below_sigmoid",
)
ORACLE["model_scoring"] = sql(
    "served",
    f"SELECT '20260102T000000Z' AS model_version, {len(FEATURES)} AS inputs, 0.25e0 AS threshold,"
    " count(*) AS scored, count(*) AS probabilities FROM served",
)
ORACLE["pipeline_run"] = sql(
    "feat",
    f"SELECT flavor, {len(FEATURES)} AS inputs, {_split.format('train', '')} AS train,"
    f" {_split.format('valid', '')} AS valid, {_split.format('test', '')} AS test,"
    f" {_split.format('test', '')} AS decided, {_split.format('test', '')} AS calibrated,"
    f" (SELECT count(DISTINCT sex) FROM feat WHERE split_name = 'test') AS groups,"
    f" CAST({len(RATIOS)} AS BIGINT) AS ratios, true AS metrics_stored"
    " FROM (SELECT unnest(['trees', 'network']) AS flavor)",
)
