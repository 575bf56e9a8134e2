"""The independent SQL side: named common table expressions over the benchmark tables."""

from __future__ import annotations

DAY = "86400e6"


def _late(name, keys, days, min_n, table="requests"):
    """A late rate per request id, as a window over decided outcomes and requests together."""
    key = "||'|'||".join(f"coalesce({k},'__na__')" for k in keys)
    return f"""
    SELECT id, CASE WHEN n >= {min_n} THEN s / n END AS {name} FROM (
      SELECT id, coalesce(sum(n) OVER w, 0) AS n, coalesce(sum(s) OVER w, 0)::DOUBLE AS s FROM (
        SELECT {key} AS k, deadline AS t, 1 AS n, late AS s, NULL AS id FROM history
        UNION ALL
        SELECT {key}, requested_date, 0, 0, service_request_id FROM {table}
      ) WINDOW w AS (PARTITION BY k ORDER BY t
          RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    ) WHERE id IS NOT NULL"""


def rolling(key, days, table="requests", source="requests", closed="left"):
    """Requests of the same key in the window before each row of ``table``."""
    lo, hi = (
        (f"INTERVAL {days} DAYS PRECEDING", "INTERVAL 1 MICROSECOND PRECEDING")
        if closed == "left"
        else (f"INTERVAL '{days * 86400 * 1000000 - 1} microseconds' PRECEDING", "CURRENT ROW")
    )
    return f"""
    SELECT id, n FROM (
      SELECT id, coalesce(sum(n) OVER w, 0)::BIGINT AS n FROM (
        SELECT coalesce({key},'__na__') AS k, requested_date AS t, 1 AS n, NULL AS id FROM {source}
        UNION ALL
        SELECT coalesce({key},'__na__'), requested_date, 0, service_request_id FROM {table}
      ) WINDOW w AS (PARTITION BY k ORDER BY t RANGE BETWEEN {lo} AND {hi})
    ) WHERE id IS NOT NULL"""


LATE = {
    "cat_late_90d": (("service_name",), 90, 20),
    "comm_late_90d": (("comm_name",), 90, 20),
    "sector_late_90d": (("sector",), 90, 20),
    "cat_sector_late_90d": (("service_name", "sector"), 90, 10),
    "comm_cat_late_180d": (("service_name", "comm_name"), 180, 5),
}

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "closed_by": (
        (),
        """SELECT o_orderkey AS k, min(l_shipdate) AS closed FROM orders
        JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate GROUP BY 1""",
    ),
    "requests": (
        ("closed_by",),
        """SELECT CAST(o_orderkey AS VARCHAR) AS service_request_id, o_orderdate AS requested_date,
        CASE WHEN o_orderkey % 1500 <> 3 THEN o_orderpriority || ' - ' || c_mktsegment END AS service_name,
        c_mktsegment AS agency_responsible, CAST(c_nationkey AS VARCHAR) AS comm_code,
        n_name AS comm_name, o_orderstatus AS source,
        CAST(o_orderkey % 360 - 180 AS DOUBLE) AS longitude,
        CAST(o_orderkey % 180 - 90 AS DOUBLE) AS latitude,
        o_orderdate + INTERVAL 1 DAY AS updated_date, closed AS closed_date,
        CASE WHEN closed IS NULL THEN 'Open' ELSE 'Closed' END AS status_description,
        o_orderpriority AS location_type
        FROM orders LEFT JOIN closed_by ON k = o_orderkey
        LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "aged": (
        ("requests",),
        f"SELECT *, (epoch_us(closed_date) - epoch_us(requested_date)) / {DAY} AS days FROM requests",
    ),
    "comms": (
        (),
        """SELECT CAST(n_nationkey AS VARCHAR) AS comm_code, n_name AS name, r_name AS sector,
        'C' || CAST(n_nationkey % 3 AS VARCHAR) AS srg
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 6""",
    ),
    "holidays": (
        ("requests",),
        """SELECT DISTINCT unnest([make_date(y, 1, 1), make_date(y, 7, 1), make_date(y, 12, 25)]) AS holiday
        FROM (SELECT DISTINCT year(requested_date) AS y FROM requests)""",
    ),
    "lim": (
        ("aged",),
        """SELECT service_name, greatest(quantile_cont(days, 0.5::DOUBLE) * 1.5, 120.0::DOUBLE) AS lim
        FROM aged WHERE days >= 0 GROUP BY 1""",
    ),
    "stale": (
        ("aged", "lim"),
        "SELECT a.*, closed_date::DATE AS day FROM aged a JOIN lim USING (service_name) WHERE days >= lim",
    ),
    "pdays": (
        ("stale",),
        "SELECT service_name, day, count(*) AS tickets FROM stale GROUP BY 1, 2 HAVING count(*) >= 2",
    ),
    "marked": (
        ("aged", "lim", "pdays"),
        """SELECT a.*, coalesce(a.days >= l.lim AND p.tickets IS NOT NULL, false) AS purge_closed
        FROM aged a LEFT JOIN lim l USING (service_name)
        LEFT JOIN pdays p ON p.service_name = a.service_name AND p.day = a.closed_date::DATE""",
    ),
    "bounds": (
        ("requests",),
        """SELECT max(requested_date) AS newest, max(requested_date) - INTERVAL 1 YEAR AS boundary,
        max(requested_date) - INTERVAL 5 YEAR AS cutoff,
        date_trunc('day', max(requested_date)) + INTERVAL 1 DAY AS taken FROM requests""",
    ),
    "subset": (
        ("marked", "bounds"),
        "SELECT marked.* FROM marked, bounds WHERE days >= 0 AND requested_date >= cutoff",
    ),
    "clean_train": (
        ("subset", "bounds"),
        "SELECT subset.* FROM subset, bounds WHERE requested_date < boundary AND NOT purge_closed",
    ),
    "thr": (
        ("clean_train",),
        "SELECT service_name, quantile_cont(days, 0.75::DOUBLE) AS t FROM clean_train WHERE service_name IS NOT NULL GROUP BY 1",
    ),
    "gthr": (("clean_train",), "SELECT quantile_cont(days, 0.75::DOUBLE) AS g FROM clean_train"),
    "overdue": (
        ("marked", "thr", "gthr", "bounds"),
        f"""SELECT m.*, coalesce(t, g) AS threshold_days FROM marked m LEFT JOIN thr USING (service_name), gthr, bounds
        WHERE closed_date IS NULL AND requested_date >= cutoff
        AND requested_date + to_microseconds(CAST(round(coalesce(t, g) * {DAY}) AS BIGINT)) < taken""",
    ),
    "labels": (
        ("subset", "thr", "gthr", "bounds", "overdue"),
        """SELECT *, CASE WHEN requested_date < boundary THEN 'train' ELSE 'test' END AS split FROM (
        SELECT s.*, coalesce(t, g) AS threshold_days, CAST(days > coalesce(t, g) AS INT) AS breach,
        false AS censored FROM subset s LEFT JOIN thr USING (service_name), gthr
        UNION ALL BY NAME
        SELECT *, 1 AS breach, true AS censored FROM overdue), bounds""",
    ),
    "known_days": (
        ("aged",),
        "SELECT * FROM aged WHERE days >= 0 AND service_name <> '5-LOW - MACHINERY'",
    ),
    "bthr": (
        ("known_days",),
        "SELECT service_name, quantile_cont(days, 0.75::DOUBLE) AS t FROM known_days GROUP BY 1",
    ),
    "bg": (("known_days",), "SELECT quantile_cont(days, 0.75::DOUBLE) AS g FROM known_days"),
    "history": (
        ("requests", "bthr", "comms"),
        """SELECT service_name, comm_name, sector, deadline,
        CAST(closed_date IS NULL OR closed_date > deadline AS INT) AS late FROM (
          SELECT r.*, coalesce(c.sector, 'UNKNOWN') AS sector,
          requested_date + to_seconds(CAST(floor(t * 86400) AS BIGINT)) AS deadline
          FROM requests r JOIN bthr USING (service_name) LEFT JOIN comms c USING (comm_code))""",
    ),
    "placed": (
        ("requests", "comms"),
        """SELECT r.*, coalesce(c.sector, 'UNKNOWN') AS sector, coalesce(c.srg, 'UNKNOWN') AS srg
        FROM requests r LEFT JOIN comms c USING (comm_code)""",
    ),
    "runs": (
        (),
        """SELECT * FROM (VALUES ('1999-01-01', TIMESTAMP '1999-01-01'),
        ('2000-01-01', TIMESTAMP '2000-01-01')) v(run, moment)""",
    ),
    "open_at": (
        ("placed", "bthr", "bg", "runs"),
        f"""SELECT * FROM (SELECT p.*, run, moment, coalesce(t, g) AS threshold_days, t IS NOT NULL AS category_seen,
        requested_date + to_microseconds(CAST(round(coalesce(t, g) * {DAY}) AS BIGINT)) AS deadline,
        (CAST(service_request_id AS BIGINT) * 7919 % 10007) / 10007e0 AS score
        FROM placed p LEFT JOIN bthr USING (service_name), bg, runs
        WHERE requested_date <= moment AND (closed_date IS NULL OR closed_date > moment)) WHERE deadline >= moment""",
    ),
    "cuts": (
        ("open_at",),
        "SELECT run, sector, quantile_cont(score, 0.9::DOUBLE) AS cut FROM open_at GROUP BY 1, 2",
    ),
    "scores": (
        ("open_at", "cuts"),
        """SELECT 'shadow-not-for-use' AS usage, o.*, score >= cut AS flagged,
        row_number() OVER (PARTITION BY o.run, o.sector
          ORDER BY score DESC, md5(service_request_id), service_request_id) AS rank_in_sector
        FROM open_at o JOIN cuts USING (run, sector)""",
    ),
    "outcomes": (
        ("scores", "bounds"),
        """SELECT s.* EXCLUDE (run, moment), run AS scored_asof, b.taken AS outcome_snapshot,
        CASE WHEN closed_date IS NOT NULL AND closed_date <= deadline THEN 'on_time'
        WHEN closed_date IS NOT NULL THEN 'late' WHEN b.taken > deadline THEN 'late'
        ELSE 'undecided' END AS outcome FROM scores s, bounds b""",
    ),
    "first_score": (
        ("outcomes",),
        """SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY service_request_id
        ORDER BY scored_asof) AS rn FROM outcomes) WHERE rn = 1""",
    ),
    "cohort": (("first_score",), "SELECT * FROM first_score WHERE deadline < outcome_snapshot"),
    "judged": (
        ("placed", "bthr", "bg"),
        """SELECT p.*, (CAST(service_request_id AS BIGINT) * 7919 % 10007) / 10007e0 AS pred,
        CAST(closed_date IS NULL OR date_diff('day', requested_date, closed_date) > coalesce(t, g) AS INT) AS breach
        FROM placed p LEFT JOIN bthr USING (service_name), bg""",
    ),
    "flag_cuts": (
        ("judged",),
        "SELECT sector, quantile_cont(pred, 0.9::DOUBLE) AS cut FROM judged GROUP BY 1",
    ),
    "flagged": (
        ("judged", "flag_cuts"),
        "SELECT j.*, pred >= cut AS flagged FROM judged j JOIN flag_cuts USING (sector)",
    ),
    "settled": (
        ("labels", "comms", "bounds"),
        f"""SELECT l.*, coalesce(c.sector, 'UNKNOWN') AS sector,
        date_trunc('month', requested_date)::DATE AS month, isodow(requested_date) - 1 AS dow
        FROM labels l LEFT JOIN comms c USING (comm_code)
        WHERE requested_date + to_microseconds(CAST(round(threshold_days * {DAY}) AS BIGINT)) < l.taken""",
    ),
    "pending": (
        ("requests", "thr", "gthr", "bounds"),
        f"""SELECT date_trunc('month', requested_date)::DATE AS month,
        avg(CASE WHEN requested_date + to_microseconds(CAST(round(coalesce(t, g) * {DAY}) AS BIGINT)) >= taken
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pending
        FROM requests LEFT JOIN thr USING (service_name), gthr, bounds GROUP BY 1""",
    ),
    "city": (
        ("settled",),
        """SELECT month, 'city_late_mix_fixed' AS series, '' AS key, sum(r * w) / sum(w) AS value,
        any_value(a.n) AS n FROM
        (SELECT month, service_name, avg(breach) AS r FROM settled GROUP BY 1, 2)
        JOIN (SELECT service_name, count(*) AS w FROM settled GROUP BY 1) USING (service_name)
        JOIN (SELECT month, count(*) AS n FROM settled GROUP BY 1) a USING (month) GROUP BY 1""",
    ),
    "sector_oe": (
        ("settled",),
        """SELECT month, 'sector_obs_expected' AS series, sector AS key,
        avg(breach) / nullif(avg(e), 0) AS value, count(*) AS n FROM
        (SELECT *, CASE WHEN service_name IS NOT NULL THEN avg(breach) OVER (PARTITION BY month, service_name) END AS e FROM settled)
        WHERE sector <> 'UNKNOWN' GROUP BY 1, 3""",
    ),
    "segment": (
        ("settled",),
        """SELECT month, 'waste_east_late' AS series, 'AMERICA' AS key, avg(breach) AS value,
        count(*) AS n FROM settled WHERE service_name = '1-URGENT - BUILDING' AND sector = 'AMERICA' GROUP BY 1""",
    ),
    "weekend": (
        ("settled",),
        """SELECT month, 'fri_sat_vs_mon_thu' AS series, '' AS key,
        (avg(breach) FILTER (dow IN (4, 5)) / nullif(avg(e) FILTER (dow IN (4, 5)), 0))
        / nullif(avg(breach) FILTER (dow < 4) / nullif(avg(e) FILTER (dow < 4), 0), 0) AS value,
        count(*) FILTER (dow IN (4, 5)) AS n FROM
        (SELECT *, CASE WHEN service_name IS NOT NULL THEN avg(breach) OVER (PARTITION BY service_name, sector) END AS e FROM settled)
        GROUP BY 1 HAVING count(*) FILTER (dow IN (4, 5)) > 0 AND count(*) FILTER (dow < 4) > 0""",
    ),
    "windows": (
        ("requests", "bounds"),
        """SELECT unnest(generate_series(
          (SELECT date_trunc('month', min(requested_date)) + INTERVAL 11 MONTH FROM requests),
          (SELECT date_trunc('month', taken) - INTERVAL 1 MONTH FROM bounds), INTERVAL 1 MONTH))::DATE AS w""",
    ),
    "slow": (
        ("marked", "windows"),
        """SELECT w AS month, 'slowest5_share' AS series, '' AS key,
        coalesce(sum(days) FILTER (rn <= floor(c * 0.05::DOUBLE)), 0) / sum(days) AS value, count(*) AS n FROM
        (SELECT w, days, row_number() OVER (PARTITION BY w ORDER BY days DESC) AS rn,
          count(*) OVER (PARTITION BY w) AS c FROM windows JOIN marked
          ON date_trunc('month', requested_date) BETWEEN w - INTERVAL 11 MONTH AND w
          WHERE days >= 0 AND NOT purge_closed) GROUP BY 1 HAVING sum(days) > 0""",
    ),
    "slow_pending": (
        ("requests", "windows"),
        """SELECT w AS month, avg(CASE WHEN closed_date IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pending
        FROM windows JOIN requests ON date_trunc('month', requested_date) BETWEEN w - INTERVAL 11 MONTH AND w
        GROUP BY 1""",
    ),
    "card": (
        ("city", "sector_oe", "segment", "weekend", "pending", "slow", "slow_pending"),
        """SELECT c.*, coalesce(pending, 1.0) > 0.06::DOUBLE AS provisional FROM
        (SELECT * FROM city UNION ALL BY NAME SELECT * FROM sector_oe UNION ALL BY NAME
        SELECT * FROM segment UNION ALL BY NAME SELECT * FROM weekend) c LEFT JOIN pending USING (month)
        UNION ALL BY NAME
        SELECT s.*, coalesce(pending, 1.0) > 0.02::DOUBLE AS provisional FROM slow s LEFT JOIN slow_pending USING (month)""",
    ),
    # the EWMA recursion over an ordered series (series, key, i, month, x)
    "residuals": (
        ("card",),
        """SELECT *, value - avg(value) OVER (PARTITION BY series, key, month(month) ORDER BY year(month)
        RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS residual FROM card WHERE NOT provisional""",
    ),
    "points": (
        ("residuals",),
        """SELECT series, key, month, residual AS x,
        row_number() OVER (PARTITION BY series, key ORDER BY month) AS i
        FROM residuals WHERE residual IS NOT NULL""",
    ),
    "control": (
        ("points",),
        """SELECT series, key, avg(x) FILTER (i <= 10) AS mu, stddev_samp(x) FILTER (i <= 10) AS sigma
        FROM points GROUP BY 1, 2 HAVING count(*) >= 10 AND stddev_samp(x) FILTER (i <= 10) > 0""",
    ),
    # the recursion unrolled: z_t = (1-w)^t mu + sum over s <= t of w (1-w)^(t-s) x_s
    "ewma": (
        ("points", "control"),
        """SELECT p.series, p.key, p.month, abs(any_value(mu) * pow(0.7, p.i)
          + sum(0.3 * pow(0.7, p.i - q.i) * q.x) - any_value(mu))
          > 0.5 * any_value(sigma) * sqrt(0.3 / 1.7 * (1 - pow(0.7, 2 * p.i))) AS out
        FROM points p JOIN points q ON q.series = p.series AND q.key = p.key AND q.i <= p.i
        JOIN control c ON c.series = p.series AND c.key = p.key
        GROUP BY p.series, p.key, p.month, p.i""",
    ),
    "ewma_rows": (
        ("residuals", "ewma"),
        "SELECT r.*, coalesce(out, false) AS out FROM residuals r LEFT JOIN ewma USING (series, key, month)",
    ),
    "runs_of": (
        ("ewma_rows",),
        """SELECT *, out AND count(*) OVER (PARTITION BY series, key, block) >= 3 AS flag FROM (
          SELECT *, sum(turn) OVER (PARTITION BY series, key ORDER BY month) AS block FROM (
            SELECT *, CAST(out IS DISTINCT FROM lag(out) OVER (PARTITION BY series, key ORDER BY month) AS INT) AS turn
            FROM ewma_rows))""",
    ),
    "jobs": (
        (),
        """SELECT event_id AS job_id, event_type AS kind, ts AS created, value AS billed_seconds,
        CASE WHEN event_id % 50 = 0 THEN 'Failed' ELSE 'Completed' END AS status,
        CASE WHEN event_id % 3 = 0 THEN 'ml.t3.xlarge' WHEN event_id % 3 = 1 THEN 'ml.t3.medium'
        ELSE 'unlisted' END AS instance_type FROM events""",
    ),
    "snaps": (
        (),
        """SELECT ts AS taken, max(CAST(round(value * 10000) AS BIGINT)) AS rows FROM events
        WHERE event_type = 'signup' GROUP BY 1""",
    ),
    "job_rows": (
        ("jobs", "snaps"),
        "SELECT j.*, s.rows FROM jobs j ASOF LEFT JOIN snaps s ON j.created >= s.taken",
    ),
    **{
        name: (("history", "placed"), _late(name, keys, days, min_n, "placed"))
        for name, (keys, days, min_n) in LATE.items()
    },
    "roll_cat": (("requests",), rolling("service_name", 30)),
    "roll_comm": (("requests",), rolling("comm_name", 30)),
    "roll_year": (("requests",), rolling("service_name", 365)),
    "train_recent": (
        ("labels",),
        """SELECT * FROM labels WHERE split = 'train' AND requested_date >=
        (SELECT max(requested_date) - INTERVAL 2 YEAR FROM labels WHERE split = 'train')""",
    ),
    "roll_train": (("train_recent",), rolling("service_name", 30, "train_recent", "train_recent")),
    "roll_right": (("requests",), rolling("service_name", 30, closed="right")),
    "calendar": (
        ("requests", "holidays"),
        """SELECT service_request_id AS id, month(requested_date)::BIGINT AS req_month,
        (isodow(requested_date) - 1)::BIGINT AS req_dow,
        CAST(isodow(requested_date) >= 6 AS BIGINT) AS req_is_weekend,
        CAST(date_trunc('week', requested_date)::DATE IN
          (SELECT date_trunc('week', holiday)::DATE FROM holidays) AS BIGINT) AS req_is_holiday_week
        FROM requests""",
    ),
    "matrix": (
        ("placed", "calendar", "roll_cat", "roll_comm", "roll_year", *LATE),
        """SELECT p.service_request_id, service_name, agency_responsible, comm_name, source, requested_date,
        req_month, req_dow, req_is_weekend, req_is_holiday_week, roll_cat.n AS cat_open_30d,
        roll_comm.n AS comm_req_30d,
        CASE WHEN roll_year.n >= 30 THEN roll_cat.n / greatest(roll_year.n * 30 / 365.0::DOUBLE, 1e-9) END AS cat_backlog_ratio,
        cat_late_90d, comm_late_90d, sector_late_90d, cat_sector_late_90d, comm_cat_late_180d
        FROM placed p JOIN calendar ON calendar.id = p.service_request_id
        JOIN roll_cat ON roll_cat.id = p.service_request_id
        JOIN roll_comm ON roll_comm.id = p.service_request_id
        JOIN roll_year ON roll_year.id = p.service_request_id """
        + " ".join(f"JOIN {n} ON {n}.id = p.service_request_id" for n in LATE),
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` behind the expressions it names and everything they need, in order."""
    order: list[str] = []

    def need(name):
        if name in order:
            return
        for dep in CTES[name][0]:
            need(dep)
        order.append(name)

    for name in names:
        need(name)
    if not order:
        return body
    head = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order)
    return f"WITH {head}\n{body}"
