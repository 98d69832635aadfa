"""Event-time windows, duplicates, running baselines and as-of figures over the given tables.

The streams get their rows in several loads, one run each: every run goes on from the checkpoint of
the one before, and some rows arrive after later ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.functions import half_up
from claimwright.operators import history, labels, sketches
from claimwright.operators.asof import asof_join
from claimwright.operators.intervals import overlap_counts, range_join
from claimwright.plans import quality as quality_plans
from claimwright.plans import screening as screening_plans
from claimwright.plans import tables as t
from claimwright.session import scratch_path, settle
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS
from claimwright.streaming import baselines, ingest, windows

_KEYS = "ok, ln, pk, sk"
LOADS = 4
# Every seventh event arrives six hours after its time; windows wait for twelve.
_DELAY_HOURS, _LATE, _FAR = 6, "12 hours", "10 days"


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )


def _with_load(events, arrival):
    """The load that each event arrives in: equal parts of the time that arrivals take."""
    arrived = events.withColumn("_arrival", F.unix_micros(arrival))
    bounds = arrived.agg(F.min("_arrival").alias("a"), F.max("_arrival").alias("b"))
    first, last = (bounds.select(c).scalar() for c in "ab")
    part = F.floor((F.col("_arrival") - first) * LOADS / (last - first + 1))
    return arrived.withColumn("_load", part).drop("_arrival")


def _replay(spark, rows, loads, name, start):
    """Append each load to a folder and run the stream over what is new; the folder of its results."""
    folder = scratch_path(spark, name)
    source = f"{folder}/in"
    schema = rows.drop("_load").schema
    for load in range(loads):
        rows.filter(F.col("_load") == load).drop("_load").write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, schema)
        start(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/out"


def _windows(spark, sf_dir, name, windowed):
    arrival = F.when(F.col("event_id") % 7 == 0, F.expr(f"ts + INTERVAL {_DELAY_HOURS} HOURS")).otherwise(F.col("ts"))
    events = _with_load(_events(spark, sf_dir), arrival)
    out = _replay(
        spark, events, LOADS, name, lambda s, o, c: ingest.append_stream(windowed(s), o, c, available_now=True)
    )
    found = spark.read.parquet(out)
    return found.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("window_start", "window_end")})


def _what():
    return windows.measures(F.col("event_type") == "error", F.col("value"))


def window_tumbling(spark, sf_dir):
    return _windows(
        spark, sf_dir, "tumbling", lambda s: windows.tumbling(s, "ts", "1 day", _what(), ["user_id"], late=_LATE)
    )


def window_sliding(spark, sf_dir):
    return _windows(
        spark, sf_dir, "sliding", lambda s: windows.sliding(s, "ts", "12 hours", "3 hours", _what(), late=_LATE)
    )


def window_sessions(spark, sf_dir):
    return _windows(
        spark, sf_dir, "sessions", lambda s: windows.sessions(s, "ts", "8 hours", _what(), ["user_id"], late=_LATE)
    )


def window_sessions_batch(spark, sf_dir):
    """The sessions of the whole table, by the same function."""
    found = windows.sessions(_events(spark, sf_dir), "ts", "8 hours", _what(), ["user_id"])
    return found.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("window_start", "window_end")})


def stream_first_events(spark, sf_dir):
    """Events of which some arrive again one and two loads later."""
    events = _with_load(_events(spark, sf_dir), F.col("ts"))
    again = F.when(F.col("event_id") % 15 == 0, 2).when(F.col("event_id") % 3 == 0, 1).otherwise(0)
    copies = events.select("*", F.explode(F.sequence(F.lit(0), again)).alias("copy")).withColumn(
        "_load", F.least(F.col("_load") + F.col("copy"), F.lit(LOADS - 1) + F.col("copy"))
    )
    out = _replay(
        spark,
        copies,
        LOADS + 2,
        "first-events",
        lambda s, o, c: ingest.append_stream(
            windows.first_within(s, ["event_id"], "ts", _FAR), o, c, available_now=True
        ),
    )
    return spark.read.parquet(out).select("event_id", "copy", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _running(spark, sf_dir):
    """Claims in three loads by order key; the folders of the scored batches and of the moments."""
    claims = screening_plans.labelled(spark, sf_dir).select(
        *ROW_KEYS, "provider_specialty", "billed_amount", "is_rejected", (F.col("ok") % 3).alias("_load")
    )
    store = scratch_path(spark, "moments")
    out = _replay(
        spark,
        claims,
        3,
        "running",
        lambda s, o, c: baselines.running_baselines(s, store, o, c, available_now=True),
    )
    return out, store


def running_baselines(spark, sf_dir):
    """The baselines after the last batch."""
    _, store = _running(spark, sf_dir)
    table = baselines.baselines(baselines.stored_moments(spark, store))
    return table.select(
        "provider_specialty",
        F.col("level").cast("int").alias("level"),
        "claims",
        half_up(F.col("amount_mean"), 4).alias("amount_mean"),
        half_up(F.col("amount_std"), 4).alias("amount_std"),
        half_up(F.col("rejection_rate"), 6).alias("rejection_rate"),
    )


def running_scores(spark, sf_dir):
    """Each batch scored with the baselines of the batches before it."""
    out, _ = _running(spark, sf_dir)
    return spark.read.parquet(out).select(
        *ROW_KEYS,
        half_up(F.col("billed_amount_zscore"), 6).alias("billed_amount_zscore"),
        half_up(F.col("provider_specialty_risk"), 6).alias("provider_specialty_risk"),
    )


def provider_figures_asof(spark, sf_dir):
    """Each claim with its provider's latest monthly figure that was known on the day of service."""
    claims = derived.medical_claims(spark, sf_dir).select(*ROW_KEYS, "provider_id", "service_date")
    months = history.provider_monthly_trend(claims).select(
        "provider_id",
        F.add_months("month", 1).alias("known_from"),
        F.col("month").alias("figure_month"),
        F.col("claims").alias("figure_claims"),
    )
    joined = asof_join(
        claims, months, ["provider_id"], "service_date", "known_from", ["figure_month", "figure_claims"]
    )
    return joined.select(*ROW_KEYS, "figure_month", "figure_claims")


def stream_removals(spark, sf_dir):
    """Removal counts of three loads, added up."""
    claims = quality_plans.dirty_claims(spark, sf_dir).withColumn("_load", F.col("ok") % 3)
    counts = scratch_path(spark, "removals")
    _replay(
        spark, claims, 3, "counted", lambda s, o, c: ingest.ingest_counted(s, o, counts, c, available_now=True)
    )
    found = spark.read.parquet(counts).drop("batch")
    return found.agg(*[F.sum(n).alias(n) for n in found.columns])


def daily_sketches(spark, sf_dir):
    """Patients and providers per specialty from sketches per day, against the exact numbers."""
    columns = ["patient_id", "provider_id"]
    claims = derived.medical_claims(spark, sf_dir).withColumn("day", F.col("service_date").cast("date"))
    daily = settle(sketches.distinct_sketches(claims, ["provider_specialty", "day"], columns), "sketches")
    merged = sketches.distinct_estimates(
        sketches.merged_sketches(daily, ["provider_specialty"], columns), columns
    )
    exact = [
        claims.select("provider_specialty", c).distinct().groupBy("provider_specialty").agg(F.count(c).alias(f"_{c}"))
        for c in columns
    ]
    near = [F.abs(F.col(c) - F.col(f"_{c}")) <= 0.03 * F.col(f"_{c}") + 1 for c in columns]
    days = daily.groupBy("provider_specialty").agg(F.count("day").alias("days"))
    joined = merged.join(exact[0], "provider_specialty").join(exact[1], "provider_specialty").join(days, "provider_specialty")
    return joined.select(
        "provider_specialty", F.col("rows").alias("claims"), "days", (near[0] & near[1]).alias("within_three_percent")
    )


def _open_claims(spark, sf_dir):
    """From the service to the submission of a claim."""
    return labels.with_timing(derived.medical_claims(spark, sf_dir)).select(
        *ROW_KEYS, "provider_id", "service_date", F.col("submission_date").cast("timestamp_ntz").alias("submission_date")
    )


def overlapping_claims(spark, sf_dir):
    """Open claims of the same provider that overlap a claim, without itself."""
    claims = _open_claims(spark, sf_dir)
    counted = overlap_counts(claims, claims, ["provider_id"], "service_date", "submission_date")
    own = (F.col("service_date") < F.col("submission_date")).cast("long")
    return counted.select(*ROW_KEYS, (F.col("overlaps") - own).alias("overlaps"))


def claims_in_busy_months(spark, sf_dir):
    """Claims that were submitted in a month of which the provider had at least three claims."""
    claims = _open_claims(spark, sf_dir)
    months = history.provider_monthly_trend(claims.select("provider_id", "service_date")).filter("claims >= 3")
    busy = months.select(
        "provider_id",
        F.col("month").cast("timestamp_ntz").alias("busy_from"),
        F.add_months("month", 1).cast("timestamp_ntz").alias("busy_to"),
        F.col("claims").alias("busy_claims"),
    )
    joined = range_join(claims, busy, ["provider_id"], "submission_date", "busy_from", "busy_to", 30 * 86_400)
    return joined.select(*ROW_KEYS, "busy_from", "busy_claims")


_MEASURES = (
    f"count(*) AS rows, {t.count_if(chr(39).join(['event_type = ', 'error', '']))} AS flagged, "
    f"{t.flag_mean(chr(39).join(['event_type = ', 'error', '']))} AS rate, {t.exact_sum('value')} AS total"
)
_CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 12 HOURS FROM events)"
_SESSIONS = (
    "SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOURS AS window_end, "
    f"{_MEASURES} FROM (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) AS session FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) > INTERVAL 8 HOURS, true) AS fresh FROM events)) GROUP BY user_id, session"
)
_SPAN = 3 * 3600 * 10**6
_STATS = (
    "SELECT {group}, count(*) AS claims, " + t.exact_mean("billed_amount") + " AS m, stddev_samp(billed_amount) AS d, "
    + t.flag_mean("is_rejected")
    + " AS rate FROM mc"
)

QUERIES = {
    "window_tumbling": (
        window_tumbling,
        "SELECT * FROM (SELECT user_id, date_trunc('day', ts) AS window_start, "
        f"date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, {_MEASURES} FROM events GROUP BY ALL) "
        f"WHERE {_CLOSED}",
    ),
    "window_sliding": (
        window_sliding,
        f"SELECT * FROM (SELECT window_start, window_start + INTERVAL 12 HOURS AS window_end, {_MEASURES} FROM ("
        f"SELECT *, make_timestamp((epoch_us(ts) // {_SPAN} - k) * {_SPAN}) AS window_start "
        f"FROM events, range(0, 4) AS steps(k)) GROUP BY ALL) WHERE {_CLOSED}",
    ),
    "window_sessions": (window_sessions, f"SELECT * FROM ({_SESSIONS}) WHERE {_CLOSED}"),
    "window_sessions_batch": (window_sessions_batch, _SESSIONS),
    "stream_first_events": (stream_first_events, "SELECT event_id, 0 AS copy, ts FROM events"),
    "running_baselines": (
        running_baselines,
        t.over(
            "mc",
            f"SELECT provider_specialty, level, claims, {t.half_up('m', 4)} AS amount_mean, "
            f"{t.half_up('d', 4)} AS amount_std, {t.half_up('rate', 6)} AS rejection_rate FROM ("
            + _STATS.format(group="provider_specialty, 0 AS level")
            + " GROUP BY 1 UNION ALL "
            + _STATS.format(group="NULL, 1")
            + ")",
        ),
    ),
    "running_scores": (
        running_scores,
        t.over(
            "mc",
            f"SELECT {_KEYS}, {t.half_up('(billed_amount - m) / nullif(d, 0e0)', 6)} AS billed_amount_zscore, "
            f"{t.half_up('rate', 6)} AS provider_specialty_risk FROM mc LEFT JOIN ("
            + " UNION ALL ".join(
                f"SELECT {n} AS load, avg(billed_amount) AS m, stddev_samp(billed_amount) AS d FROM mc WHERE ok % 3 < {n}"
                for n in (1, 2)
            )
            + ") s ON s.load = ok % 3 LEFT JOIN ("
            + " UNION ALL ".join(
                f"SELECT {n} AS upto, provider_specialty AS ps, {t.flag_mean('is_rejected')} AS rate FROM mc "
                f"WHERE ok % 3 < {n} GROUP BY 2"
                for n in (1, 2)
            )
            + ") r ON r.upto = ok % 3 AND r.ps = provider_specialty",
        ),
    ),
    "provider_figures_asof": (
        provider_figures_asof,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, month AS figure_month, claims AS figure_claims FROM mc0 ASOF LEFT JOIN ("
            "SELECT provider_id AS p, CAST(date_trunc('month', service_date) AS DATE) AS month, "
            "CAST(date_trunc('month', service_date) + INTERVAL 1 MONTH AS TIMESTAMP) AS known_from, count(*) AS claims "
            "FROM mc0 GROUP BY ALL) m ON m.p = provider_id AND service_date >= known_from",
        ),
    ),
    "overlapping_claims": (
        overlapping_claims,
        t.over(
            "mc1",
            f"SELECT {_KEYS}, CASE WHEN service_date < submission_date THEN (SELECT count(*) FROM mc1 o "
            "WHERE o.provider_id = m.provider_id AND o.service_date < m.submission_date "
            "AND o.submission_date > m.service_date AND o.service_date < o.submission_date) - 1 ELSE 0 END AS overlaps FROM mc1 m",
        ),
    ),
    "claims_in_busy_months": (
        claims_in_busy_months,
        t.over(
            "mc1",
            f"SELECT {_KEYS}, busy_from, busy_claims FROM mc1 JOIN (SELECT provider_id AS p, "
            "CAST(date_trunc('month', service_date) AS TIMESTAMP) AS busy_from, count(*) AS busy_claims FROM mc1 "
            "GROUP BY ALL HAVING count(*) >= 3) b ON b.p = provider_id AND submission_date >= busy_from "
            "AND submission_date < busy_from + INTERVAL 1 MONTH",
        ),
    ),
    "stream_removals": (stream_removals, quality_plans.QUERIES["claim_removals"][1]),
    "daily_sketches": (
        daily_sketches,
        t.over(
            "mc0",
            "SELECT provider_specialty, count(*) AS claims, count(DISTINCT CAST(service_date AS DATE)) AS days, "
            "true AS within_three_percent FROM mc0 GROUP BY 1",
        ),
    ),
}
