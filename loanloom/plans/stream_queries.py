"""The event table replayed as a stream; each result is compared with SQL over the closed windows."""

from pyspark.sql import functions as F

from loanloom.operators.binning import left_closed_bin, quantile_edges
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import edges_sql, left_bin, r6
from loanloom.sources.tables import table
from loanloom.streaming import monitors

CLOSED = "cl AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE AS wm FROM events)"


def hops(size: str, slide: str) -> str:
    """Start of every hopping window that holds the event; windows are aligned to 1970-01-01."""
    n = f"({size} // {slide})"
    return f"unnest(list_transform(range({n}), lambda i: (floor(epoch(ts))::BIGINT // {slide} - i) * {slide}))"


@query("stream_hopping_counts", f"""
WITH cl AS (SELECT date_trunc('second', max(ts)) - INTERVAL 10 MINUTE AS wm FROM events),
s AS (SELECT DISTINCT (props->>'$.k')::BIGINT AS device_id, date_trunc('second', ts) AS ts FROM events),
w AS (SELECT device_id, {hops('3600', '300')}::BIGINT AS start FROM s)
SELECT device_id, start, count(*) AS n_seconds FROM w, cl WHERE make_timestamp((start + 3600) * 1000000) <= wm GROUP BY 1, 2""")
def stream_hopping_counts(spark, folder):
    out = monitors.run_available(monitors.hopping_counts(monitors.read_events(spark, folder, "events.parquet"), "device_id"), "hopping")
    return out.select("device_id", F.unix_seconds("window.start").alias("start"), "n_seconds")


@query("stream_rolling_bad_rate", f"""
WITH {CLOSED}, w AS (SELECT event_type = 'error' AS bad, {hops('604800', '86400')}::BIGINT AS start FROM events)
SELECT start, {r6('avg(bad::INT)')} AS rate, count(*) AS n FROM w, cl WHERE make_timestamp((start + 604800) * 1000000) <= wm GROUP BY 1""")
def stream_rolling_bad_rate(spark, folder):
    events = monitors.read_events(spark, folder, "events.parquet")
    out = monitors.run_available(monitors.rolling_bad_rate(events, F.col("event_type") == "error"), "rolling")
    return out.select(F.unix_seconds("window.start").alias("start"), F.round("rate", 6).alias("rate"), "n")


@query("stream_trailing_counts", """
WITH s AS (SELECT DISTINCT (props->>'$.k')::BIGINT AS entity, floor(epoch(ts))::BIGINT AS second FROM events)
SELECT entity, second, count(*) OVER (PARTITION BY entity ORDER BY second RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS n_recent FROM s""")
def stream_trailing_counts(spark, folder):
    files = monitors.replay(table(spark, folder, "events"), "ts", "replay", slices=5, jitter_seconds=300, quiet="2 hours")
    events = monitors.read_events(spark, files, "*.parquet", files_per_batch=1)
    return monitors.run_available(monitors.exact_trailing_counts(events, "device_id"), "trailing", monitors.ROCKS)


@query("stream_daily_psi", f"""
WITH {CLOSED}, base AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'), e AS {edges_sql('value', 'base')},
open AS (SELECT ts, CASE WHEN value < e[1] THEN 1 WHEN value > e[len(e)] THEN (len(e) - 1)::INT ELSE {left_bin('value')} END AS bin FROM events, e),
s AS (SELECT bin, count(*) / sum(count(*)) OVER () + 1e-6 AS was FROM open WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
d AS (SELECT ts::DATE AS day, count(*) AS t FROM events GROUP BY 1), n AS (SELECT ts::DATE AS day, bin, count(*) AS n FROM open GROUP BY 1, 2),
g AS (SELECT d.day, coalesce(n / t, 0) + 1e-6 AS now, was FROM d JOIN s ON true LEFT JOIN n ON n.day = d.day AND n.bin = s.bin)
SELECT strftime(day, '%Y-%m-%d') AS day, {r6('sum((now - was) * ln(now / was))')} AS psi,
  CASE WHEN sum((now - was) * ln(now / was)) > 0.1 THEN 'ALERT' ELSE 'OK' END AS status FROM g, cl WHERE day + INTERVAL 1 DAY <= wm GROUP BY 1""")
def stream_daily_psi(spark, folder):
    past = table(spark, folder, "events").where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    edges = quantile_edges(past, ["value"], 10)["value"]
    counts = past.groupBy(left_closed_bin("value", edges, open_ends=True).alias("bin")).agg(F.count("*").alias("n")).collect()
    whole = sum(r["n"] for r in counts)
    from loanloom.operators.profiling import small_frame

    baseline = small_frame(spark, [{"bin": r["bin"], "share": r["n"] / whole} for r in counts], "bin int, share double")
    out = monitors.watch_daily(monitors.read_events(spark, folder, "events.parquet"), "value", baseline, edges, "daily-psi")
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("psi", 6).alias("psi"), "status")
