"""Serving views on hand-made stored tables: empty tables, ties, thresholds, FK checks."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import alerts, monitoring, replies, views

PROC_SCHEMA = ("id long, original_text string, cleaned_text string, hashed_user_id string, "
               "predicted_label string, confidence double, is_duplicate boolean, "
               "is_near_duplicate boolean, reply_text string, created_at timestamp_ntz, "
               "updated_at timestamp_ntz")


def _proc(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = []
    for i, (label, conf, dup, near, secs) in enumerate(rows, start=1):
        ts = t0 + dt.timedelta(seconds=secs)
        data.append((i, f"m{i}", f"m{i}", "h" * 64, label, conf, dup, near, None, ts, ts))
    df = spark.createDataFrame(data, PROC_SCHEMA)
    return df.withColumn("reply_text", replies.reply_text(F.col("predicted_label"), F.col("confidence")))


def test_empty_table(spark):
    p = _proc(spark, [])
    s = views.duplicate_summary(p).first()
    assert s.exact_duplicates is None and s.near_duplicates is None and s.total_rows == 0
    zf = {r.label: r.label_count for r in views.label_zero_fill(p).collect()}
    assert zf == {"Inquiry": 0, "Complaint": 0, "Praise": 0}
    assert views.top_category(p).first().top_category == "N/A"
    o = replies.build_outbox(p)
    m = monitoring.batch_metrics(p.withColumn("epoch", F.lit(0)))
    k = views.kpi_counts(p, o, m).first()
    assert (k.processed_messages, k.replies_queued, k.metrics_logged) == (0, 0, 0)
    assert m.count() == 0
    assert views.complaint_spike(p).first()[0] == 0


def test_spike_window_ties_and_thresholds(spark):
    rows = [("complaint", 0.9, False, False, 0)] * 6 + [("praise", 0.79, True, False, 5)] * 20 \
        + [("complaint", 0.8, False, True, 10)] * 5 + [(None, 0.81, True, True, 10)]
    p = _proc(spark, rows)
    # newest 20: 6 rows at t=10 (5 complaints, ids 27..32) then 14 praise rows at t=5.
    assert views.complaint_spike(p).first()[0] == 5
    assert alerts.spike_alert(p).first().status == "ALERT"
    assert alerts.complaint_status(p).first().complaint_status == "ALERT TRIGGERED"
    dist = {r.label: r.label_count for r in views.label_distribution(p).collect()}
    assert dist == {"Complaint": 11, "Praise": 20, "Unknown": 1}
    assert views.top_category(p).first().top_category == "Praise"
    route = {r.id: r.route for r in replies.reply_route(p).collect()}
    assert route[1] == "template" and route[7] == "fallback" and route[27] == "fallback"
    assert route[32] == "fallback"  # unknown label
    low = {r.id: r.is_low_confidence for r in replies.reply_route(p).collect()}
    assert low[7] and not low[27]  # 0.79 counts as low, 0.8 does not
    recent = [r.id for r in views.recent_processed(p).collect()]
    assert recent[:6] == [32, 31, 30, 29, 28, 27] and len(recent) == 20
    status = views.recent_status(p).collect()
    assert [r.id for r in status] == list(range(32, 22, -1))


def test_fk_orphans_and_cascade(spark):
    p = _proc(spark, [("praise", 0.9, False, False, i) for i in range(5)])
    o = replies.build_outbox(p)
    kept = p.filter(F.col("id") != 3)
    assert [r.processed_id for r in views.outbox_orphans(o, kept).collect()] == [3]
    assert sorted(r.processed_id for r in views.outbox_cascade(o, kept).collect()) == [1, 2, 4, 5]


def test_histogram_and_gauge(spark):
    d = spark.createDataFrame([(0.005,), (0.2,), (3.0,), (11.0,)], "duration double")
    h = {(r.series, r.le): r.value for r in monitoring.duration_histogram(d).collect()}
    assert h[("bucket", "0.005")] == 1 and h[("bucket", "0.25")] == 2
    assert h[("bucket", "10.0")] == 3 and h[("bucket", "+Inf")] == 4
    assert h[("count", "")] == 4 and abs(h[("sum", "")] - 14.205) < 1e-9
    g = spark.createDataFrame([("acc", 0.5, 1, 1), ("acc", 0.7, 3, 2), ("acc", 0.6, 2, 3)],
                              "name string, v double, ts long, i long")
    assert monitoring.latest_gauge(g, "name", "v", "ts", "i").first().gauge_value == 0.7


def test_sql_views_registered(spark):
    from tidepool.plans import sql_views
    p = _proc(spark, [("complaint", 0.9, False, False, i) for i in range(25)]
              + [("praise", 0.5, True, True, 30)])
    o = replies.build_outbox(p)
    m = monitoring.batch_metrics(p.withColumn("epoch", F.lit(0)))
    names = sql_views.register(spark, p, o, m)
    assert set(sql_views.VIEWS) | set(sql_views.TABLES) <= set(names)
    assert spark.sql("SELECT complaint_count_last_20 FROM vw_complaint_spike").first()[0] == 19
    dup = spark.sql("SELECT * FROM vw_duplicate_summary").first()
    assert (dup.exact_duplicates, dup.near_duplicates, dup.total_rows) == (1, 1, 26)
    assert spark.sql("SELECT count(*) FROM vw_recent_processed").first()[0] == 20
    assert spark.sql("SELECT count(*) FROM vw_recent_metrics").first()[0] == 4
