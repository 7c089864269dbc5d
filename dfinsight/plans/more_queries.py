"""Registered queries, second part: sequences, scaling, learning, numeric, streams, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import instant_to_ntz, ntz_to_instant, round_to
from ..operators import learning, numeric, profile, ranking, scaling, series, sgd
from ..session import scratch_path
from ..sources import io
from ..sources.split_csv import read_csv_split
from ..streaming import streams, timed
from . import movies
from .catalog import R, RL, query, with_base, with_titles
from .sizing import materialize
from .views import LONG_TAIL_SQL, MESSY_EVENTS_SQL, TASK_LOG_SQL, long_tail, messy_events, table, task_log, titles

#: Block of a split CSV file in the queries, so that a file of a few megabytes is several.
CSV_BLOCK = 1 << 20

# ----------------------------------------------------------------------------- windows / sequences


@query("running_count_user", """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count FROM events""")
def q_running_count(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return ranking.running_count(ev, "user_id", "ts", "event_id").select("event_id", "user_id", "running_count")


@query("global_sequence_events", """
SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS seq FROM events""")
def q_global_sequence(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return ranking.global_sequence(ev, ["value", "event_id"]).select("event_id", "seq")


@query("sorted_ranges_orders", None)
def q_sorted_ranges(spark, sf):
    """O5 proof rows (partition, n_rows, min_key, max_key); bounds are sampled, so rows-only."""
    return ranking.sorted_ranges(table(spark, sf, "orders").select("o_totalprice", "o_orderkey"),
                                 "o_totalprice", 8, unique="o_orderkey")


@query("sorted_ranges_check", """
SELECT count(*) AS n_rows, min(o_totalprice) AS min_key, max(o_totalprice) AS max_key, true AS ordered FROM orders""")
def q_sorted_check(spark, sf):
    """O5 verified: all rows kept, and each partition's range starts above the previous one's end."""
    from pyspark.sql import Window
    proof = q_sorted_ranges(spark, sf)
    w = Window.orderBy("partition")
    ok = F.coalesce(F.col("min_key") >= F.lag("max_key").over(w), F.lit(True))
    return proof.withColumn("_ok", ok).agg(
        F.sum("n_rows").cast("long").alias("n_rows"), F.min("min_key").alias("min_key"),
        F.max("max_key").alias("max_key"), F.bool_and("_ok").alias("ordered"))


# ----------------------------------------------------------------------------- scaling
TL = f"WITH tl AS ({TASK_LOG_SQL})"
RUN_TIMES_SQL = TL + """,
w AS (SELECT query, n_workers, run, worker, sum(secs) AS secs FROM tl GROUP BY ALL),
r AS (SELECT query, n_workers, run, max(secs) AS secs FROM w GROUP BY ALL),
t AS (SELECT query, n_workers, count(*) AS n_runs, avg(secs) AS secs FROM r GROUP BY ALL),
b AS (SELECT *, max(CASE WHEN n_workers = 1 THEN secs END) OVER (PARTITION BY query) AS base_secs FROM t),
s AS (SELECT *, CASE WHEN base_secs IS NULL THEN NULL WHEN secs <= 0 THEN 0.0 ELSE base_secs / secs END AS speedup FROM b),
f AS (SELECT *, CASE WHEN n_workers <= 1 OR speedup IS NULL THEN NULL WHEN speedup <= 0 THEN 0.0
                ELSE (1 - 1 / speedup) / (1 - 1 / CAST(n_workers AS DOUBLE)) END AS f_raw FROM s),
g AS (SELECT *, CASE WHEN f_raw IS NULL THEN NULL ELSE greatest(0.1, least(f_raw, 0.95)) END AS f FROM f)"""


@query("run_times_tasks", RUN_TIMES_SQL + f"""
SELECT query, n_workers, n_runs, {R('secs', 4)} AS secs FROM t""")
def q_run_times(spark, sf):
    t = scaling.run_times(task_log(spark, sf))
    return t.select("query", "n_workers", "n_runs", round_to("secs", 4).alias("secs"))


REPORT_COLS = ["secs", "base_secs", "speedup", "f_raw", "f"]


@query("scaling_report_tasks", RUN_TIMES_SQL + "\nSELECT query, n_workers, n_runs, "
       + ", ".join(f"{R(c, 4)} AS {c}" for c in REPORT_COLS) + " FROM g")
def q_scaling_report(spark, sf):
    rep = scaling.scaling_report(task_log(spark, sf))
    return rep.select("query", "n_workers", "n_runs", *[round_to(c, 4).alias(c) for c in REPORT_COLS])


_STEP = (scaling.CURVE_HI - scaling.CURVE_LO) / (scaling.CURVE_POINTS - 1)


@query("amdahl_curve_tasks", RUN_TIMES_SQL + f""",
p AS (SELECT query, n_workers, f, CAST(point AS INTEGER) AS point,
        {scaling.CURVE_LO!r} + CAST(point AS DOUBLE) * {_STEP!r} AS n
      FROM g, range(0, {scaling.CURVE_POINTS}) r(point) WHERE f IS NOT NULL)
SELECT query, n_workers, point, {R('n', 6)} AS n, {R('1.0 / ((1.0 - f) + f / n)', 6)} AS predicted,
       {R('n', 6)} AS linear FROM p""")
def q_amdahl_curve(spark, sf):
    cur = scaling.amdahl_curve(scaling.scaling_report(task_log(spark, sf)))
    return cur.select("query", "n_workers", "point", round_to("n", 6).alias("n"),
                      round_to("predicted", 6).alias("predicted"), round_to("linear", 6).alias("linear"))


# ----------------------------------------------------------------------------- learning
def _shards_sql(world: int, epoch: int, seed: int = 0) -> str:
    return f"""
WITH h AS (SELECT vec_id, md5(concat('{seed}-{epoch}-', CAST(vec_id AS VARCHAR))) AS h FROM embeddings),
s AS (SELECT vec_id, row_number() OVER (ORDER BY h, vec_id) - 1 AS p FROM h),
c AS (SELECT count(*) AS n, ((count(*) + {world} - 1) // {world}) * {world} AS total FROM embeddings),
u AS (SELECT vec_id, p AS position, false AS is_padding FROM s
      UNION ALL SELECT vec_id, p + n AS position, true AS is_padding FROM s, c WHERE p < total - n)
SELECT vec_id, {epoch} AS epoch, CAST(position % {world} AS INTEGER) AS rank,
       CAST(position // {world} AS BIGINT) AS slot, CAST(position // {world * 64} AS BIGINT) AS batch,
       CAST(position AS BIGINT) AS position, is_padding FROM u"""


@query("epoch_shards_embeddings", _shards_sql(3, 1))
def q_epoch_shards(spark, sf):
    return learning.epoch_shards(table(spark, sf, "embeddings"), "vec_id", world_size=3, epoch=1)


@query("standardise_embeddings", f"""
SELECT vec_id, CAST(dim AS INTEGER) AS dim, {R('(CAST(x AS DOUBLE) - 0.1307) / 0.3081', 6)} AS value FROM (
  SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(embedding) AS x FROM embeddings) e""")
def q_standardise(spark, sf):
    st = learning.standardised(table(spark, sf, "embeddings"), "embedding", "std")
    return st.select("vec_id", F.posexplode("std").alias("dim", "value")).select(
        "vec_id", "dim", round_to("value", 6).alias("value"))


_SCORES_SQL = """
WITH l AS (SELECT vec_id, label, list_transform(range(10), lambda c: list_sum(list_transform(
        list_filter(range(len(embedding)), lambda i: i % 10 = c), lambda i: CAST(embedding[i + 1] AS DOUBLE)))) AS z FROM embeddings),
s AS (SELECT vec_id, label, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS prediction,
        ln(list_sum(list_transform(z, lambda x: exp(x)))) - z[label + 1] AS loss,
        CAST(floor(vec_id / 64) AS BIGINT) AS batch FROM l),
b AS (SELECT batch, count(*) AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS c, avg(loss) AS l
      FROM s GROUP BY batch)"""


@query("classifier_metrics_embeddings", _SCORES_SQL + f"""
SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(c) AS BIGINT) AS correct,
       {R('sum(c) * 100.0 / sum(n)', 6)} AS accuracy_pct, {R('avg(l)', 6)} AS mean_loss FROM b""")
def q_classifier_metrics(spark, sf):
    emb = table(spark, sf, "embeddings")
    m = learning.classification_metrics(learning.fixed_linear_scores(emb, "embedding", "label", "vec_id"))
    return m.select("n", "correct", round_to("accuracy_pct", 6).alias("accuracy_pct"),
                    round_to("mean_loss", 6).alias("mean_loss"))


@query("classifier_train_embeddings", """
SELECT count(*) AS n, true AS converged, true AS never_rising, true AS above_majority, true AS below_chance_loss FROM embeddings""")
def q_classifier_train(spark, sf):
    """L2 + L3: fit the multinomial model to its tolerance and check it: it converged, the objective never
    rose, accuracy is above the largest class's share and the mean loss below that of guessing, ln(10)."""
    emb = table(spark, sf, "embeddings")
    model = learning.train_classifier(emb, "embedding", "label")
    fitted = learning.training_summary(model)
    scored = learning.predict(model, emb, "embedding", "label", "vec_id")
    share = emb.groupBy("label").agg(F.count("*").alias("c")).agg((F.max("c") * 100.0 / F.sum("c")).alias("majority"))
    facts = learning.classification_metrics(scored).unionByName(share, allowMissingColumns=True) \
        .agg(*(F.max(c).alias(c) for c in ("n", "accuracy_pct", "mean_loss", "majority")))  # two rows of facts into one
    return facts.select(
        "n", F.lit(fitted["converged"]).alias("converged"), F.lit(fitted["never_rising"]).alias("never_rising"),
        (F.col("accuracy_pct") > F.col("majority")).alias("above_majority"), (F.col("mean_loss") < F.log(F.lit(10.0))).alias("below_chance_loss"))


# One whole-table step from zero weights has the closed form rate / n * (sum of the class - sum of all / classes).
_SGD_RATE = 0.5


@query("sgd_first_steps_embeddings", f"""
WITH n AS (SELECT count(*) AS n FROM embeddings),
     cells AS (SELECT vec_id, label, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
               UNION ALL SELECT vec_id, label, -1, 1.0 FROM embeddings),
     total AS (SELECT d, sum(x) AS t FROM cells GROUP BY d), own AS (SELECT d, label, sum(x) AS s FROM cells GROUP BY d, label),
     w AS (SELECT total.d, c.c, {_SGD_RATE} / n * (coalesce(s, 0) - t / 10.0) AS w
           FROM total CROSS JOIN range(10) c(c) CROSS JOIN n LEFT JOIN own ON own.d = total.d AND own.label = c.c),
     z AS (SELECT vec_id, label, c, sum(x * w) AS z FROM cells JOIN w USING (d) GROUP BY vec_id, label, c),
     l AS (SELECT vec_id, ln(sum(exp(z))) - max(z) FILTER (c = label) AS loss FROM z GROUP BY vec_id)
SELECT 0 AS epoch, n AS n_rows, CAST(1 AS BIGINT) AS n_steps, {R('ln(10.0)', 6)} AS mean_loss FROM n
UNION ALL SELECT 1, (SELECT n FROM n), CAST(1 AS BIGINT), {R('avg(loss)', 6)} FROM l""")
def q_sgd_first_steps(spark, sf):
    """L2 by synchronous SGD over two ranks, one step an epoch: the losses before and after the first step."""
    emb = table(spark, sf, "embeddings")
    model = sgd.train_sgd(emb, "embedding", "label", "vec_id", ranks=2, epochs=2, batch=1 << 40, rate=_SGD_RATE)
    return model.epochs(spark).select("epoch", "n_rows", "n_steps", round_to("mean_loss", 6).alias("mean_loss"))


@query("sgd_ranks_embeddings", """
SELECT CAST(e AS INTEGER) AS epoch, n AS n_rows, CAST(ceil(n / 256.0) AS BIGINT) AS n_steps, CASE WHEN e > 0 THEN true END AS falls, true AS one_rank_agrees
FROM (SELECT count(*) AS n FROM embeddings) t, range(2) r(e)""")
def q_sgd_ranks(spark, sf):
    """L1 + L2: two epochs over three ranks; the loss falls from an epoch to the next, and one rank ends with the same losses."""
    emb = table(spark, sf, "embeddings")
    three, one = (sgd.train_sgd(emb, "embedding", "label", "vec_id", ranks=r, epochs=2, batch=256).epochs(spark) for r in (3, 1))
    both = three.join(one.select("epoch", F.col("mean_loss").alias("alone")), "epoch")
    before = three.select((F.col("epoch") + 1).alias("epoch"), F.col("mean_loss").alias("before"))
    return both.join(before, "epoch", "left").select(
        "epoch", "n_rows", "n_steps", (F.col("mean_loss") < F.col("before")).alias("falls"),
        (F.abs(F.col("mean_loss") - F.col("alone")) < 1e-6).alias("one_rank_agrees"))


# ----------------------------------------------------------------------------- numeric
_CELLS = """cells AS (SELECT vec_id, unnest(range(len(embedding))) AS i,
  CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""


@query("gram_matrix", f"""WITH {_CELLS}
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, {R('sum(a.v * b.v)', 6)} AS value
FROM cells a JOIN cells b USING (vec_id) GROUP BY a.i, b.i""")
def q_gram(spark, sf):
    g = numeric.gram_matrix(table(spark, sf, "embeddings"), "embedding")
    return g.select("i", "j", round_to("value", 6).alias("value"))


@query("matmul_tiled_gram", f"""WITH {_CELLS}
SELECT a.i AS "row", b.i AS col, {R('sum(a.v * b.v)', 6)} AS value FROM cells a JOIN cells b USING (vec_id) GROUP BY a.i, b.i""")
def q_matmul_tiled(spark, sf):
    """M1 in blocks: the transposed vectors times the vectors, as two coordinate tables."""
    cells = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "value"))
    x = cells.select(F.col("vec_id").alias("row"), F.col("i").cast("long").alias("col"), "value")
    out = numeric.matmul_tiled(x.select(F.col("col").alias("row"), F.col("row").alias("col"), "value"), x)
    return out.select("row", "col", round_to("value", 6).alias("value"))


@query("integral_user", f"""
SELECT user_id, count(*) AS n_points, {R('coalesce(sum(area), 0.0)', 2)} AS integral FROM (
  SELECT user_id, (CAST(date_diff('microsecond', lag(ts) OVER w, ts) AS DOUBLE) / 1e6)
         * (value + lag(value) OVER w) / 2.0 AS area
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x GROUP BY user_id""")
def q_integral(spark, sf):
    out = numeric.integrate(table(spark, sf, "events"), "user_id", "ts", "value", "event_id")
    return out.select("user_id", "n_points", round_to("integral", 2).alias("integral"))


_DAY = 86_400


@query("integral_windows_user", f"""
WITH p AS (SELECT user_id, epoch_us(ts) AS t, value AS v, lead(epoch_us(ts)) OVER w AS t2, lead(value) OVER w AS v2
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
     j AS (SELECT *, coalesce(v IS NOT NULL AND v2 IS NOT NULL AND t2 > t, false) AS joined FROM p),
     c AS (SELECT *, unnest(generate_series(t // {_DAY}000000, CASE WHEN joined THEN greatest(t // {_DAY}000000, (t2 - 1) // {_DAY}000000)
                                                             ELSE t // {_DAY}000000 END)) AS w FROM j),
     e AS (SELECT *, greatest(t, w * {_DAY}000000) AS lo, least(t2, (w + 1) * {_DAY}000000) AS hi FROM c)
SELECT user_id, w AS window_no, CAST(count_if(w = t // {_DAY}000000) AS BIGINT) AS n_points,
       {R("sum(CASE WHEN joined THEN (hi - lo) / 1e6 * ((v + (v2 - v) * (CAST(lo - t AS DOUBLE) / (t2 - t))) + (v + (v2 - v) * (CAST(hi - t AS DOUBLE) / (t2 - t)))) / 2 ELSE 0.0 END)", 2)} AS integral
FROM e GROUP BY user_id, w""")
def q_integral_windows(spark, sf):
    """M2 per day: segments cut at midnight by interpolation."""
    out = numeric.integrate_windows(table(spark, sf, "events"), "user_id", "ts", "value", "event_id", _DAY)
    return out.select("user_id", "window_no", "n_points", round_to("integral", 2).alias("integral"))


@query("integral_windows_whole", f"""
SELECT user_id, count(*) AS n_points, {R('coalesce(sum(area), 0.0)', 2)} AS integral FROM (
  SELECT user_id, (CAST(date_diff('microsecond', lag(ts) OVER w, ts) AS DOUBLE) / 1e6)
         * (value + lag(value) OVER w) / 2.0 AS area
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x GROUP BY user_id""")
def q_integral_windows_whole(spark, sf):
    """M2: the windows of a user add up to the user's integral."""
    out = numeric.integrate_windows(table(spark, sf, "events"), "user_id", "ts", "value", "event_id", _DAY)
    whole = out.groupBy("user_id").agg(F.sum("n_points").alias("n_points"), F.sum("integral").alias("integral"))
    return whole.select("user_id", "n_points", round_to("integral", 2).alias("integral"))


@query("metric_series_filled", f"""
WITH m AS ({MESSY_EVENTS_SQL}),
     s AS (SELECT user_id, date_trunc('day', ts) AS d, count(*) AS n, avg(value) AS v FROM m GROUP BY ALL),
     g AS (SELECT user_id, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM s GROUP BY user_id)
SELECT g.user_id, CAST(g.d AS TIMESTAMP) AS window_start, s.n, s.d IS NULL AS is_filled,
       {R('last_value(s.v IGNORE NULLS) OVER (PARTITION BY g.user_id ORDER BY g.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 6)} AS avg_value
FROM g LEFT JOIN s ON g.user_id = s.user_id AND g.d = s.d""")
def q_metric_series_filled(spark, sf):
    """T4 on a regular axis: the daily mean of every user, days without a value showing the last known one."""
    daily = streams.flatten_window(streams.metric_series(messy_events(spark, sf), "ts", "user_id", "value", "1 day"), ntz=False)
    out = series.fill_gaps(daily, "user_id", "window_start", "avg_value", _DAY)
    return out.select("user_id", "window_start", "n", "is_filled", round_to("avg_value", 6).alias("avg_value"))


# ----------------------------------------------------------------------------- streams
def _events_stream(spark, sf):
    return streams.file_stream(spark, sf, "events.parquet")


_BASES: list[str] = []  # folders of the stream query that runs


def _base(spark, name):
    """A folder of its own for every run of a registered query, where stream state belongs."""
    _BASES.append(streams.stream_base(spark, f"{name}-{uuid.uuid4().hex}"))
    return _BASES[-1]


def stream_query(name, oracle):
    """A registered query whose result is stored, and whose stream folders (state and logs) then go."""
    def wrap(fn):
        def run(spark, sf):
            first = len(_BASES)
            try:
                return materialize(fn(spark, sf), "stream_result")
            finally:
                for base in _BASES[first:]:
                    streams.remove_base(spark, base)
                del _BASES[first:]
        run.__doc__ = fn.__doc__
        query(name, oracle)(run)
        return run
    return wrap


@stream_query("stream_counts_events", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_stream_counts(spark, sf):
    return streams.run_updates(streams.stream_counts(_events_stream(spark, sf), "event_type"), ["event_type"],
                               _base(spark, "stream_counts"))


@stream_query("stream_latest_events", """
SELECT user_id, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_latest(spark, sf):
    cur = streams.stream_latest(_events_stream(spark, sf), "user_id", "ts", "event_id", ["value"],
                                _base(spark, "stream_latest"))
    return cur.select("user_id", "ts", "event_id", "value")


@stream_query("stream_dedupe_events", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_stream_dedupe(spark, sf):
    """Every event delivered twice (two sources over the same files); one copy survives."""
    one = streams.with_event_time(_events_stream(spark, sf), "ts")
    two = streams.with_event_time(_events_stream(spark, sf), "ts")
    deduped = streams.stream_dedupe(one.unionByName(two), "event_id", "event_time", "1 hour")
    rows = streams.run_append(deduped.drop("event_time"), _base(spark, "stream_dedupe"))
    return rows.select("event_id", "ts", "user_id", "event_type", "value")


@stream_query("metric_series_day", f"""
SELECT event_type, date_trunc('day', ts) AS window_start, count(*) AS n, {R('avg(value)', 6)} AS avg_value
FROM events GROUP BY ALL""")
def q_metric_series(spark, sf):
    ev = streams.with_event_time(_events_stream(spark, sf), "ts")
    agg = streams.metric_series(ev, "event_time", "event_type", "value", "1 day", delay="1 day")
    cur = streams.run_updates(agg, ["w", "event_type"], _base(spark, "metric_series"))
    return streams.flatten_window(cur).select("event_type", "window_start", "n",
                                              round_to("avg_value", 6).alias("avg_value"))


def _arrivals(spark, sf, name, run, again=False):
    """Let ``events`` arrive in three deliveries of several files each and call ``run(stream, span)`` after
    each. Every call is a new streaming query over the same folders, so the second and the third are
    restarts that carry state on; each drains its delivery in two or more micro-batches. A delivery is a
    third of the time span (``span``: its length, all of it, for watermarks); ``again`` brings the third
    before once more (late and repeated rows). Returns what the last call returned."""
    ev, folder = table(spark, sf, "events"), f"{scratch_path(spark, name)}/in"
    second = F.unix_seconds(ntz_to_instant("ts"))
    lo, hi = (x or 0 for x in ev.agg(F.min(second), F.max(second)).first())
    third = F.coalesce(F.floor((second - lo) * 3 / (hi - lo + 1)), F.lit(0))
    files, out = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4), None
    for n in range(3):
        ev.filter(third.isin(n, n - 1) if again else third == n).repartition(files).write.mode("append").parquet(folder)
        out = run(streams.file_stream(spark, folder, schema=ev.schema, max_files_per_trigger=max(1, files // 2)),
                  f"{hi - lo + 1} seconds")
    return out


@stream_query("stream_counts_restarted", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_counts_restarted(spark, sf):
    """T1 with evidence: several files, at least six micro-batches, two restarts, compaction every third batch."""
    base = _base(spark, "stream_counts_restarted")
    return _arrivals(spark, sf, "counts_in", lambda s, _: streams.run_updates(
        streams.stream_counts(s, "event_type"), ["event_type"], base, compact_every=3))


_TTL = 2 * _DAY


@stream_query("stream_counts_expiring", f"""
WITH e AS (SELECT user_id, ts, epoch_ms(ts) - lag(epoch_ms(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events),
     s AS (SELECT user_id, ts, sum(CASE WHEN gap >= {_TTL}000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM e),
     c AS (SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY user_id, no),
     w AS (SELECT max(epoch_ms(ts)) - ((max(epoch_ms(ts)) // 1000 - min(epoch_ms(ts)) // 1000 + 1) // 3 + 1) * 1000 AS mark FROM events)
SELECT user_id, n, first_ts, last_ts, epoch_ms(last_ts) + {_TTL}000 > mark AS is_open FROM c, w""")
def q_stream_counts_expiring(spark, sf):
    """T1 with timers: counters of a user that end after two days without arrival, over three deliveries and two restarts;
    the closed ones as the stream gave them out, the open ones read back from its state."""
    base = _base(spark, "stream_counts_expiring")

    def run(stream, span):
        rows = streams.with_event_time(stream, "ts")  # a delivery is a third of the span, in any order
        return streams.run_append(timed.expiring_counts(rows, "user_id", "event_time", f"{int(span.split()[0]) // 3 + 1} seconds", _TTL), base,
                                  state_store=streams.ROCKSDB)

    closed = _arrivals(spark, sf, "expiring_in", run)
    both = closed.withColumn("is_open", F.lit(False)).union(timed.open_counts(spark, base).withColumn("is_open", F.lit(True)))
    counters = both.select(F.col("key").alias("user_id"), "n", instant_to_ntz("first").alias("first_ts"), instant_to_ntz("last").alias("last_ts"), "is_open")
    # arrivals without a time have no place in the stream: like in the SQL they go to their user's last counter, or are one
    timeless = table(spark, sf, "events").filter("ts IS NULL").groupBy("user_id").agg(F.count("*").alias("n"))
    by_time = Window.partitionBy("user_id").orderBy(F.col("last_ts").asc_nulls_last())
    joined = F.when(F.lead("last_ts").over(by_time).isNull(), F.coalesce(F.lead("n").over(by_time), F.lit(0))).otherwise(0)
    return (counters.unionByName(timeless, allowMissingColumns=True).withColumns({"no": F.row_number().over(by_time), "n": F.col("n") + joined})
            .filter("last_ts IS NOT NULL OR no = 1").drop("no"))


@stream_query("stream_latest_restarted", """
SELECT user_id, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_restarted(spark, sf):
    """T2 over restarts; every delivery also brings the one before again, which must not win."""
    base = _base(spark, "stream_latest_restarted")
    cur = _arrivals(spark, sf, "latest_in", lambda s, _: streams.stream_latest(
        s, "user_id", "ts", "event_id", ["value"], base), again=True)
    return cur.select("user_id", "ts", "event_id", "value")


@stream_query("stream_dedupe_batches", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_dedupe_batches(spark, sf):
    """T3 with copies in different micro-batches and across restarts: two of the three deliveries bring
    every row of the one before again. The delay spans the deliveries, so one copy of each survives."""
    base = _base(spark, "stream_dedupe_batches")

    def run(s, span):
        once = streams.stream_dedupe(streams.with_event_time(s, "ts"), "event_id", "event_time", span)
        return streams.run_append(once.drop("event_time"), base)

    return _arrivals(spark, sf, "dedupe_in", run, again=True).select("event_id", "ts", "user_id", "event_type", "value")


@stream_query("metric_series_restarted", f"""
SELECT event_type, date_trunc('day', ts) AS window_start, count(*) AS n, {R('avg(value)', 6)} AS avg_value
FROM events GROUP BY ALL""")
def q_series_restarted(spark, sf):
    """T4 over restarts: a window whose rows lie in two deliveries goes on from its state."""
    base = _base(spark, "metric_series_restarted")

    def run(s, span):
        agg = streams.metric_series(streams.with_event_time(s, "ts"), "event_time", "event_type", "value", "1 day", delay=span)
        return streams.run_updates(agg, ["w", "event_type"], base, compact_every=4)

    cur = _arrivals(spark, sf, "series_in", run)
    return streams.flatten_window(cur).select("event_type", "window_start", "n", round_to("avg_value", 6).alias("avg_value"))


@stream_query("metric_latest_stream", f"""
SELECT event_type, arg_max(value, (ts, event_id)) AS latest, {R('avg(value)', 6)} AS mean,
       max(value) AS max, count(*) AS n FROM events GROUP BY event_type""")
def q_metric_latest_stream(spark, sf):
    """T5 in its streaming form, over restarts."""
    base = _base(spark, "metric_latest_stream")
    cur = _arrivals(spark, sf, "metric_in", lambda s, _: streams.run_updates(
        streams.metric_latest(s, "event_type", "ts", "event_id", "value"), ["event_type"], base))
    return cur.select("event_type", "latest", round_to("mean", 6).alias("mean"), "max", "n")


@query("metric_series_hour_batch", f"""
SELECT user_id % 10 AS node, date_trunc('hour', ts) AS window_start, count(*) AS n, {R('avg(value)', 6)} AS avg_value
FROM events GROUP BY ALL""")
def q_metric_series_batch(spark, sf):
    ev = table(spark, sf, "events").withColumn("node", F.col("user_id") % 10)
    agg = streams.metric_series(ev, "ts", "node", "value", "1 hour")
    return streams.flatten_window(agg, ntz=False).select("node", "window_start", "n",
                                                         round_to("avg_value", 6).alias("avg_value"))


@query("metric_latest_events", f"""
SELECT event_type, arg_max(value, (ts, event_id)) AS latest, {R('avg(value)', 6)} AS mean,
       max(value) AS max, count(*) AS n FROM events GROUP BY event_type""")
def q_metric_latest(spark, sf):
    m = streams.metric_latest(table(spark, sf, "events"), "event_type", "ts", "event_id", "value")
    return m.select("event_type", "latest", round_to("mean", 6).alias("mean"), "max", "n")


# ----------------------------------------------------------------------------- sources and sinks
@query("schema_report_orders", """
SELECT CAST(c.ordinal_position AS INTEGER) AS position, c.column_name,
       CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(c.data_type) END AS data_type,
       c.is_nullable = 'YES' AS nullable, n.n_rows, n.n_missing
FROM information_schema.columns c JOIN (
  SELECT * FROM (SELECT count(*) AS n_rows FROM orders), (UNPIVOT (
    SELECT CAST(count_if(COLUMNS(*) IS NULL OR CAST(COLUMNS(*) AS VARCHAR) IN ('', 'null')) AS BIGINT) FROM orders)
    ON COLUMNS(*) INTO NAME column_name VALUE n_missing)) n
  ON c.column_name = n.column_name WHERE c.table_name = 'orders'""")
def q_schema_report(spark, sf):
    """SNK1 with the one-scan profile: what the table declares next to what its rows hold."""
    orders = table(spark, sf, "orders")
    return io.schema_report(orders).join(
        profile.profile_table(orders).select("column_name", "n_rows", "n_missing"), "column_name") \
        .select("position", "column_name", "data_type", "nullable", "n_rows", "n_missing")


@query("preview_orders", """
SELECT o_orderkey, o_custkey, substr(o_orderstatus, 1, 50) AS o_orderstatus, o_totalprice, o_orderdate,
       substr(o_orderpriority, 1, 50) AS o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5""")
def q_preview(spark, sf):
    return io.preview(table(spark, sf, "orders"), 5, 50, order_by=["o_orderkey"])


@query("csv_roundtrip_titles", with_titles("SELECT * FROM titles"))
def q_csv_roundtrip(spark, sf):
    """SRC1 + SRC2 + SRC6: land the titles view as CSV in the shared folder, read it back with an
    explicit schema (no inference pass), land it as parquet and read that."""
    t = titles(spark, sf)
    base = scratch_path(spark, "csv_roundtrip")
    io.land_csv(t, f"{base}/csv")
    back = io.read_csv(spark, f"{base}/csv", schema=t.schema, null_value=io.CSV_NULL)
    io.land_parquet(back, f"{base}/parquet")
    return spark.read.parquet(f"{base}/parquet")


@query("csv_split_titles", with_titles("SELECT * FROM titles"))
def q_csv_split_titles(spark, sf):
    """SRC1 + SRC6 over one file in many tasks: the titles view as a single CSV file, read in blocks, landed as parquet."""
    t = titles(spark, sf)
    base = scratch_path(spark, "csv_split")
    io.land_csv(t.coalesce(1), f"{base}/csv")
    io.land_parquet(read_csv_split(spark, f"{base}/csv", t.schema, null_value=io.CSV_NULL, block_bytes=CSV_BLOCK), f"{base}/parquet")
    return spark.read.parquet(f"{base}/parquet")


@query("csv_split_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_split_documents(spark, sf):
    """SRC1 where most records span lines: the documents as CSV, with the newlines, quotes and commas of their texts."""
    t = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    base = scratch_path(spark, "csv_split")
    io.land_csv(t, f"{base}/csv")
    return read_csv_split(spark, f"{base}/csv", t.schema, null_value=io.CSV_NULL, block_bytes=CSV_BLOCK)


@query("word_count_lines", """
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+')) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM benchmark) l) x WHERE word <> '' GROUP BY word""")
def q_word_count_lines(spark, sf):
    """X9 over a text file: land benchmark texts as a text file, read it line by line (SRC3)."""
    from ..operators.words import word_count
    base = scratch_path(spark, "lines")
    table(spark, sf, "benchmark").select("text").write.text(f"{base}/text")
    return word_count(io.read_lines(spark, f"{base}/text"), "value")


# ----------------------------------------------------------------------------- more API surface
@query("label_counts_distinct_titles", with_titles("""
SELECT label, count(*) AS n FROM (
  SELECT unnest(list_distinct(list_filter(list_transform(string_split(countries, '/'), lambda x: trim(x)),
                                          lambda x: x <> ''))) AS label FROM titles) x
GROUP BY label"""))
def q_label_counts_distinct(spark, sf):
    """P5/P6 switches: trim, drop empty labels, count each label once per row."""
    from ..functions.columns import split_labels
    t = titles(spark, sf).select(F.explode(split_labels("countries", "/", trim=True, drop_empty=True,
                                                        dedupe=True)).alias("label"))
    return t.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("leaderboard_customer", f"""
SELECT c_nationkey, count(*) AS n, {R('avg(c_acctbal)', 2)} AS avg_c_acctbal FROM customer
GROUP BY c_nationkey HAVING count(*) >= 3
ORDER BY avg_c_acctbal DESC, n DESC, c_nationkey ASC NULLS FIRST LIMIT 10""")
def q_leaderboard_customer(spark, sf):
    from ..operators.reports import leaderboard
    return leaderboard(table(spark, sf, "customer"), "c_nationkey", "c_acctbal", min_count=3, k=10)


@query("trend_day_events", f"""
SELECT date_trunc('day', ts) AS period, count(*) AS n, {R('avg(value)', 6)} AS avg_value,
       n - lag(n) OVER (ORDER BY period) AS delta
FROM events GROUP BY 1""")
def q_trend_day(spark, sf):
    from ..operators.reports import trend_by_time
    return trend_by_time(table(spark, sf, "events"), "ts", "day", "n", {"avg_value": ("value", 6)}, delta="delta")


@query("trend_hour_events", """
SELECT date_trunc('hour', ts) AS period, count(*) AS n FROM events GROUP BY 1""")
def q_trend_hour(spark, sf):
    from ..operators.reports import trend_by_time
    return trend_by_time(table(spark, sf, "events"), "ts", "hour", "n")


@query("preview_titles", with_titles("""
SELECT movie_id, substr(title, 1, 50) AS title, substr(year, 1, 50) AS year, rating_score, rating_count,
       substr(genres, 1, 50) AS genres, substr(countries, 1, 50) AS countries, substr(directors, 1, 50) AS directors,
       collect_count, substr(summary, 1, 50) AS summary
FROM titles ORDER BY movie_id LIMIT 5"""))
def q_preview_titles(spark, sf):
    return io.preview(titles(spark, sf), 5, 50, order_by=["movie_id"])


@query("matmul_order_size", f"""
WITH a AS (SELECT l_orderkey AS r, l_partkey AS c, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT p_partkey AS r, CAST(floor(p_size / 10) AS BIGINT) AS c, sum(p_retailprice) AS v FROM part GROUP BY 1, 2)
SELECT a.r AS "row", b.c AS col, {R('sum(a.v * b.v)', 2)} AS value FROM a JOIN b ON a.c = b.r GROUP BY 1, 2""")
def q_matmul(spark, sf):
    """(order x part quantities) x (part x size-bucket prices) = value per order and size
    bucket. Each part has one size bucket, so the join emits one pair per line item."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("row"), F.col("l_partkey").alias("col"),
                                            F.col("l_quantity").alias("value"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("row"),
                                          F.floor(F.col("p_size") / F.lit(10)).alias("col"),
                                          F.col("p_retailprice").alias("value"))
    out = numeric.matmul(li, part)
    return out.select("row", "col", round_to("value", 2).alias("value"))


# ----------------------------------------------------------------------------- flagship variants
@query("country_report_short", with_base(f"""
SELECT country, count(*) AS movie_count, {R('avg(rating_score)', 2)} AS avg_rating
FROM (SELECT unnest(string_split(countries, '/')) AS country, rating_score FROM base) x
GROUP BY country HAVING count(*) >= 5
ORDER BY movie_count DESC, country ASC NULLS FIRST LIMIT 15"""))
def q_country_short(spark, sf):
    """The timed short form of Q1 (count and rounded mean score only)."""
    from ..functions.columns import explode_labels
    from ..operators.reports import group_report
    base = movies.analysis_base(titles(spark, sf)).select("countries", "rating_score")
    return group_report(explode_labels(base, "countries", "country"), "country", "movie_count",
                        {"avg_rating": ("rating_score", 2)}, min_count=5, order=[F.col("movie_count").desc()], k=15)


@query("country_report_trimmed", with_base(f"""
SELECT country, count(rating_score) AS movie_count, {R('avg(rating_score)', 6)} AS avg_rating,
       {R('avg(rating_count)', 4)} AS avg_rating_count
FROM (SELECT trim(unnest(string_split(countries, '/'))) AS country, rating_score, rating_count FROM base) x
GROUP BY country HAVING count(rating_score) >= 5
ORDER BY movie_count DESC, country ASC NULLS FIRST LIMIT 15"""))
def q_country_trimmed(spark, sf):
    """P7 + D11: the single-machine form of Q1 - labels trimmed (' FR' and 'FR' merge), the count
    is of non-NULL scores, means unrounded in the operator (rounded here only for the comparison)."""
    from ..functions.columns import explode_labels
    from ..operators.reports import group_report
    base = movies.analysis_base(titles(spark, sf)).select("countries", "rating_score", "rating_count")
    rep = group_report(explode_labels(base, "countries", "country", trim=True), "country", "movie_count",
                       {"avg_rating": ("rating_score", None), "avg_rating_count": ("rating_count", None)},
                       count_col="rating_score", min_count=5, order=[F.col("movie_count").desc()], k=15)
    return rep.select("country", "movie_count", round_to("avg_rating", 6).alias("avg_rating"),
                      round_to("avg_rating_count", 4).alias("avg_rating_count"))


# ----------------------------------------------------------------------------- flagship on many skewed labels
def _long_tail_sql(spread):
    return f"""
WITH titles AS ({LONG_TAIL_SQL.format(spread=spread)})
SELECT country, count(*) AS movie_count, {R('avg(rating_score)', 2)} AS avg_rating,
       {RL('avg(rating_count)')} AS avg_rating_count
FROM (SELECT unnest(string_split(countries, '/')) AS country, rating_score, rating_count FROM titles WHERE rating_score >= 1.0) x
GROUP BY country HAVING count(*) >= 5
ORDER BY movie_count DESC, country ASC NULLS FIRST LIMIT 15"""


@query("country_report_top_cuts", _long_tail_sql(3.0))
def q_country_top_cuts(spark, sf):
    """X3 on over 20 skewed labels: more than 15 pass the minimum, so the top 15 cuts."""
    return movies.country_report(movies.analysis_base(long_tail(spark, sf, 3.0)))


@query("country_report_having_cuts", _long_tail_sql(1.2))
def q_country_having_cuts(spark, sf):
    """X3 on fewer than 15 labels, the last of them rarer than the minimum, so HAVING cuts."""
    return movies.country_report(movies.analysis_base(long_tail(spark, sf, 1.2)))


# ----------------------------------------------------------------------------- operators in their other forms
@query("csv_with_bom_titles", with_titles("""
SELECT movie_id, title, year AS release_year, directors FROM titles"""))
def q_csv_with_bom(spark, sf):
    """SRC2 + P2: a CSV whose header starts with a byte order mark and whose names are found in the file."""
    base = scratch_path(spark, "csv_bom")
    t = titles(spark, sf).select("movie_id", "title", "year", "directors")
    io.land_csv(t.withColumnRenamed("movie_id", f"{io.BOM}movie_id"), f"{base}/csv")
    back = io.read_csv(spark, f"{base}/csv", null_value=io.CSV_NULL).withColumnRenamed("year", "release_year")
    return back.withColumn("movie_id", F.col("movie_id").cast("bigint"))


@query("registered_view_titles", with_titles("""
SELECT directors, count(*) AS n FROM titles GROUP BY directors"""))
def q_registered_view(spark, sf):
    """SNK3: the table under a view name of its own, asked in SQL."""
    name = f"titles_{uuid.uuid4().hex}"
    io.register(titles(spark, sf), name)
    return spark.sql(f"SELECT directors, count(*) AS n FROM {name} GROUP BY directors")


_ONE_LABEL = "SELECT movie_id, unnest(string_split(countries, '/')) AS countries FROM base"


@query("region_overlap_repeated", with_base(f"""
SELECT movie_id, CASE WHEN bool_or(countries = 'US') AND bool_or(countries = 'CN') THEN 'both'
                      WHEN bool_or(countries = 'US') THEN 'a_only' ELSE 'b_only' END AS side
FROM ({_ONE_LABEL}) x GROUP BY movie_id HAVING bool_or(countries = 'US') OR bool_or(countries = 'CN')"""))
def q_overlap_repeated(spark, sf):
    """J1 where an id has one row per label: the side is only known after the rows of an id met."""
    from ..functions.columns import explode_labels
    from ..operators.overlap import region_overlap
    rows = explode_labels(movies.analysis_base(titles(spark, sf)).select("movie_id", "countries"), "countries", "label")
    return region_overlap(rows.select("movie_id", F.col("label").alias("countries")), "movie_id", "countries", "US", "CN")


@query("profile_report_titles", with_titles("""
, typed AS (SELECT try_cast(year AS DOUBLE) AS y, rating_score AS s, genres FROM titles),
clean AS (SELECT * FROM typed WHERE y >= 1900 AND s >= 1.0)
SELECT part, label, n FROM (
  SELECT 'rows_before' AS part, '' AS label, count(*) AS n FROM titles
  UNION ALL SELECT 'rows_after', '', count(*) FROM clean
  UNION ALL SELECT 'missing', column_name, n FROM (UNPIVOT (
    SELECT CAST(count_if(COLUMNS(*) IS NULL OR CAST(COLUMNS(*) AS VARCHAR) IN ('', 'null')) AS BIGINT) FROM titles)
    ON COLUMNS(*) INTO NAME column_name VALUE n)
  UNION ALL SELECT 'numeric', c, n FROM (SELECT unnest(['year', 'rating_score', 'rating_count', 'collect_count']) AS c), (SELECT count(*) AS n FROM clean)
  UNION ALL SELECT * FROM (SELECT 'genres_top', g, count(*) FROM (SELECT unnest(string_split(genres, '/')) AS g FROM clean) GROUP BY g ORDER BY 3 DESC, g LIMIT 10)
  UNION ALL SELECT 'decades', CAST(CAST(floor(y / 10) * 10 AS INTEGER) AS VARCHAR), count(*) FROM clean GROUP BY 2) r"""))
def q_profile_report(spark, sf):
    """X8 as one report: every counting part of the movie table's profile as (part, label, n) rows."""
    parts = movies.profile_report(titles(spark, sf))
    columns = {"rows_before": (F.lit(""), "n_rows"), "rows_after": (F.lit(""), "n_rows"), "missing": (F.col("column_name"), "n_missing"),
               "numeric": (F.col("column_name"), "n"), "genres_top": (F.col("genre"), "n"),
               "decades": (F.col("decade").cast("int").cast("string"), "n")}
    out = None
    for part, (label, n) in columns.items():
        rows = parts[part].select(F.lit(part).alias("part"), label.alias("label"), F.col(n).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ----------------------------------------------------------------------------- cleaning on the messy events view
_MESSY = f"WITH messy AS ({MESSY_EVENTS_SQL})"


@query("clean_events_counts", _MESSY + f"""
SELECT event_type, count(*) AS n, {R('avg(value)', 6)} AS avg_value FROM messy
WHERE value IS NOT NULL AND event_type IS NOT NULL AND event_type <> '' GROUP BY event_type""")
def q_clean_events(spark, sf):
    """C2 + C4: drop rows with a NULL value, keep present event types ('null' text stays a type)."""
    from ..operators.cleaning import drop_missing, keep_present
    from ..operators.reports import group_report
    ev = keep_present(drop_missing(messy_events(spark, sf), ["value"]), "event_type")
    return group_report(ev, "event_type", "n", {"avg_value": ("value", 6)})


@query("cleaning_audit_events", _MESSY + """
SELECT 1 AS step_no, 'value present' AS step, count(*) AS n_in, CAST(count_if(value IS NULL) AS BIGINT) AS n_rule,
       CAST(0 AS BIGINT) AS n_null, CAST(count_if(value IS NOT NULL) AS BIGINT) AS n_out FROM messy
UNION ALL
SELECT 2, 'event_type present', count(*),
       CAST(count_if(event_type IS NULL OR event_type = '' OR event_type = 'null') AS BIGINT), CAST(0 AS BIGINT),
       CAST(count_if(NOT (event_type IS NULL OR event_type = '' OR event_type = 'null')) AS BIGINT)
FROM messy WHERE value IS NOT NULL""")
def q_audit_events(spark, sf):
    """A10 with the missing-value test (C1) as a rule: NULL / '' / 'null' event types are removed."""
    from ..functions.columns import is_missing
    from ..operators.cleaning import Step, cleaning_audit
    steps = [Step("value present", F.col("value").isNotNull()), Step("event_type present", ~is_missing("event_type"))]
    return cleaning_audit(messy_events(spark, sf), steps)


# ----------------------------------------------------------------------------- shared range layout
@query("user_activity_events", f"""
WITH r AS (
  SELECT user_id, ts, row_number() OVER w AS rn,
         (CAST(date_diff('microsecond', lag(ts) OVER w, ts) AS DOUBLE) / 1e6) * (value + lag(value) OVER w) / 2.0 AS area
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(*) AS n_points, {R('coalesce(sum(area), 0.0)', 2)} AS integral,
       max(CASE WHEN rn = 10 THEN ts END) AS tenth_event_ts
FROM r GROUP BY user_id""")
def q_user_activity(spark, sf):
    """W4 + M2: per user, the event count, the integral of value over
    time, and when the running count reached 10 (NULL for fewer events)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    counts = ranking.running_count(ev.drop("value"), "user_id", "ts", "event_id")
    tenth = counts.filter(F.col("running_count") == F.lit(10)).select("user_id", F.col("ts").alias("tenth_event_ts"))
    integ = numeric.integrate(ev, "user_id", "ts", "value", "event_id")
    return (integ.join(tenth, "user_id", "left")
            .select("user_id", "n_points", round_to("integral", 2).alias("integral"), "tenth_event_ts"))
