"""Selection, state, streams and the adapter seam."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartotek.operators import adapters, incremental, presence, sinks
from kartotek.plans.bindings import Tables, code, text_of
from kartotek.plans.oracle import CANDIDATES, OBS, ORDER_ID, SELECTION, STATE
from kartotek.plans.registry import query
from kartotek.session import fresh_dir
from kartotek.streaming import outcomes as streams
from kartotek.streaming.generations import FactLog


@query("inc_timestamp", CANDIDATES, STATE, SELECTION, sql="SELECT dataset_code, should_fetch FROM selection")
def inc_timestamp(t: Tables):
    return incremental.select_by_timestamp(t.candidates, t.state).select("dataset_code", "should_fetch")


STARTED, RECENT, OLD = "1999-06-30 10:00:00", "1999-05-31 00:00:00", "1999-05-30 23:59:59.999999"


@query("inc_window", CANDIDATES, STATE, SELECTION, sql=f"""
SELECT dataset_code, 'incremental' AS mode, (NOT known OR last_fetched_at IS NULL OR has_error OR last_fetched_at < TIMESTAMP '{STARTED}' - INTERVAL 30 DAY
       OR EXISTS (SELECT 1 FROM events WHERE user_id = o_orderkey AND event_type = 'click')) AS should_fetch FROM selection
UNION ALL SELECT dataset_code, 'full', true FROM selection""")
def inc_window(t: Tables):
    """The same catalogue after a recent checkpoint and one microsecond before the window."""
    cands = t.candidates.withColumn("kpi_id", F.col("dataset_code")).withColumn("kind", F.lit("data"))
    feed = t.events.filter("event_type = 'click'").select(code("O", "user_id").alias("kpi_id"), F.lit("data").alias("kind"))

    def run(mode: str, checkpoint: str):
        return incremental.select_by_window(
            cands, t.state, feed, F.lit(STARTED).cast("timestamp"), F.lit(checkpoint).cast("timestamp")).select(
            "dataset_code", F.lit(mode).alias("mode"), "should_fetch")

    return run("incremental", RECENT).unionByName(run("full", OLD))


@query("inc_checkpoint", sql="""
SELECT event_type AS provider_code, strftime(max(CASE WHEN value > 5 AND event_id % 4 <> 0 AND event_id % 7 <> 0 THEN ts END), '%Y-%m-%d %H:%M:%S') AS checkpoint,
       count(*)::bigint AS runs, count(*) FILTER (WHERE value > 5 AND event_id % 4 <> 0 AND event_id % 7 <> 0)::bigint AS clean_runs FROM events GROUP BY event_type""")
def inc_checkpoint(t: Tables):
    e = F.col("event_id")
    runs = t.events.select(
        F.col("event_type").alias("provider_code"), F.col("ts").cast("timestamp").alias("started_at"), (F.col("value") > 5).alias("listing_complete"),
        F.when(e % 4 == 0, 10).alias("limit_n"), F.when(e % 7 == 0, "lost").alias("error"))
    return incremental.advance_checkpoint(runs, ["provider_code"]).select(
        "provider_code", text_of(F.col("checkpoint")).alias("checkpoint"), "runs", "clean_runs")


def event_outcomes(t: Tables):
    """Outcomes whose dataset is the order numbered like the user."""
    kind = F.col("event_type")
    return t.events.select(
        code("O", "user_id").alias("dataset_code"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind.isin("click", "purchase"), "saved").when(kind == "error", "failed").otherwise("skipped").alias("outcome"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("source_updated_at"))


NEWS = """news AS (
  SELECT 'O' || lpad(user_id::varchar, 9, '0') AS dataset_code, max(ts) FILTER (WHERE event_type IN ('click', 'purchase')) AS fetched,
         arg_max(event_type, event_id) FILTER (WHERE event_type IN ('click', 'purchase', 'error')) = 'error' AS failed
  FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'error')) > 0)"""


@query("inc_next_state", STATE, NEWS, sql="""
SELECT coalesce(s.dataset_code, n.dataset_code) AS dataset_code,
       strftime(CASE WHEN n.fetched IS NOT NULL THEN date_trunc('hour', n.fetched) ELSE s.source_updated_at END, '%Y-%m-%d %H:%M:%S') AS source_updated_at,
       strftime(coalesce(n.fetched, s.last_fetched_at), '%Y-%m-%d %H:%M:%S') AS last_fetched_at, coalesce(n.failed, s.has_error) AS has_error
FROM state s FULL JOIN news n ON s.dataset_code = n.dataset_code""")
def inc_next_state(t: Tables):
    state = t.state.drop("provider_code", "language")
    return incremental.next_state(state, event_outcomes(t), ["dataset_code"], ["event_id"]).select(
        "dataset_code", text_of(F.col("source_updated_at")).alias("source_updated_at"), text_of(F.col("last_fetched_at")).alias("last_fetched_at"), "has_error")


@query("inc_rebuild", OBS, """numbered AS (SELECT *, substr(kpi, 2)::bigint AS k FROM obs WHERE value IS NOT NULL AND NOT isdeleted)""",
       """cur AS (SELECT * FROM numbered WHERE period >= 1998 AND k % 5 <> 0 AND k % 2 = 0)""",
       """kept AS (SELECT * FROM numbered WHERE period < 2000 AND kpi NOT IN (SELECT kpi FROM cur))""", sql="""
SELECT DISTINCT kpi, 'year' AS dim_id, period::varchar AS cat_id FROM cur UNION ALL SELECT DISTINCT kpi, 'municipality', entity FROM cur
UNION ALL SELECT DISTINCT kpi, 'year', period::varchar FROM kept UNION ALL SELECT DISTINCT kpi, 'municipality', entity FROM kept""")
def inc_rebuild(t: Tables):
    """Stored from the early years; then even KPIs are fetched again, every fifth of them empty."""
    k = F.expr("cast(substring(kpi, 2) as bigint)")
    obs = t.observations
    stored = presence.presence(obs.filter("period < 2000"))
    current = obs.filter("period >= 1998").withColumn("isdeleted", F.col("isdeleted") | (k % 5 == 0))
    keys = obs.filter(k % 2 == 0).select("kpi").distinct()
    fresh = incremental.rebuild(stored, current, keys)
    path = fresh_dir(t.spark, "rebuild")
    sinks.write_partitioned(fresh, path, "dim_id")
    return t.spark.read.schema("kpi string, cat_id string, dim_id string").parquet(path).select("kpi", "dim_id", "cat_id")


@query("str_outcomes", NEWS, sql="""
SELECT dataset_code, strftime(date_trunc('hour', fetched), '%Y-%m-%d %H:%M:%S') AS source_updated_at, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS last_fetched_at, failed AS has_error FROM news""")
def str_outcomes(t: Tables):
    """Events as an outcome stream, run to its end; the state read back."""
    source = streams.file_stream(t.spark, t.sf_dir, "events")
    stream = event_outcomes(_Streamed(t, events=source))
    folder = fresh_dir(t.spark, "outcome-stream")
    keys = ["dataset_code"]
    streams.finish(streams.stream_outcomes(stream, f"{folder}/facts", f"{folder}/checkpoint", keys, ["event_id"]))
    return streams.stored_state(t.spark, f"{folder}/facts", keys).select(
        "dataset_code", text_of(F.col("source_updated_at")).alias("source_updated_at"), text_of(F.col("last_fetched_at")).alias("last_fetched_at"), "has_error")


class _Streamed:
    """Tables with some of them replaced by streams."""

    def __init__(self, tables: Tables, **streams_):
        self._tables, self._streams = tables, streams_

    def __getattr__(self, name):
        return self._streams[name] if name in self._streams else getattr(self._tables, name)


@query("str_select", CANDIDATES, STATE, sql="""
SELECT e.event_id, (s.dataset_code IS NULL OR s.last_fetched_at IS NULL OR s.has_error OR s.source_updated_at IS NULL
       OR s.source_updated_at <> CASE WHEN e.event_id % 2 = 0 THEN o.o_orderdate ELSE e.ts END) AS should_fetch
FROM events e JOIN orders o ON e.user_id = o.o_orderkey LEFT JOIN state s ON s.dataset_code = 'O' || lpad(e.user_id::varchar, 9, '0')""")
def str_select(t: Tables):
    """Every event is a listing row of its user's order, half of them with the order's own date."""
    events = streams.file_stream(t.spark, t.sf_dir, "events")
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("own_date"))
    listing = events.join(orders, F.col("user_id") == F.col("o_orderkey")).select(
        "event_id", F.lit("demo").alias("provider_code"), code("O", "user_id").alias("dataset_code"), F.lit("sv").alias("language"),
        F.when(F.col("event_id") % 2 == 0, F.col("own_date")).otherwise(F.col("ts").cast("timestamp")).alias("updated"))
    folder = fresh_dir(t.spark, "select-stream")
    streams.finish(streams.stream_select(listing, t.state, folder, f"{folder}/checkpoint"))
    return streams.selected(t.spark, folder, "event_id bigint, should_fetch boolean")


@query("str_versions", sql=f"""
SELECT {ORDER_ID} AS dataset_code, CASE WHEN b = 0 THEN 'before' ELSE 'after' END AS batch, b = 0 OR o_orderkey % 3 = 0 AS should_fetch
FROM orders, range(2) r(b)""")
def str_versions(t: Tables):
    """Orders listed twice; between the two batches two in three of them are saved and the others fail."""
    folder, keys = fresh_dir(t.spark, "version-stream"), list(incremental.IDENTITY)
    log = FactLog(t.spark, f"{folder}/facts", keys)
    cands = t.orders.select(
        F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), F.lit("sv").alias("language"),
        F.col("o_orderdate").cast("timestamp").alias("updated"), F.col("o_orderkey").alias("k"))
    nothing = t.state.limit(0)
    source = streams.file_stream(t.spark, t.sf_dir, "orders")
    listing = source.select(
        F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), F.lit("sv").alias("language"),
        F.col("o_orderdate").cast("timestamp").alias("updated"))
    both = None
    for batch in ("before", "after"):
        streams.finish(streams.stream_select(listing, nothing, f"{folder}/{batch}", f"{folder}/checkpoint-{batch}", keys, log))
        part = streams.selected(t.spark, f"{folder}/{batch}", "dataset_code string, should_fetch boolean").withColumn("batch", F.lit(batch))
        both = part if both is None else both.unionByName(part)
        done = cands.withColumns({
            "outcome": F.when(F.col("k") % 3 == 0, "failed").otherwise("saved"), "source_updated_at": F.col("updated"),
            "ts": F.col("updated"), "n": F.lit(1)})
        log.add(incremental.outcome_facts(done, keys, ["n"]), 0)
    return both


@query("udf_adapter_dispatch", """d AS (SELECT c_custkey AS k, 'c' || c_custkey AS id, c_name, c_mktsegment AS seg FROM customer)""", sql="""
SELECT 'pxweb_v2' AS adapter, id AS dataset_code, c_name AS label, CASE WHEN k % 3 = 0 THEN '2024-01-02 00:00:00' END AS updated, NULL AS subject_code FROM d WHERE seg = 'BUILDING'
UNION ALL SELECT 'pxweb_v1', id, id, '2024-01-02 00:00:00', 'p' || k FROM d WHERE seg = 'MACHINERY' AND k % 3 = 0
UNION ALL SELECT 'kolada', id, c_name, NULL, 'kolada:operating_area:A%20b' FROM d WHERE seg = 'HOUSEHOLD'
UNION ALL SELECT 'kolada', id || '_OU', c_name, NULL, 'kolada:operating_area:A%20b' FROM d WHERE seg = 'HOUSEHOLD' AND k % 2 = 0
UNION ALL SELECT 'unknown', id, NULL, NULL, NULL FROM d WHERE seg IN ('AUTOMOBILE', 'FURNITURE')""")
def udf_adapter_dispatch(t: Tables):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    ident = F.concat(F.lit("c"), k.cast("string"))
    entry = F.struct(
        ident.alias("id"), F.when(seg == "BUILDING", F.col("c_name")).alias("label"), F.when(seg == "HOUSEHOLD", F.col("c_name")).alias("title"),
        F.concat(F.lit("a/p"), k.cast("string")).alias("path"), F.when(k % 3 == 0, "2024-01-02").alias("updated"),
        (k % 2 == 0).alias("has_ou_data"), F.lit("A b").alias("operating_area"))
    rows = t.customer.select(
        F.lit("demo/sv").alias("scope"), F.when(seg == "BUILDING", "PXWEB_V2").when(seg == "MACHINERY", "pxweb_v1 ").when(seg == "HOUSEHOLD", "Kolada").otherwise("ftp").alias("adapter"),
        ident.alias("ident"), F.try_parse_json(F.to_json(entry)).alias("entry"))
    known = adapters.dispatch(rows).select("adapter", "dataset_code", "label", text_of(F.col("updated")).alias("updated"), "subject_code")
    nothing = F.lit(None).cast("string")
    lost = adapters.unknown_adapters(rows).select(
        F.lit("unknown").alias("adapter"), F.col("ident").alias("dataset_code"), nothing.alias("label"), nothing.alias("updated"), nothing.alias("subject_code"))
    return known.unionByName(lost)
