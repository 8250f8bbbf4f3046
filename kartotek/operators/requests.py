"""Request plans: what a run has to ask for, and which of it has no landed answer.

A plan has the columns of ``PLAN``. Requests without a dataset carry the whole run: where one of
them has no answer, the run is refused. The others carry one dataset, which fails alone. A request is
answered by any response to its address, whatever its status: what a bad status means is for the rules
of that feed. Addresses compare without page number, trailing slash and fragment, so a request answered
in pages counts once.

Plans are derived with joins from catalogues, areas and years, and compared with the addresses of the landed
responses by one anti-join; bodies are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators import kpi
from kartotek.operators.catalog import child_path
from kartotek.session import sorted_side, spread

PLAN = "feed string, url string, dataset_code string, why string"

#: First years asked for by change feeds and by observations, and years past the run's own.
FIRST_CHANGE_YEAR, FIRST_VALUE_YEAR, YEARS_AHEAD = 2010, 1970, 3


def request_key(url: Column) -> Column:
    """The address of a request, whichever of its pages was answered."""
    bare = F.regexp_replace(url, r"#.*$", "")
    unpaged = F.regexp_replace(F.regexp_replace(bare, r"([?&])(?:page|pageNumber)=\d+(?=&|$)", "$1"), r"([?&])&+", "$1")
    plain = ~(url.contains("#") | url.contains("?") | url.contains("&") | url.endswith("/"))
    return F.when(plain, url).otherwise(F.regexp_replace(F.regexp_replace(unpaged, r"[?&]+$", ""), "/+$", ""))


def requests(rows: DataFrame, feed: str, url: Column, why: Column, dataset: Column | None = None) -> DataFrame:
    """Rows as requests of one feed."""
    code = F.lit(None).cast("string") if dataset is None else dataset
    return rows.select(F.lit(feed).alias("feed"), request_key(url).alias("url"), code.alias("dataset_code"), why.alias("why"))


def whole_feeds(spark: SparkSession, feeds: dict[str, str]) -> DataFrame:
    """Feeds of which any response will do: ``{feed: why}``."""
    rows = [(feed, None, None, why) for feed, why in feeds.items()]
    return spark.createDataFrame(rows, PLAN)


def missing(plan: DataFrame, raw: DataFrame) -> DataFrame:
    """The requests without a landed response; requests without an address stand for their feed.

    Addresses repeat by pages only, so they are not made distinct: that would hold the addresses of a whole
    split in one task and an anti-join has no use for it. Feeds are few, so those are."""
    key = F.concat_ws(" ", "feed", "url")
    answered = raw.filter("url is not null").select("feed", request_key(F.col("url")).alias("url")).select(key.alias("_key"))
    landed = answered.unionByName(raw.select(F.col("feed").alias("_key")).distinct())
    return plan.withColumn("_key", key).join(sorted_side(landed), "_key", "left_anti").select("feed", "url", "dataset_code", "why")


def missing_feeds(plan: DataFrame, raw: DataFrame) -> DataFrame:
    """The same where no request has an address: addresses are not read."""
    return missing(plan, raw.select("feed", F.lit(None).cast("string").alias("url")))


def run_faults(lacking: DataFrame) -> DataFrame:
    """(rule, path) of missing requests that carry the run."""
    return lacking.filter("dataset_code is null").select(F.lit("not answered").alias("rule"), F.concat_ws("/", "feed", "why").alias("path"))


def dataset_faults(lacking: DataFrame) -> DataFrame:
    """(dataset_code, rule, path) of missing requests that carry one dataset, one row each."""
    return lacking.filter("dataset_code is not null").groupBy("dataset_code").agg(F.min(F.concat_ws("/", "feed", "why")).alias("path")).select(
        "dataset_code", F.lit("not answered").alias("rule"), "path")


# --- tables ------------------------------------------------------------------------------------

def folder_requests(entries: DataFrame, api_url: str) -> DataFrame:
    """The root of a folder tree, and every folder that a landed folder lists.

    A folder is asked for only below folders that were reached, so each listed folder looks for its
    own parent among the listed ones: those with all parents back to the root are asked for."""
    spark = entries.sparkSession
    api = api_url.rstrip("/")
    folders = entries.filter("type = 'l'").select(child_path(F.col("parent_path"), F.col("id")).alias("path")).distinct()
    tokens = F.split(F.expr("substring(path, 2)"), "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(tokens, 1, i), "/")))
    above = folders.select("path", F.size(tokens).alias("depth"), F.explode(prefixes).alias("prefix"))
    reached = (
        above.join(folders.select(F.col("path").alias("prefix")), "prefix").groupBy("path", "depth")
        .agg(F.count("*").alias("n")).filter("n = depth").select("path")
    )
    root = spark.range(1).select(F.lit("").alias("path"))
    return requests(
        root.unionByName(reached), "nav", folder_address(api, F.col("path")), F.when(F.col("path") == "", "/").otherwise(F.col("path")))


def folder_address(api: str, path: Column) -> Column:
    encoded = F.array_join(F.transform(fn.path_tokens(path), fn.encode_segment), "/")
    return F.concat_ws("/", F.lit(api), F.when(encoded != "", encoded))


def dataset_requests(chosen: DataFrame, feed: str, url: Column, key: str = "dataset_code") -> DataFrame:
    """One request for each dataset that is fetched."""
    return requests(chosen, feed, url, F.col(key), F.col(key))


# --- indicators --------------------------------------------------------------------------------

def _joined(ids: str) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def change_requests(areas: DataFrame, api_url: str, year: int, since: str, kinds: Sequence[str] = ("data", "oudata"),
                    bounds: list | None = None) -> DataFrame:
    """The change feeds of an incremental run: all areas and years since FIRST_CHANGE_YEAR, in batches
    of the filter limit, for each kind of data."""
    batches = kpi.probe_batches(areas.select("area_id").distinct(), FIRST_CHANGE_YEAR, year + YEARS_AHEAD, bounds=bounds)
    api = api_url.rstrip("/")
    each = batches.withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))
    url = F.concat(F.lit(f"{api}/"), "kind", F.lit("/municipality/"), _joined("area_ids"), F.lit("/year/"), _joined("years"),
                   F.lit(f"?from_date={since}"))
    return requests(each, "changes", url, F.concat_ws("/", "kind", "batch_id", "year_batch"))


def value_requests(due: DataFrame, areas: DataFrame, api_url: str, year: int, bounds: list | None = None) -> DataFrame:
    """The observations of each indicator that is fetched (kpi_id, dataset_code, kind, scope_type): areas of
    its scope and all years in batches, or for units one request a year."""
    api, due = api_url.rstrip("/"), spread(due, "kpi_id")
    scoped = kpi.area_scopes(areas.dropDuplicates(["area_id"]))
    batches = kpi.probe_batches(scoped, FIRST_VALUE_YEAR, year + YEARS_AHEAD, group=("scope_type",), bounds=bounds)
    asked = due.filter("kind = 'data'").join(batches, "scope_type")
    url = F.concat(F.lit(f"{api}/data/kpi/"), "kpi_id", F.lit("/municipality/"), _joined("area_ids"), F.lit("/year/"), _joined("years"))
    by_area = requests(asked, "data", url, F.concat_ws("/", "kpi_id", "batch_id", "year_batch"), F.col("dataset_code"))
    years = F.sequence(F.lit(FIRST_VALUE_YEAR), F.lit(year + YEARS_AHEAD))
    by_year = due.filter("kind = 'oudata'").withColumn("y", F.explode(years))
    unit_url = F.concat(F.lit(f"{api}/oudata/kpi/"), "kpi_id", F.lit("/year/"), F.col("y").cast("string"))
    return by_area.unionByName(requests(by_year, "oudata", unit_url, F.concat_ws("/", "kpi_id", "y"), F.col("dataset_code")))
