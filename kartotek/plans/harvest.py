"""Whole runs: landed responses and stored state in, one outcome per dataset out.

Fetching stays outside: whatever was landed is read here, and held against the plan of what the run
had to ask for (``operators/requests.py``). A dataset whose responses break a rule or are missing fails
on its own. What puts the whole listing in doubt (a fatal or missing response, a missing page, a broken
page chain, a dataset listed twice, conflicting groups, an unknown scope) refuses the run: every
dataset that was due then fails with that one error, and none is saved from half a listing. The error
is also the run's own (``Result.error``), for a listing that is missing has no datasets.
Each table is reduced to one row per dataset before any join, so repeats never multiply.

Tables used several times (selection, parsed axes, presence) are checkpointed in the shared
folder: landed bodies are parsed once, and a lost executor costs no more than its tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek import schemas
from kartotek.operators import (
    catalog, dimensions, documents, enrich, incremental, kpi, presence, quality, requests, sinks,
)
from kartotek.operators.numbering import range_bounds
from kartotek.sources import html, landed
from kartotek.session import configure, cut_lineage, sorted_side, spread
from kartotek.sources import kpi as kpi_source

KEY = "dataset_code"


@dataclass(frozen=True)
class Run:
    """One run over one provider and language."""

    run_id: str
    provider_code: str
    language: str
    started_at: datetime
    checkpoint: datetime | None = None
    force: bool = False
    limit: int | None = None


@dataclass(frozen=True)
class Result:
    """What a run leaves: one outcome for each dataset, and its own error where it was refused."""

    run: Run
    outcomes: DataFrame
    error: str | None


def feed(raw: DataFrame, *names: str) -> DataFrame:
    """Usable responses of the named feeds."""
    return raw.filter(F.col("feed").isin(*names) & F.coalesce(F.col("status").between(200, 299), F.lit(False)))


def unanswered(raw: DataFrame, names: list[str], below_root: Column | None = None) -> DataFrame:
    """(rule, path) of the named feeds with a response that is fatal: no success, and no
    tolerated gap (400 or 404 where ``below_root`` holds)."""
    root = F.lit(True) if below_root is None else ~below_root
    kind = landed.response_class(F.coalesce("status", F.lit(0)), root)
    return raw.filter(F.col("feed").isin(*names) & (kind == "fatal")).select(
        F.lit("response").alias("rule"), F.concat_ws("/", "feed", F.col("status").cast("string")).alias("path"))


def listed_twice(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy(KEY).agg(F.count("*").alias("_n")).filter("_n > 1").select(
        F.lit("duplicate").alias("rule"), F.concat_ws("/", F.lit("discovery"), F.col(KEY)).alias("path"))


def run_error(*faults: DataFrame) -> str | None:
    """The first fault of the run, by table and path: one row reaches the driver."""
    ranked = [t.select(F.lit(i).alias("rank"), "path", "rule") for i, t in enumerate(faults)]
    found = reduce(DataFrame.unionByName, ranked).agg(F.min(F.struct("rank", "path", "rule")).alias("f")).first()["f"]
    return None if found is None else f"{found['path']}: {found['rule']}"


def one_each(df: DataFrame) -> DataFrame:
    """One row per dataset; which of equal codes stays is open, for the run is refused then."""
    return df.dropDuplicates([KEY])


def absent(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _first_faults(*tables: DataFrame) -> DataFrame:
    """First breach of each dataset as its error text: by table, then by field path."""
    ranked = [t.select(KEY, F.lit(i).alias("rank"), "path", "rule") for i, t in enumerate(tables)]
    rows = reduce(DataFrame.unionByName, ranked)
    first = rows.groupBy(KEY).agg(F.min(F.struct("rank", "path", "rule")).alias("f"))
    return first.select(KEY, F.concat_ws(": ", "f.path", "f.rule").alias("fault"))


def _outcomes(run: Run, selection: DataFrame, pairs: DataFrame, faults: DataFrame, refused: str | None) -> DataFrame:
    """Classify every selected dataset, once; one without a finished pair has failed, and one
    beyond the limit of attempts is deferred."""
    joined = (
        one_each(selection).select(
            "provider_code", KEY, "language", "should_fetch", "attempt_no", "deferred",
            F.col("updated").alias("source_updated_at"))
        .join(sorted_side(documents.to_json_pair(one_each(pairs)).select(KEY, "documents")), KEY, "left")
        .join(sorted_side(faults), KEY, "left")
    )
    error = F.coalesce(
        F.lit(refused).cast("string"), "fault", F.when(F.col("documents").isNull(), F.lit("no usable metadata landed")))
    done = sinks.outcomes(
        joined.withColumn("run_id", F.lit(run.run_id))
        .withColumn("error", F.when(F.col("should_fetch"), error))
        .drop("fault")
    )
    kept = [c for c in ("error", "documents", "source_updated_at")]
    return done.withColumns({c: F.when(~F.col("deferred"), F.col(c)) for c in kept}).withColumn(
        "outcome", F.when(F.col("deferred"), F.lit("deferred")).otherwise(F.col("outcome"))).drop("deferred")


def _bounded(run: Run, selection: DataFrame, order: list[str]) -> DataFrame:
    selection = cut_lineage(selection)
    if run.limit is None:
        return selection.withColumn("attempt_no", absent("bigint")).withColumn("deferred", F.lit(False))
    bounds = range_bounds(selection, order[0], 64)
    return cut_lineage(
        incremental.bounded(selection, ["provider_code", "language"], order, run.limit, bounds)
    )


def _document_faults(chosen: DataFrame, dims: DataFrame, details: DataFrame, cats: DataFrame) -> list[DataFrame]:
    """Rules of the finished documents: identity, fields, open fields, units and places."""
    texts = chosen.withColumns({
        "updated": F.date_format("updated", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "source_url": F.col("web_url"), "doc_url": absent("string")})
    unit = F.col("unit")
    maps = details.select(
        KEY, "dim_id", "cat_id", F.get("coordinates", F.lit(0)).alias("lon"), F.get("coordinates", F.lit(1)).alias("lat"),
        F.try_variant_get(unit, "$.position", "string").alias("position"), F.try_variant_get(unit, "$.decimals", "int").alias("decimals"))
    nested = dims.filter("nested_fault").select(KEY, F.lit("nested").alias("rule"), F.lit("extension/extension").alias("path"))
    return [
        quality.check_dataset(texts, [KEY]), nested,
        quality.check_category_maps(maps, [KEY, "dim_id"]),
        quality.unknown_keys(maps, cats, [KEY, "dim_id"], "category"),
    ]


def _structure_faults(axes: DataFrame, cats: DataFrame) -> DataFrame:
    sized = cats.groupBy(KEY, "dim_id").agg(F.count("*").alias("n_values"))
    dims = axes.select(KEY, "dim_id").join(sorted_side(sized), [KEY, "dim_id"], "left")
    return quality.check_structure(dims, cats, KEY)


def tables_v2(raw: DataFrame, state: DataFrame, run: Run, api_url: str, web_url: str | None = None) -> DataFrame:
    """Outcomes of :func:`run_tables_v2`."""
    return run_tables_v2(raw, state, run, api_url, web_url).outcomes


def run_tables_v2(raw: DataFrame, state: DataFrame, run: Run, api_url: str, web_url: str | None = None) -> Result:
    """Listing pages and JSON-stat2 metadata of one scope."""
    configure(raw.sparkSession)
    pages = feed(raw, "listing")
    listing = landed.listing_v2(pages)
    candidates = catalog.candidates_v2(listing, api_url, web_url, run.language).withColumn(
        "provider_code", F.lit(run.provider_code)
    )
    missing = catalog.listing_complete(landed.listing_pages(pages)).filter(~F.col("complete")).select(
        F.lit("incomplete").alias("rule"), F.lit("listing").alias("path"))
    asked = requests.whole_feeds(raw.sparkSession, {"listing": "first page"})
    refused = run_error(
        unanswered(raw, ["listing"]), requests.run_faults(requests.missing_feeds(asked, raw)), missing, listed_twice(candidates))
    selection = _bounded(run, incremental.select_by_timestamp(one_each(candidates), state, run.force), ["page_no", "item_pos"])
    code = fn.pct_decode(F.regexp_extract("url", r"/tables/([^/?]+)/metadata", 1))
    payloads = one_each(landed.metadata_v2(feed(raw, "metadata").withColumn(KEY, code)))
    no_answer = raw.filter(F.col("feed") == "metadata").withColumn(KEY, code).filter(
        ~F.coalesce(F.col("status").between(200, 299), F.lit(False))).select(
        KEY, F.lit("response").alias("rule"), F.concat_ws("/", F.lit("metadata"), F.col("status").cast("string")).alias("path"))
    axes = cut_lineage(dimensions.axes_v2(payloads))
    dims, cats = dimensions.dimensions_v2(axes)
    details = dimensions.category_details(axes)
    nested = documents.nested_dimensions(dims, enrich.enrich_categories(cats, details, [KEY, "dim_id", "cat_id"]))
    links = F.create_map(F.lit("links"), F.col("links"), F.lit("variable_names"), F.col("variable_names").cast("variant"))
    chosen = (
        selection.filter("should_fetch")
        .withColumn("subject_label", absent("string"))
        .withColumn("official_statistics", absent("boolean"))
        .withColumn("contact", absent(f"array<{schemas.CONTACT}>"))
        .withColumn("extension", links)
        .withColumn("metadata_url", documents.metadata_url(F.col("links"), F.col("language"), F.col("metadata_url")))
        .withColumn("adapter", F.lit("pxweb_v2"))
    )
    payload = payloads.select(KEY, F.col("payload.note").alias("note"), F.col("payload.extension").alias("extension"))
    detail = documents.metadata_doc(enrich.merge_metadata(chosen, payload, KEY), nested)
    pairs = documents.dataset_doc(chosen).join(sorted_side(detail), KEY)
    p = F.col("payload")
    lists = payloads.select(KEY, p["id"].alias("id"), F.map_keys(p["dimension"]).alias("dimension_keys"))
    clashes = payloads.select(
        KEY, fn.role_conflicts(fn.normalize_role(F.try_parse_json(p["role"]))).alias("_c")
    )
    role = F.explode(F.map_from_arrays(F.array(*map(F.lit, fn.ROLES)), F.array(*[F.col("_r")[r] for r in fn.ROLES])))
    buckets = payloads.select(KEY, fn.normalize_role(F.try_parse_json(p["role"])).alias("_r")).select(KEY, role.alias("role", "_ids"))
    roles = buckets.select(KEY, "role", F.posexplode("_ids").alias("role_pos", "dim_id"))
    faults = _first_faults(
        no_answer.filter(F.col(KEY) != ""),
        quality.check_axes(lists, [KEY]),
        quality.check_categories(cats, [KEY, "dim_id"]),
        _structure_faults(axes, cats),
        quality.violations(clashes, [KEY], [("two_roles", "role", F.size("_c") > 0)]),
        quality.check_roles(dims, roles, KEY),
        *_document_faults(chosen, dims, details, cats),
    )
    return Result(run, _outcomes(run, selection, pairs, faults, refused), refused)


def v1_tables(raw: DataFrame, api_url: str, web_url: str | None) -> tuple[DataFrame, bool]:
    """Table occurrences of one database: the web tree matched with the flat list, or the
    folder tree where either is missing; and whether the tree was walked."""
    entries = landed.nav_entries(feed(raw, "nav").withColumn("parent_path", _folder_of(api_url)))
    flat = landed.flat_catalog(feed(raw, "flat"))
    pages = feed(raw, "web").select("url", F.col("body").alias("html"))

    def walked() -> tuple[DataFrame, bool]:
        tables = catalog.walk(entries)
        return tables.withColumn("published", F.col("updated")).withColumn("href", absent("string")), True

    unusable = flat.isEmpty() or not landed.flat_faults(flat).isEmpty()
    if web_url is None or unusable or pages.isEmpty():
        return walked()
    web = html.web_catalog(pages).filter(fn.within_root(F.col("href"), F.lit(web_url)))
    if not web.filter(F.col("table_id").isNull()).isEmpty():  # a link without an id: the tree is no catalogue
        return walked()
    nav = catalog.web_only_metadata(web, flat, entries)
    matched = catalog.match_metadata(web, flat, nav)
    if matched.isEmpty():
        return walked()
    spoken = raw.sparkSession.range(1).select(
        fn.api_language(F.lit(api_url)).alias("api"), fn.web_language(F.lit(web_url)).alias("web")
    ).first()
    overrides = None
    if spoken.api and spoken.web and spoken.api != spoken.web:
        overrides = catalog.override_labels(matched, entries)
    return catalog.web_categories(matched, overrides).select(
        F.col("path_key").alias("path"), F.col("table_id").alias("id"), "title", "updated", "published", "categories", "href"
    ), False


def _folder_of(api_url: str) -> Column:
    """Folder path of a landed folder listing, from its address below the database root."""
    below = F.substring(F.regexp_replace("url", r"\?.*$", ""), len(api_url.rstrip("/")) + 1, 1 << 20)
    tokens = fn.path_tokens(below)
    return fn.path_string(tokens)


def tables_v1(
    raw: DataFrame, state: DataFrame, run: Run, api_url: str, web_url: str | None = None, cell_limit: int | None = None
) -> DataFrame:
    """Outcomes of :func:`run_tables_v1`."""
    return run_tables_v1(raw, state, run, api_url, web_url, cell_limit).outcomes


def _answer_faults(raw: DataFrame, owner: DataFrame, name: str) -> DataFrame:
    """Datasets whose answer of one feed has an error status."""
    bad = raw.filter((F.col("feed") == name) & ~F.coalesce(F.col("status").between(200, 299), F.lit(False)))
    return bad.join(sorted_side(owner), "url").groupBy(KEY).agg(F.min(F.col("status").cast("string")).alias("_s")).select(
        KEY, F.lit("response").alias("rule"), F.concat_ws("/", F.lit(name), "_s").alias("path"))


def run_tables_v1(
    raw: DataFrame, state: DataFrame, run: Run, api_url: str, web_url: str | None = None, cell_limit: int | None = None
) -> Result:
    """Catalogue, metadata and samples of one database. ``cell_limit`` is what the samples were asked
    with: two categories of each axis, or one where that would be more cells; None: never cut."""
    configure(raw.sparkSession)
    tables, walked = v1_tables(raw, api_url, web_url)
    tables = cut_lineage(tables)
    found, paths = catalog.collapse_occurrences(tables)
    first = catalog.canonical(tables).select(F.col("id").alias(KEY), F.col("path").alias("_path"), F.col("href").alias("web_url"))
    nodes = paths.select(F.col("id").alias(KEY), "path_no", F.transform(
        "categories", lambda c: F.struct(c["id"].alias("code"), c["name"].alias("label"))).alias("nodes"))
    listed = nodes.groupBy(KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("path_no", "nodes"))), lambda x: x["nodes"]).alias("paths"))
    address = fn.table_api_url(F.lit(api_url), fn.path_tokens(F.col("_path")), F.col(KEY))
    candidates = (
        found.join(sorted_side(first), KEY).join(sorted_side(listed), KEY, "left")
        .withColumn("provider_code", F.lit(run.provider_code)).withColumn("language", F.lit(run.language))
        .withColumn("metadata_url", address).withColumn("data_url", address).withColumn("adapter", F.lit("pxweb_v1"))
        .withColumn("order_key", F.lower(KEY))
    )
    root = F.regexp_replace(F.regexp_replace("url", r"\?.*$", ""), "/+$", "") == api_url.rstrip("/")
    entries = landed.nav_entries(feed(raw, "nav").withColumn("parent_path", _folder_of(api_url)))
    # A tree that was walked has an answer for each folder that it lists; matched tables ask for none.
    asked = requests.folder_requests(entries, api_url) if walked else requests.whole_feeds(raw.sparkSession, {})
    refused = run_error(
        unanswered(raw, ["nav"], ~root), requests.run_faults(requests.missing(asked, raw)), listed_twice(candidates))
    selection = _bounded(run, incremental.select_by_timestamp(one_each(candidates), state, run.force), ["order_key", KEY])

    owner = selection.select(KEY, F.col("metadata_url").alias("url"))
    answers = feed(raw, "metadata").join(sorted_side(owner), "url")
    variables = cut_lineage(landed.metadata_v1(answers))
    dims, cats = dimensions.dimensions_v1(variables)
    spans = dimensions.v1_periods(dims, cats)
    sizes = cats.groupBy(KEY, "pos", "dim_id").agg(F.count("*").alias("n"))
    keep = dimensions.sample_selection(sizes, KEY, cell_limit).select(KEY, "dim_id", "keep")
    wanted = cats.join(sorted_side(keep), [KEY, "dim_id"]).filter("ordinal < keep").groupBy(KEY, "dim_id").agg(
        F.array_sort(F.collect_list("cat_id")).alias("cat_ids"))
    # Only whether the contents axis has exactly one code matters, and then which.
    codes = cats.filter(F.col("dim_id") == enrich.CONTENTS).groupBy(KEY).agg(F.count("*").alias("_n"), F.min("cat_id").alias("_first"), F.max("cat_id").alias("_last"))
    real = codes.select(KEY, F.when(F.col("_n") == 1, F.array("_first")).otherwise(F.array("_first", "_last")).alias("contents"))
    samples = one_each(landed.sample_v1(feed(raw, "sample").join(sorted_side(owner), "url")))
    fixed = cut_lineage(
        enrich.fix_placeholder(samples.withColumn("_all", F.col("sample")).join(sorted_side(real), KEY, "left"))
    )
    axes = dimensions.axes_v2(fixed.select(KEY, F.struct(
        F.col("sample.id").alias("id"), absent("string").alias("role"), F.col("sample.dimension").alias("dimension")).alias("payload")))
    sampled, _ = dimensions.dimensions_v2(axes)
    sampled = sampled.withColumn("extras", F.map_filter("extras", lambda k, v: k != "elimination"))
    rich = enrich.enrich_dimensions(
        dims.withColumn("note", absent("array<string>")).withColumn("link", absent("variant"))
        .withColumn("extras", fn.overlay(F.col("extras"), F.create_map(F.lit("position"), F.col("pos").cast("variant")))),
        sampled, [KEY, "dim_id"])
    nested = documents.nested_dimensions(
        rich, enrich.enrich_categories(cats, dimensions.category_details(axes), [KEY, "dim_id", "cat_id"]))

    extension = F.col("_all.extension")
    facts = fixed.select(
        KEY, F.try_variant_get(extension, "$.px", "variant").alias("px"), F.col("_all.source").alias("source"), F.col("_all.note").alias("note"))
    titles = variables.select(KEY, "title").distinct()
    chosen = selection.filter("should_fetch").join(sorted_side(titles), KEY, "left").withColumn("label", F.coalesce("title", "label"))
    for name, kind in (("description", "string"), ("time_unit", "string"), ("first_period", "string"), ("last_period", "string"),
                       ("discontinued", "boolean"), ("official_statistics", "boolean"), ("source", "string"), ("note", "array<string>")):
        chosen = chosen.withColumn(name, absent(kind))
    promoted = enrich.promote_px(chosen, facts, KEY).withColumn("extension", F.struct("px"))
    pairs = documents.dataset_doc(promoted, spans).join(sorted_side(documents.metadata_doc(promoted, nested)), KEY)

    missing = wanted.select(KEY).distinct().join(sorted_side(fixed.select(KEY)), KEY, "left_anti").select(
        KEY, F.lit("missing").alias("rule"), F.lit("sample").alias("path"))
    placeholders = fixed.filter("fault is not null").select(KEY, F.col("fault").alias("rule"), F.lit("sample/placeholder").alias("path"))
    texts = promoted.drop("first_period", "last_period").join(sorted_side(spans.select(
        KEY, F.col("first_period").cast("string").alias("first_period"), F.col("last_period").cast("string").alias("last_period"))), KEY, "left")
    asked = requests.dataset_requests(selection.filter("should_fetch"), "metadata", F.col("metadata_url"))
    faults = _first_faults(
        requests.dataset_faults(requests.missing(asked, raw)), _answer_faults(raw, owner, "metadata"), _answer_faults(raw, owner, "sample"),
        _structure_faults(dims, cats), quality.check_categories(cats, [KEY, "dim_id"]),
        quality.check_sample(wanted, fixed, KEY), missing, placeholders,
        *_document_faults(texts, sampled, dimensions.category_details(axes), cats))
    return Result(run, _outcomes(run, selection, pairs, faults, refused), refused)


KPI_FEEDS = ["kpi", "kpi_groups", "municipality", "ou", "data", "oudata", "changes"]


def _broken_chains(raw: DataFrame) -> DataFrame:
    """Requests whose pages do not hang together, or with a page that cannot be read whole. A
    request is its address without the page number. Most have one page that names no next one: these hang
    together, so only the others are kept and followed."""
    unpaged = F.when(F.col("url").contains("page="), F.regexp_replace("url", r"([?&])page=\d+&?", "$1")).otherwise(F.col("url"))
    request = F.concat_ws(" ", "feed", unpaged)
    one = Window.partitionBy("feed")
    pages = spread(landed.page_links(feed(raw, *KPI_FEEDS).withColumn("feed", request)), "feed")
    links = cut_lineage(
        pages.withColumns({"_pages": F.count("*").over(one), "_links": F.count("next_url").over(one)})
        .filter("_pages > 1 OR _links > 0 OR fault IS NOT NULL").drop("_pages", "_links"))
    broken = catalog.chain_status(links).filter(~F.col("complete")).select(
        F.lit("incomplete").alias("rule"), F.substring_index("feed", " ", 1).alias("path"))
    unread = links.filter("fault is not null").select(
        F.concat(F.lit("unusable "), "fault").alias("rule"), F.substring_index("feed", " ", 1).alias("path"))
    return unread.unionByName(broken)


def kpis(raw: DataFrame, state: DataFrame, run: Run, api_url: str | None = None) -> DataFrame:
    """Outcomes of :func:`run_kpis`."""
    return run_kpis(raw, state, run, api_url).outcomes


def run_kpis(raw: DataFrame, state: DataFrame, run: Run, api_url: str | None = None) -> Result:
    """KPI catalogue, change feeds and observations; both dataset kinds in one run.

    With ``api_url``, ``url`` of a landed response is the address of its request, and every request of the
    change feeds and of the observations must have an answer; without it, every feed must have one."""
    configure(raw.sparkSession)

    def values(name: str) -> DataFrame:
        entries = landed.paged_values(feed(raw, name))
        return entries.select("url", F.to_json("value").alias("body"))

    year = run.started_at.year
    groups = cut_lineage(kpi_source.kpi_groups(values("kpi_groups")).distinct())
    once = groups.dropDuplicates(["group_id"])  # unequal repeats refuse the run
    listed = cut_lineage(kpi.with_groups(kpi_source.kpis(values("kpi")), once))
    areas, units = kpi_source.areas(values("municipality")), kpi_source.units(values("ou"))
    candidates = kpi.candidates_kpi(listed, year).withColumn("provider_code", F.lit(run.provider_code)).withColumn(
        "updated", absent("timestamp"))
    started, checkpoint, force = F.lit(run.started_at).cast("timestamp"), F.lit(run.checkpoint).cast("timestamp"), F.lit(run.force)
    spark = raw.sparkSession
    full = spark.range(1).select(incremental.full_run(force, checkpoint, started), F.date_format(fn.window_start(started), "yyyy-MM-dd")).first()
    asked = requests.whole_feeds(spark, {"kpi": "catalogue", "kpi_groups": "catalogue", "municipality": "catalogue"}
                                 | ({} if listed.filter("has_ou_data").isEmpty() else {"ou": "catalogue"})
                                 | ({} if full[0] or api_url is not None else {"changes": "feed"}))
    lacks = requests.missing_feeds(asked, raw)
    if api_url is not None and not full[0]:
        lacks = lacks.unionByName(requests.missing(requests.change_requests(areas, api_url, year, full[1]), raw))
    no_areas = areas.agg(F.count("*").alias("n")).filter(F.lit(not full[0]) & (F.col("n") == 0)).select(
        F.lit("empty").alias("rule"), F.lit("municipality").alias("path"))
    changes = values("changes").select(
        fn.strip(F.get_json_object("body", "$.kpi")).alias("kpi_id"), F.when(F.col("url").contains("/oudata/"), "oudata").otherwise("data").alias("kind"))
    refused = run_error(
        unanswered(raw, KPI_FEEDS), requests.run_faults(lacks), no_areas, _broken_chains(raw),
        groups.filter("fault is not null").select(F.lit("malformed").alias("rule"), F.concat_ws("/", F.lit("kpi_groups"), "group_id").alias("path")),
        kpi.conflicting_groups(groups.filter("fault is null")).select(F.lit("conflict").alias("rule"), F.concat_ws("/", F.lit("kpi_groups"), "group_id").alias("path")),
        kpi.unknown_scopes(listed.filter("scope_type is not null")).select(F.lit("enum").alias("rule"), F.concat_ws("/", F.lit("kpi"), "kpi_id").alias("path")),
        changes.filter(~fn.has_id(F.col("kpi_id"))).select(F.lit("blank").alias("rule"), F.lit("changes/kpi").alias("path")),
        listed_twice(candidates),
    )
    selection = _bounded(
        run,
        incremental.select_by_window(
            one_each(candidates), state, changes, started, checkpoint, force),
        ["kpi_id", "kind"])

    seen = []
    for name, entity, kind in (("data", "municipality", "data"), ("oudata", "ou", "oudata")):
        obs = kpi_source.observations(feed(raw, name), entity)
        seen.append(presence.presence(obs, entity).withColumn("kpi", fn.add_kind(F.col("kpi"), F.lit(kind))))
    present = cut_lineage(seen[0].unionByName(seen[1]))
    titles = areas.select("area_id", "title").unionByName(units.select(F.col("ou_id").alias("area_id"), "title"))
    cats = presence.categories(present, titles, range_bounds(titles, "area_id", 64)).withColumnRenamed("kpi", KEY)
    both = kpi.kpi_kinds(listed).select("kpi_id", KEY, "is_divided_by_gender")
    gender = dimensions.gender_dimension(both.select(F.col(KEY).alias("kpi_id"), "is_divided_by_gender")).withColumnRenamed("kpi_id", KEY)
    cats = cats.select(KEY, "dim_id", "cat_id", "ordinal", "label").unionByName(gender.select(KEY, "dim_id", "cat_id", "ordinal", "label"))
    owners = kpi.unit_area(present.filter("dim_id = 'ou'").select(F.col("kpi").alias(KEY), F.col("cat_id").alias("ou_id")), units, areas)
    owner = F.struct(F.col("area_id").alias("municipality_id"), F.col("area_label").alias("municipality_label"))
    held = owners.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("ou_id", owner.alias("o")))).alias("_owners"))
    shape = F.array(*[
        F.struct(F.lit(d).alias("dim_id"), F.lit(p).alias("pos"), F.lit(label).alias("label"), absent("string").alias("_none") if role is None
                 else F.lit(role).alias("_none"), F.lit(d == "gender").alias("elimination"))
        for d, p, label, role in (("municipality", 0, "Kommun", "geo"), ("ou", 0, "Enhet", "geo"), ("year", 1, "År", "time"), ("gender", 2, "Kön", None))])
    dims = both.select(KEY, F.inline(shape)).withColumnRenamed("_none", "role").join(sorted_side(held), KEY, "left").withColumn(
        "extras", F.when((F.col("dim_id") == "ou") & F.col("_owners").isNotNull(), F.create_map(F.lit("category"), F.to_variant_object("_owners")))
        .otherwise(F.create_map().cast("map<string,variant>"))).drop("_owners")
    nested = documents.nested_dimensions(dims, cats)

    spans = present.filter("dim_id = 'year'").groupBy(F.col("kpi").alias(KEY)).agg(
        F.min("cat_id").alias("first_period"), F.max("cat_id").alias("last_period"))
    chosen = selection.filter("should_fetch").withColumn("first_period", absent("string")).withColumn("last_period", absent("string"))
    chosen = chosen.withColumn("official_statistics", absent("boolean")).withColumn("note", absent("array<string>")).withColumn(
        "adapter", F.lit("kolada")).withColumn("extension", F.struct(F.col("extension").alias("kolada")))
    pairs = documents.dataset_doc(chosen, spans).join(sorted_side(documents.metadata_doc(chosen, nested)), KEY)
    empty = chosen.select(KEY).join(sorted_side(spans.select(KEY)), KEY, "left_anti").select(
        KEY, F.lit("no live values").alias("rule"), F.lit("dimension").alias("path"))
    lacking = []
    if api_url is not None:
        due = chosen.select("kpi_id", KEY, "kind").join(sorted_side(listed.select("kpi_id", "scope_type")), "kpi_id")
        lacking = [requests.dataset_faults(requests.missing(requests.value_requests(due, areas, api_url, year), raw))]
    texts = chosen.drop("first_period", "last_period").join(sorted_side(spans), KEY, "left").withColumn("updated", absent("timestamp"))
    maps = cats.select(KEY, "dim_id", "cat_id", *[absent(k).alias(c) for c, k in (("unit", "variant"), ("coordinates", "array<double>"))]).limit(0)
    faults = _first_faults(
        *lacking, empty, quality.check_categories(cats, [KEY, "dim_id"]),
        *_document_faults(texts, dims.withColumn("nested_fault", F.lit(False)), maps, cats))
    return Result(run, _outcomes(run, selection, pairs, faults, refused), refused)

