"""Catalogue reconciliation: candidates, matches between listings, folder tree, page chains."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek import schemas
from kartotek.operators.numbering import first_per, last_per, ordinals
from kartotek.session import cut_lineage


def candidates_v2(
    listing: DataFrame, api_url: str, web_url: str | None, language: str
) -> DataFrame:
    """Listing entries as candidates; an entry without an id is dropped."""
    t, code = F.col("t"), F.col("dataset_code")
    description = t["description"]
    api = api_url.rstrip("/")
    if web_url is None:
        web = F.lit(None).cast("string")
    elif web_url.rstrip("/").endswith("/statbank/table"):
        web = F.concat(F.lit(web_url.rstrip("/") + "/"), code, F.lit("/"))
    else:
        web = F.concat(F.lit(f"{web_url.rstrip('/')}/{language}/table/"), code)
    # One typed parse per entry. Dropping entries inside the generator keeps the optimizer
    # from pulling the id test, and a second parse with it, below the projection.
    usable = F.filter(
        F.array(F.from_json("entry", schemas.LISTING_ENTRY)), lambda x: fn.has_id(x["id"])
    )
    parsed = listing.select("scope", "page_no", "item_pos", F.explode(usable).alias("t")).withColumn(
        "dataset_code", fn.strip(t["id"])
    )
    return parsed.select(
        "scope",
        "page_no",
        "item_pos",
        "dataset_code",
        F.lit(language).alias("language"),
        fn.first_truthy(t["label"], t["title"], code).alias("label"),
        fn.parse_ts(t["updated"]).alias("updated"),
        F.when(t["timeUnit"].isin(*fn.TIME_UNITS), t["timeUnit"]).otherwise("Other").alias(
            "time_unit"
        ),
        fn.first_truthy(t["firstPeriod"]).alias("first_period"),
        fn.first_truthy(t["lastPeriod"]).alias("last_period"),
        F.when(fn.has_id(description), description).alias("description"),
        t["source"].alias("source"),
        fn.normalize_note(t["note"]).alias("note"),
        t["subjectCode"].alias("subject_code"),
        fn.normalize_paths(t["paths"]).alias("paths"),
        fn.coerce_bool_variant(t["discontinued"]).alias("discontinued"),
        fn.encoded_url(
            F.concat(F.lit(f"{api}/tables/"), code, F.lit(f"/metadata?lang={language}"))
        ).alias("metadata_url"),
        F.concat(F.lit(f"{api}/tables/"), code, F.lit(f"/data?lang={language}")).alias("data_url"),
        web.alias("web_url"),
        t["links"].alias("links"),
        F.filter(t["variableNames"], lambda x: x.isNotNull()).alias("variable_names"),
    )


def candidates_v1_entry(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Flat entries as candidates with labelled paths; the last node is the subject. An
    entry without a readable date is dropped.

    ``labels`` holds one label per code. Codes are looked up once per distinct path, so the
    join does not grow with the entries.
    """
    stamp = F.when(
        F.coalesce(F.col("updated"), F.lit("")) != "", fn.parse_ts(F.col("updated"))
    ).otherwise(fn.parse_ts(F.col("published")))
    dated = entries.withColumn("_stamp", stamp).filter("_stamp is not null")
    codes = fn.compact_strings(F.split("path", "/"))
    nodes = (
        dated.select("path")
        .distinct()
        .select("path", F.posexplode_outer(codes).alias("pos", "code"))
        .join(labels.select("code", F.col("label").alias("_label")), "code", "left")
    )
    node = F.struct("pos", "code", F.coalesce("_label", "code").alias("label"))
    paths = nodes.groupBy("path").agg(
        F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), node))).alias("nodes")
    )
    last = F.try_element_at("nodes", F.lit(-1))
    kept = [c for c in ("id", "title", "api_url", "web_url") if c in entries.columns]
    return dated.join(paths, "path").select(
        *kept,
        F.col("_stamp").alias("updated"),
        F.transform("nodes", lambda n: F.struct(n["code"].alias("code"), n["label"].alias("label")))
        .alias("nodes"),
        last["code"].alias("subject_code"),
        last["label"].alias("subject_label"),
    )


def candidate_urls_v1(
    entries: DataFrame, api_url: str, web_url: str | None, language: str, database: str
) -> DataFrame:
    """API and web address of each flat entry."""
    db = fn.encode_segment(F.lit(database))
    codes = fn.compact_strings(F.split("path", "/"))
    table = fn.encode_segment(F.col("id"))
    api = F.concat_ws(
        "/", F.lit(f"{api_url.rstrip('/')}/{language}"), db, F.array_join(codes, "/"), table
    )
    web = F.lit(None).cast("string")
    if web_url is not None:
        web = F.concat(
            F.concat_ws("/", F.lit(f"{web_url.rstrip('/')}/{language}"), db), F.lit("/"), db,
            F.lit("__"), F.array_join(codes, "__"), F.lit("/"), table, F.lit("/"),
        )
    return entries.withColumn("api_url", api).withColumn("web_url", web)


def with_path_key(df: DataFrame, path: Column, ident: Column) -> DataFrame:
    """The two match keys: the path as text and the id without case."""
    return df.withColumn("path_key", path).withColumn("id_key", F.lower(ident))


def match_metadata(web: DataFrame, flat: DataFrame, nav: DataFrame) -> DataFrame:
    """Metadata for each web table: same id and path, else the first entry of that id,
    else the folder's own entry; a table with none is dropped.

    Every right side is reduced to one row per key first, so no join can multiply rows.
    """
    web = first_per(
        with_path_key(web, fn.path_string(F.col("category_ids")), F.col("table_id")),
        ["path_key", "id_key"],
        [F.col("item_pos")],
    )
    flat = with_path_key(flat, fn.path_string(fn.path_tokens(F.col("path"))), F.col("id"))
    place = [F.col("page_no"), F.col("item_pos")]
    fields = F.struct("title", "published", "updated", "score")

    def reduced(df: DataFrame, keys: Sequence[str], order: list[Column], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min_by(fields, F.struct(*order)).alias(name))

    exact = reduced(flat, ["path_key", "id_key"], place, "_exact")
    same_id = reduced(flat, ["id_key"], place, "_same")
    folder = nav.select("path_key", "id_key", fields.alias("_nav"))
    found = F.coalesce("_exact", "_same", "_nav")
    return (
        web.join(exact, ["path_key", "id_key"], "left")
        .join(folder, ["path_key", "id_key"], "left")
        .join(same_id, "id_key", "left")
        .withColumn("_found", found)
        .filter(F.col("_found").isNotNull())
        .select(
            "table_id",
            "path_key",
            "category_ids",
            "category_names",
            "href",
            F.when(F.col("_exact").isNotNull(), "exact")
            .when(F.col("_same").isNotNull(), "same_id")
            .otherwise("folder")
            .alias("tier"),
            fn.strip(
                fn.first_truthy(F.col("_found.title"), F.col("title"), F.col("table_id"))
            ).alias("title"),
            F.col("_found.published").alias("published"),
            F.col("_found.updated").alias("updated"),
            F.col("_found.score").alias("score"),
        )
    )


def web_only_metadata(web: DataFrame, flat: DataFrame, nav: DataFrame) -> DataFrame:
    """Web tables missing from the flat list, filled from their own folder's entries."""
    missing = (
        with_path_key(web, fn.path_string(F.col("category_ids")), F.col("table_id"))
        .join(flat.select(F.lower("id").alias("id_key")).distinct(), "id_key", "left_anti")
        .select("path_key", "id_key", "table_id", F.col("title").alias("_web_title"), "item_pos")
    )
    missing = last_per(missing, ["path_key", "id_key"], [F.col("item_pos")]).drop("item_pos")
    entries = nav.filter("type = 't'").select(
        F.col("parent_path").alias("path_key"),
        F.lower("id").alias("id_key"),
        "text",
        "updated",
        "item_pos",
    )
    entries = last_per(entries, ["path_key", "id_key"], [F.col("item_pos")]).drop("item_pos")
    return missing.join(entries, ["path_key", "id_key"]).select(
        "path_key",
        "id_key",
        "table_id",
        fn.first_truthy(F.col("text"), F.col("_web_title"), F.col("table_id")).alias("title"),
        F.col("updated").alias("published"),
        "updated",
        F.lit(1.0).alias("score"),
    )


def match_folder(entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """The folder meant by a category id: exact id, else without case, else without accents
    and punctuation. A tier counts only when exactly one folder fits."""

    def keyed(df: DataFrame, ident: str) -> DataFrame:
        """One row per tier with the key that tier compares."""
        keys = F.array(F.col(ident), F.lower(ident), fn.normalize_id(F.col(ident)))
        return df.select("*", F.posexplode(keys).alias("_tier", "_key"))

    place = ["parent_path", "_tier", "_key"]
    single = (
        keyed(entries.filter("type = 'l'").select("parent_path", "id", "text"), "id")
        .groupBy(*place)
        .agg(F.count("*").alias("_n"), F.first(F.struct("id", "text")).alias("_hit"))
        .filter("_n = 1")
    )
    asked = wanted.select("parent_path", "category_id").distinct()
    hits = keyed(asked, "category_id").join(single, place)
    best = first_per(
        hits.select("parent_path", "category_id", "_tier", "_hit"),
        ["parent_path", "category_id"],
        [F.col("_tier")],
    )
    names = F.array(*[F.lit(n) for n in ("exact", "caseless", "plain")])
    return best.select(
        "parent_path",
        "category_id",
        F.col("_hit.id").alias("folder_id"),
        F.col("_hit.text").alias("folder_text"),
        F.get(names, F.col("_tier")).alias("tier"),
    )


def child_path(parent: Column, ident: Column) -> Column:
    return F.concat(F.when(parent == "/", "").otherwise(parent), F.lit("/"), ident)


def chosen_folders(entries: DataFrame) -> DataFrame:
    """Each folder (parent_path, id, text) with the tiers in which it is the only one of its parent:
    ``_tier`` and the key that tier compares."""
    folders = entries.filter("type = 'l'").select("parent_path", "id", "text")
    keys = F.array(F.col("id"), F.lower("id"), F.col("plain"))
    tiers = _with_plain(folders, "id").select("*", F.posexplode(keys).alias("_tier", "_key"))
    single = tiers.groupBy("parent_path", "_tier", "_key").agg(F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return tiers.join(single, ["parent_path", "_tier", "_key"])


def _with_plain(rows: DataFrame, ident: str) -> DataFrame:
    """``plain``: the accent-free key, worked out once for each distinct id."""
    ids = rows.select(F.col(ident).alias("_id")).distinct().withColumn("plain", fn.normalize_id(F.col("_id")))
    return rows.join(ids, F.col(ident).eqNullSafe(F.col("_id"))).drop("_id")


def override_labels(paths: DataFrame, entries: DataFrame) -> DataFrame:
    """Category labels of whole paths, read from the folder tree. A path counts only when every
    level was matched, each below the folder that was matched above it.

    No loop over levels: every prefix of every distinct path meets the folders whose whole path has the
    same accent-free key, and of each parent the best single folder is taken. A path is matched when the
    folder of its last level has, for each of its own prefixes, the folder that was taken there."""
    tokens = paths.select(F.col("category_ids").alias("tokens")).distinct()
    ids = _with_plain(tokens.filter("size(tokens) > 0").select("tokens", F.posexplode("tokens").alias("level", "category_id")), "category_id")
    keyed = ids.groupBy("tokens").agg(F.array_sort(F.collect_list(F.struct("level", "category_id", "plain"))).alias("_ids"))
    prefixes = keyed.select("tokens", F.size("tokens").alias("depth"), F.posexplode("_ids").alias("_at", "_step"), "_ids").select(
        "tokens", "depth", "_at", F.col("_step.category_id").alias("category_id"), F.col("_step.plain").alias("_plain"),
        F.array_join(F.transform(F.slice("_ids", F.lit(1), F.col("_at") + 1), lambda x: F.coalesce(x["plain"], F.lit(""))), "/").alias("_closure"))

    folders = cut_lineage(chosen_folders(entries).withColumn("path", child_path(F.col("parent_path"), F.col("id"))))
    parts = folders.select("path").distinct().select("path", F.posexplode(F.split(F.expr("substring(path, 2)"), "/")).alias("level", "id"))
    closures = _with_plain(parts, "id").groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("level", F.coalesce("plain", F.lit("")).alias("p")))).alias("_p")).select(
        "path", F.array_join(F.transform("_p", lambda x: x["p"]), "/").alias("_closure"))
    key = F.get(F.array(F.col("category_id"), F.lower("category_id"), F.col("_plain")), F.col("_tier"))
    met = prefixes.join(closures, "_closure").join(folders.drop("plain"), "path").filter(key == F.col("_key"))
    taken = cut_lineage(first_per(
        met.select("tokens", "depth", "_at", "category_id", "parent_path", "path", "text", "_tier"),
        ["tokens", "_at", "parent_path"], [F.col("_tier")]))

    own = F.split(F.expr("substring(path, 2)"), "/")
    ends = taken.filter("_at = depth - 1").select("tokens", "depth", own.alias("own"), F.col("path").alias("end"))
    above = ends.select("tokens", "depth", "end", F.explode(F.transform(F.sequence(F.lit(1), F.size("own")), lambda i: F.struct(
        (i - 1).alias("_at"), F.concat(F.lit("/"), F.array_join(F.slice("own", F.lit(1), i), "/")).alias("path")))).alias("x")).select(
        "tokens", "depth", "end", "x.*")
    name = fn.strip_id_prefix(F.col("text"), F.col("category_id"))
    matched = above.join(taken.select("tokens", "_at", "path", "category_id", "text"), ["tokens", "_at", "path"]).groupBy("tokens", "depth", "end").agg(
        F.array_sort(F.collect_list(F.struct("_at", F.struct(F.col("category_id").alias("id"), name.alias("name")).alias("node")))).alias("_found"))
    return matched.filter(F.size("_found") == F.col("depth")).select(
        F.col("tokens").alias("category_ids"), F.transform("_found", lambda x: x["node"]).alias("categories"))


def web_categories(tables: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Categories of each table: web names without their id prefix, unless overridden."""
    own = F.zip_with(
        "category_ids",
        "category_names",
        lambda i, n: F.struct(i.alias("id"), fn.strip_id_prefix(n, i).alias("name")),
    )
    tables = tables.withColumn("_own", own)
    if overrides is None:
        return tables.withColumnRenamed("_own", "categories")
    return (
        tables.join(overrides, "category_ids", "left")
        .withColumn("categories", F.coalesce("categories", "_own"))
        .drop("_own")
    )


def catalog_order(ident: str = "id", path: str = "path") -> list[Column]:
    return [F.lower(ident), F.lower(path)]


def sort_catalog(df: DataFrame, ident: str = "id", path: str = "path") -> DataFrame:
    """Global catalogue order; a range-partitioned sort, for output only."""
    return df.orderBy(*catalog_order(ident, path))


def canonical(tables: DataFrame) -> DataFrame:
    """First occurrence of each table in catalogue order. Its rows share an id, so only the
    path decides; the date settles repeats of one path."""
    return first_per(tables, ["id"], [F.lower("path"), F.col("path"), F.col("updated")])


def valid_timestamp(df: DataFrame) -> DataFrame:
    """Rows whose updated or, failing that, published text is a date; adds it as ``stamp``."""
    stamp = F.coalesce(fn.parse_ts(F.col("updated")), fn.parse_ts(F.col("published")))
    return df.withColumn("stamp", stamp).filter("stamp is not null")


def _first_of_paths(tables: DataFrame) -> DataFrame:
    """First occurrence of each table in each of its category paths: what both the canonical
    occurrence and the list of paths are made from, in one pass over the occurrences."""
    return first_per(tables, ["id", "categories"], [F.lower("path"), F.col("path"), F.col("updated")])


def occurrence_paths(tables: DataFrame) -> DataFrame:
    """Distinct non-empty category paths of each table, numbered in catalogue order."""
    return _numbered(_first_of_paths(tables))


def _numbered(firsts: DataFrame) -> DataFrame:
    seen = firsts.filter(F.size("categories") > 0).select(
        "id", "categories", F.struct(F.lower("path").alias("key"), "path").alias("_at"))
    return ordinals(seen, ["id"], ["_at", "categories"], "path_no").drop("_at")


def collapse_occurrences(tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One candidate per table id, and its paths as rows. The date comes from the canonical
    occurrence alone: if that one is unreadable, the table is skipped. Occurrences are read once."""
    firsts = cut_lineage(_first_of_paths(tables))
    chosen = valid_timestamp(canonical(firsts))
    subject = F.try_element_at("categories", F.lit(-1))
    candidates = chosen.select(
        F.col("id").alias("dataset_code"),
        fn.first_truthy(F.col("title"), F.col("id")).alias("label"),
        F.col("stamp").alias("updated"),
        subject["id"].alias("subject_code"),
        subject["name"].alias("subject_label"),
        F.col("path").alias("canonical_path"),
    )
    return candidates, _numbered(firsts)


def reconcile_counts(flat: DataFrame, web: DataFrame, enriched: DataFrame) -> DataFrame:
    """How many ids only one side knows, and how many of those were filled. Each side is
    one column ``id_key``; tagging and one aggregate replace three set differences."""
    sides = {"flat": flat, "web": web, "nav": enriched}
    tagged = None
    for side, df in sides.items():
        rows = df.select("id_key", *[F.lit(s == side).alias(s) for s in sides])
        tagged = rows if tagged is None else tagged.unionByName(rows)
    per_id = tagged.groupBy("id_key").agg(*[F.max(s).alias(s) for s in sides])
    web_only = F.col("web") & ~F.col("flat")
    return per_id.agg(
        F.count_if(F.col("flat") & ~F.col("web")).alias("flat_only"),
        F.count_if(web_only).alias("web_only"),
        F.count_if(web_only & F.col("nav")).alias("enriched"),
        F.count_if(web_only & ~F.col("nav")).alias("unresolved"),
    )


def listing_complete(pages: DataFrame, scopes: DataFrame | None = None) -> DataFrame:
    """Per scope: every promised page landed and none is unusable. ``scopes`` are those that were to be
    listed: one without any page is incomplete, not absent."""
    whole = F.count_distinct("page_number") == F.max("total_pages")
    found = pages.groupBy("scope").agg(
        F.max("total_pages").alias("total_pages"),
        F.count_distinct("page_number").alias("landed_pages"),
        F.count_if(~F.col("usable")).alias("bad_pages"),
        (whole & (F.count_if(~F.col("usable")) == 0)).alias("complete"),
    )
    if scopes is None:
        return found
    return scopes.select("scope").distinct().join(found, "scope", "left").withColumns({
        "landed_pages": F.coalesce("landed_pages", F.lit(0)), "bad_pages": F.coalesce("bad_pages", F.lit(0)),
        "complete": F.coalesce("complete", F.lit(False))})


def walk(entries: DataFrame) -> DataFrame:
    """Tables reachable from the root, with the folders above them.

    A folder is reachable when every folder above it was listed, so each distinct folder
    looks up its own prefixes in one join: no loop over levels, and depth bounds the fan-out.
    """
    folders = first_per(
        entries.filter("type = 'l'").select(
            child_path(F.col("parent_path"), F.col("id")).alias("path"), "id", "text", "item_pos"
        ),
        ["path"],
        [F.col("item_pos")],
    ).select("path", "id", fn.strip_id_prefix(F.col("text"), F.col("id")).alias("name"))
    tokens = F.split(F.expr("substring(path, 2)"), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(tokens)),
        lambda i: F.concat(F.lit("/"), F.array_join(F.slice(tokens, 1, i), "/")),
    )
    above = folders.select("path", F.size(tokens).alias("depth"),
                           F.posexplode(prefixes).alias("level", "prefix"))
    names = folders.select(F.col("path").alias("prefix"), "id", "name")
    reached = (
        above.join(names, "prefix")
        .groupBy("path", "depth")
        .agg(F.array_sort(F.collect_list(F.struct("level", "id", "name"))).alias("found"))
        .filter(F.size("found") == F.col("depth"))
        .select(
            F.col("path").alias("parent_path"),
            F.transform(
                "found", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"))
            ).alias("categories"),
        )
    )
    tables = first_per(
        entries.filter("type = 't'").withColumn("id_key", F.lower("id")),
        ["parent_path", "id_key"],
        [F.col("item_pos")],
    )
    none = F.array().cast("array<struct<id:string,name:string>>")
    top = F.when(F.col("parent_path") == "/", none)
    return (
        tables.join(reached, "parent_path", "left")
        .withColumn("categories", F.coalesce("categories", top))
        .filter(F.col("categories").isNotNull())
        .select(
            F.col("parent_path").alias("path"),
            "id",
            fn.first_truthy(F.col("text"), F.col("id")).alias("title"),
            "updated",
            "categories",
        )
    )


def chain_status(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Check of ``next`` links per feed: one head, every next page landed, no page with two
    predecessors, no cycle.

    Cycles are found by pointer doubling: after log2(pages) self joins on the unique page
    key, only pages that never reach an end still point somewhere.
    """
    rows = cut_lineage(
        pages.groupBy("feed", "url").agg(
            F.min("next_url").alias("next_url"), F.count("*").alias("copies")
        )
    )
    incoming = (
        rows.filter("next_url is not null")
        .groupBy("feed", F.col("next_url").alias("url"))
        .agg(F.count("*").alias("incoming"))
    )
    joined = rows.join(incoming, ["feed", "url"], "full_outer").withColumn(
        "incoming", F.coalesce("incoming", F.lit(0))
    )
    if max_pages is None:
        max_pages = rows.groupBy("feed").count().agg(F.max("count")).first()[0] or 1
    ahead = rows.filter("next_url is not null").select("feed", "url", F.col("next_url").alias("jump"))
    turns = math.ceil(math.log2(max(max_pages, 2))) + 1
    for _ in range(turns):
        step = ahead.select("feed", F.col("url").alias("jump"), F.col("jump").alias("_next"))
        # An inner join: pages whose jump reached an end drop out, so the table shrinks.
        ahead = cut_lineage(
            ahead.join(step, ["feed", "jump"]).select("feed", "url", F.col("_next").alias("jump"))
        )
        if ahead.isEmpty():
            break
    endless = ahead.groupBy("feed").agg(F.count("*").alias("endless"))
    landed = F.col("copies").isNotNull()
    status = joined.groupBy("feed").agg(
        F.count_if(landed).alias("pages"),
        F.count_if(landed & (F.col("incoming") == 0)).alias("heads"),
        F.count_if(~landed).alias("missing"),
        F.count_if(F.col("incoming") > 1).alias("shared"),
    )
    broken = (
        (F.col("heads") != 1)
        | (F.col("missing") > 0)
        | (F.col("shared") > 0)
        | (F.col("endless") > 0)
    )
    whole = status.join(endless, "feed", "left").withColumn("endless", F.coalesce("endless", F.lit(0)))
    return whole.withColumn("complete", ~broken)
