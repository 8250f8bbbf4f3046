"""The given tables seen as catalogue inputs.

Rows become landed JSON bodies or catalogue rows here; the operators then read them as
they would read real responses. Where a body holds several rows, the rows of one body come
from a fixed span of keys, so no body grows with the data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.session import spread

API = "https://api.example.org/v2"
WEB = "https://www.example.org/pxweb"


def code(prefix: str, number: Column | str, width: int = 9) -> Column:
    n = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))


def div(c: str, n: int) -> Column:
    return F.floor(F.col(c) / n).cast("bigint")


def text_of(ts: Column) -> Column:
    """Timestamps leave as text, so that both engines print them alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- observations -------------------------------------------------------------

    @cached_property
    def observations(self) -> DataFrame:
        """lineitem with its supplier's nation as area; open lines carry a value."""
        return self._observed(self.lineitem)

    def _observed(self, lines: DataFrame) -> DataFrame:
        return lines.join(self.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
            code("N", "l_partkey").alias("kpi"),
            F.year("l_shipdate").alias("period"),
            F.lpad(F.col("s_nationkey").cast("string"), 4, "0").alias("entity"),
            F.col("l_returnflag").alias("gender"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("value"),
            (F.col("l_discount") >= 0.09).alias("isdeleted"),
        )

    @cached_property
    def observation_bodies(self) -> DataFrame:
        """One landed page per line: an entry with a real value and an empty one."""
        entry = F.struct(
            F.col("kpi"),
            F.col("period"),
            F.col("entity").alias("municipality"),
            F.array(
                F.struct("gender", "value", "isdeleted"),
                F.struct(F.lit("T").alias("gender"), F.lit(None).cast("double").alias("value"),
                         F.lit(None).cast("boolean").alias("isdeleted")),
            ).alias("values"),
        )
        return self._observed(self.lineitem).select(
            F.to_json(F.struct(F.array(entry).alias("values"))).alias("body")
        )

    # --- KPI catalogue -------------------------------------------------------------

    @cached_property
    def kpi_bodies(self) -> DataFrame:
        k = F.col("p_partkey")
        title = F.concat(
            F.lit(" "), "p_name",
            F.when(k % 50 == 0, " (-1998)").when(k % 11 == 0, " ( - 2030 )").otherwise(""),
            F.when(k % 13 == 0, F.concat(F.lit(" Källa: "), "p_type", F.lit("."))).otherwise(""),
        )
        description = (
            F.when(k % 5 == 1, "  Räknat per\\nkilometer.   Källa: Trafikverket, bl.a. VTI. Se ovan.  ")
            .when(k % 5 == 2, "Ingen")
            .when(k % 5 == 3, F.concat(F.lit("Källor: "), "p_brand", F.lit(". Mer")))
            .when(k % 5 == 4, "Källa:")
        )
        return spread(self.part, "p_partkey").select(
            F.to_json(
                F.struct(
                    F.when(k % 97 == 5, "  ").otherwise(
                        F.concat(F.lit(" "), code("N", "p_partkey"))
                    ).alias("id"),
                    title.alias("title"),
                    description.alias("description"),
                    (F.col("p_size") % 2 == 0).alias("is_divided_by_gender"),
                    F.when(k % 3 == 1, "K").when(k % 3 == 2, "L").otherwise(" ").alias(
                        "municipality_type"
                    ),
                    F.col("p_size").alias("publ_period"),
                    F.when(k % 4 == 0, 1).otherwise(0).alias("has_ou_data"),
                    F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("operating_area"),
                    F.when(F.col("p_size") % 3 == 0, "").otherwise("Resurser").alias("perspective"),
                    F.lit("T").alias("auspice"),
                )
            ).alias("body")
        )

    @cached_property
    def area_bodies(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.nation.select(
            F.to_json(
                F.struct(
                    F.concat(F.lit(" "), F.lpad(n.cast("string"), 4, "0")).alias("id"),
                    F.when(n % 10 != 3, F.col("n_name")).alias("title"),
                    F.when(F.col("n_regionkey") < 3, " K").otherwise("L ").alias("type"),
                )
            ).alias("body")
        )

    @cached_property
    def unit_bodies(self) -> DataFrame:
        s = F.col("s_suppkey")
        owner = F.lpad(F.col("s_nationkey").cast("string"), 4, "0")
        return self.supplier.select(
            F.to_json(
                F.struct(
                    code("V", "s_suppkey").alias("id"),
                    F.when(s % 20 != 7, F.col("s_name")).alias("title"),
                    F.when(s % 25 == 3, " ").when(s % 30 == 11, "9999").otherwise(owner).alias(
                        "municipality"
                    ),
                )
            ).alias("body")
        )

    @cached_property
    def group_bodies(self) -> DataFrame:
        """Groups by brand and span of 100 keys; one member per group is nobody's KPI."""
        block = div("p_partkey", 100)
        member = F.struct(F.concat(code("N", "p_partkey"), F.lit(" ")).alias("member_id"))
        stray = F.struct(F.concat(F.lit("X"), F.col("block")).alias("member_id"))
        title = F.when((F.col("block") % 7 == 6) & (F.col("p_brand") == "Brand#1"), "").otherwise(
            F.concat(F.lit("Grupp "), "p_brand")
        )
        return (
            spread(self.part.withColumn("block", block), "p_brand", "block").groupBy("p_brand", "block")
            .agg(F.collect_list(member).alias("members"))
            .select(
                F.to_json(
                    F.struct(
                        F.concat("p_brand", F.lit("/"), "block").alias("id"),
                        title.alias("title"),
                        F.concat("members", F.array(stray), F.slice("members", 1, 1)).alias("members"),
                    )
                ).alias("body")
            )
        )

    # --- listings ---------------------------------------------------------------------

    @cached_property
    def listing_entries(self) -> DataFrame:
        """Orders as listing entries with their page."""
        k, date = F.col("o_orderkey"), F.col("o_orderdate")
        unit = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "Annual")
            .when(F.col("o_orderpriority") == "2-HIGH", "Monthly")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Quarterly")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Daily")
        )
        entry = F.struct(
            F.when(k % 101 == 0, " ").otherwise(F.concat(F.lit(" "), code("O", "o_orderkey"))).alias("id"),
            F.when(k % 3 == 0, F.concat(F.lit("Order "), k.cast("string"))).alias("label"),
            F.when(k % 3 == 1, F.concat(F.lit("Titel "), k.cast("string"))).alias("title"),
            F.when(k % 17 == 0, "unknown").otherwise(iso(date)).alias("updated"),
            unit.alias("timeUnit"),
            F.when(k % 2 == 0, F.year(date).cast("string")).otherwise("").alias("firstPeriod"),
            F.year(date).cast("string").alias("lastPeriod"),
            F.when(k % 4 == 0, "  ").when(k % 4 == 1, "Text ").alias("description"),
            F.when(k % 5 == 0, F.concat(F.lit(" Not "), F.col("o_orderstatus"))).alias("note"),
            F.col("o_orderpriority").alias("subjectCode"),
            F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "No")
            .otherwise("maybe").alias("discontinued"),
            F.array(F.lit("Orders"), F.col("o_orderpriority")).alias("paths"),
            F.array(F.lit("time"), F.lit(None).cast("string"), F.lit("value")).alias("variableNames"),
        )
        return self.orders.select(
            "o_orderkey", div("o_orderkey", 10_000).cast("string").alias("scope"),
            (div("o_orderkey", 1000) % 10 + 1).cast("int").alias("page_no"), entry.alias("entry"),
        )

    @cached_property
    def listing_bodies(self) -> DataFrame:
        """Pages of 1 000 keys, ten pages promised per scope; one page in forty is broken."""
        packed = F.array_sort(F.collect_list(F.struct("o_orderkey", "entry")))
        page = F.struct(F.col("page_no").alias("pageNumber"), F.lit(10).alias("totalPages"))
        broken = (F.col("scope").cast("bigint") % 4 == 2) & (F.col("page_no") == 8)
        return (
            self.listing_entries.groupBy("scope", "page_no")
            .agg(F.transform(packed, lambda x: x["entry"]).alias("tables"))
            .select(
                "scope", "page_no",
                F.when(broken, F.to_json(F.struct(page.alias("page"))))
                .otherwise(F.to_json(F.struct("tables", page.alias("page")))).alias("body"),
            )
        )

    @cached_property
    def candidates(self) -> DataFrame:
        """Orders as finished candidates of one provider."""
        return self.orders.select(
            F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"),
            F.lit("sv").alias("language"), F.col("o_orderdate").cast("timestamp").alias("updated"),
            "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey",
        )

    @cached_property
    def state(self) -> DataFrame:
        k, date = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        day = F.expr("interval 1 day")
        # Every tenth row is of another dataset, so some candidates have no state and the reverse.
        ident = F.when(k % 10 == 9, code("X", "o_orderkey")).otherwise(code("O", "o_orderkey"))
        return self.orders.select(
            F.lit("demo").alias("provider_code"), ident.alias("dataset_code"),
            F.lit("sv").alias("language"),
            F.when(k % 7 == 0, date + day).when(k % 19 != 0, date).alias("source_updated_at"),
            F.when(k % 13 != 0, date + F.expr("interval 30 days")).alias("last_fetched_at"),
            ((F.col("o_orderstatus") == "F") & (k % 3 == 0)).alias("has_error"),
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        """Events as outcomes: a run per day, a dataset per user."""
        kind = F.col("event_type")
        outcome = (
            F.when(kind.isin("click", "purchase"), "saved").when(kind == "error", "failed")
            .otherwise("skipped")
        )
        return self.events.select(
            F.date_format("ts", "yyyyMMdd").alias("run_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            code("D", "user_id").alias("dataset_code"),
            outcome.alias("outcome"),
            F.date_trunc("hour", "ts").cast("timestamp").alias("source_updated_at"),
            "event_id", "value",
        )

    # --- table catalogues ----------------------------------------------------------------

    @cached_property
    def flat(self) -> DataFrame:
        """Flat list: every fifth id is its own, some stand twice, every third under a shorter path."""
        k = F.col("p_partkey")
        ident = F.when(k % 5 == 0, code("X", "p_partkey")).otherwise(code("T", "p_partkey"))
        path = F.when(k % 3 == 0, F.concat(F.lit("/"), "p_type")).otherwise(
            F.concat(F.lit(" "), "p_type", F.lit(" / "), "p_brand", F.lit(" /"))
        )
        copies = F.when(k % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            self.part.withColumn("copy", F.explode(copies))
            .select(
                F.when(k % 2 == 0, F.lower(ident)).otherwise(ident).alias("id"),
                path.alias("path"),
                F.when(k % 6 != 1, F.concat("p_name", F.lit(" "), F.col("copy").cast("string"))).alias("title"),
                F.lit("2020-01-01T00:00:00").alias("published"),
                F.when(k % 4 == 1, "2021-05-06T07:08:09Z").alias("updated"),
                F.lit(1.0).alias("score"),
                div("p_partkey", 100).cast("int").alias("page_no"),
                ((k % 100) * 2 + F.col("copy")).cast("int").alias("item_pos"),
                "p_partkey",
            )
        )

    @cached_property
    def web(self) -> DataFrame:
        """Web tree under type and brand; every fourth id is its own."""
        k = F.col("p_partkey")
        ident = F.when(k % 4 == 0, code("Y", "p_partkey")).otherwise(code("T", "p_partkey"))
        return self.part.select(
            ident.alias("table_id"),
            F.array("p_type", "p_brand").alias("category_ids"),
            F.array(F.concat("p_type", F.lit(" - Typ")), F.concat(F.lit("Märke "), "p_brand")).alias("category_names"),
            F.concat(F.lit("Webb "), "p_name").alias("title"),
            F.concat(F.lit("/t/"), ident, F.lit("/")).alias("href"),
            F.col("p_partkey").cast("int").alias("item_pos"),
            "p_partkey",
        )

    @cached_property
    def folder_entries(self) -> DataFrame:
        """Folder listings of the same tree; every tenth id is its own."""
        k = F.col("p_partkey")
        ident = F.when(k % 10 == 0, code("Z", "p_partkey")).otherwise(code("T", "p_partkey"))
        return self.part.select(
            F.concat(F.lit("/"), "p_type", F.lit("/"), "p_brand").alias("parent_path"),
            k.cast("int").alias("item_pos"),
            ident.alias("id"),
            F.concat(F.lit("Mapp "), "p_name").alias("text"),
            F.lit("t").alias("type"),
            F.lit("2022-02-02").alias("updated"),
        )

    @cached_property
    def nav(self) -> DataFrame:
        """Folder tree region / nation / customer. Every eighth nation is listed as another; every
        tenth customer appears twice."""
        region = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
        r_of_n = F.concat(F.lit("/R"), F.col("n_regionkey").cast("string"))
        nation = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
        none = F.lit(None).cast("string")
        regions = self.region.select(
            F.lit("/").alias("parent_path"), F.col("r_regionkey").cast("bigint").alias("item_pos"),
            region.alias("id"), F.concat(region, F.lit(" – "), F.initcap("r_name")).alias("text"),
            F.lit("l").alias("type"), none.alias("updated"),
        )
        other = F.concat(F.when(F.col("n_nationkey") % 8 == 7, "Q").otherwise("N"), F.col("n_nationkey").cast("string"))
        nations = self.nation.select(
            r_of_n.alias("parent_path"), F.col("n_nationkey").cast("bigint").alias("item_pos"),
            other.alias("id"), F.concat(other, F.lit(". "), "n_name").alias("text"),
            F.lit("l").alias("type"), none.alias("updated"),
        )
        k = F.col("c_custkey")
        twice = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ident = F.concat(code("c", "c_custkey"), F.lit(".px"))
        customers = (
            self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("copy", F.explode(twice))
            .select(
                F.concat(r_of_n, F.lit("/"), nation).alias("parent_path"),
                (k * 2 + F.col("copy")).alias("item_pos"),
                F.when(F.col("copy") == 1, F.upper(ident)).otherwise(ident).alias("id"),
                F.when(k % 9 != 0, F.col("c_name")).alias("text"),
                F.lit("t").alias("type"), F.lit("2024-01-01T00:00:00Z").alias("updated"),
            )
        )
        return regions.unionByName(nations).unionByName(customers)

    @cached_property
    def nav_bodies(self) -> DataFrame:
        """The tree as landed folder listings, at most 200 positions per body."""
        entry = F.struct("item_pos", F.struct("id", "text", "type", "updated").alias("e"))
        return (
            self.nav.groupBy("parent_path", div("item_pos", 200).alias("block"))
            .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("es"))
            .select("parent_path", "block",
                    F.to_json(F.concat("es", F.array(
                        F.struct(F.lit("h1").alias("id"), F.lit("x").alias("text"),
                                 F.lit("h").alias("type"), F.lit(None).cast("string").alias("updated")),
                        F.struct(F.lit(" ").alias("id"), F.lit("x").alias("text"),
                                 F.lit("t").alias("type"), F.lit(None).cast("string").alias("updated")),
                    ))).alias("body"))
        )

    @cached_property
    def occurrences(self) -> DataFrame:
        """Tables seen under several paths: a part under each of its suppliers."""
        s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
        return self.lineitem.select(
            code("T", "l_partkey").alias("id"),
            F.concat(F.lit("/"), s).alias("path"),
            F.concat(F.lit("Tabell "), F.col("l_partkey").cast("string")).alias("title"),
            F.when(F.col("l_partkey") % 23 == 0, "broken").otherwise(iso(F.col("l_shipdate"))).alias("updated"),
            F.lit(None).cast("string").alias("published"),
            F.when(F.col("l_suppkey") % 9 == 0, F.array().cast("array<struct<id:string,name:string>>"))
            .otherwise(F.array(F.struct(s.alias("id"), F.concat(F.lit("Gren "), s).alias("name")))).alias("categories"),
        )

    # --- page chains ----------------------------------------------------------------------

    @cached_property
    def chain(self) -> DataFrame:
        """Conversation turns as linked pages; some lose a page, some loop back."""
        page = F.concat(F.lit("https://api.example.org/c/"), F.col("conv_id").cast("string"), F.lit("?page="))
        following = self.conversations.select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.lit(True).alias("more")
        ).distinct()
        link = F.when(F.col("more"), F.concat(F.lit("?page="), (F.col("turn") + 1).cast("string"))).when(
            F.col("conv_id") % 5 == 2, "?page=0"
        )
        return (
            self.conversations.join(following, ["conv_id", "turn"], "left")
            .filter(~((F.col("conv_id") % 5 == 1) & (F.col("turn") == 1)))
            .select(
                F.col("conv_id").cast("string").alias("feed"),
                F.concat(page, F.col("turn").cast("string")).alias("url"),
                F.col("turn").cast("int").alias("page_no"),
                F.to_json(
                    F.struct(
                        F.array(F.struct("role", F.length("text").alias("n")),
                                F.struct(F.lit("end").alias("role"), F.lit(0).alias("n"))).alias("values"),
                        link.alias("next_url"),
                    )
                ).alias("body"),
            )
        )

    # --- dimensions ------------------------------------------------------------------------

    @cached_property
    def axis_rows(self) -> DataFrame:
        """Three axes per span of 50 parts: types, brands and years."""
        offered = F.array(
            *[F.struct(F.lit(i).alias("pos"), F.lit(d).alias("dim_id"), c.alias("cat_id"), l.alias("label"))
              for i, (d, c, l) in enumerate([
                  ("Typ", F.col("p_type"), F.lower("p_type")),
                  ("ContentsCode", F.col("p_brand"), F.concat("p_brand", F.lit(" st"))),
                  ("Tid", (F.col("p_size") + 1950).cast("string"), (F.col("p_size") + 1950).cast("string")),
              ])]
        )
        return self.part.select(
            F.concat(F.lit("D"), div("p_partkey", 50).cast("string")).alias("dataset_code"),
            div("p_partkey", 50).alias("block"), F.inline(offered),
        ).distinct()

    @cached_property
    def axes(self) -> DataFrame:
        """Each axis with its sorted categories (at most 50)."""
        packed = F.array_sort(F.collect_list(F.struct("cat_id", "label")))
        return self.axis_rows.groupBy("dataset_code", "block", "pos", "dim_id").agg(packed.alias("cats"))

    @cached_property
    def v1_bodies(self) -> DataFrame:
        ids, labels = (F.col(f"cats.{f}") for f in ("cat_id", "label"))
        variable = F.struct(
            F.col("dim_id").alias("code"),
            F.when(F.col("dim_id") != "Typ", F.concat(F.col("dim_id"), F.lit(" text"))).alias("text"),
            F.transform(ids, lambda x: F.concat(F.lit(" "), x)).alias("values"),
            F.slice(labels, 1, F.greatest(F.size(labels) - F.col("block").cast("int") % 2, F.lit(1))).alias("valueTexts"),
            F.when(F.col("dim_id") == "Tid", True).alias("time"),
            F.when(F.col("dim_id") == "Typ", "yes").alias("elimination"),
            F.when(F.col("dim_id") == "Typ", "karta").alias("map"),
        )
        return (
            self.axes.groupBy("dataset_code", "block")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", variable.alias("v")))), lambda x: x["v"]).alias("variables"))
            .select("dataset_code", "block",
                    F.to_json(F.struct(F.concat(F.lit(" Titel "), "dataset_code").alias("title"), "variables")).alias("body"))
        )

    def _axis_json(self, forms: bool) -> Column:
        ids, labels = (F.col(f"cats.{f}") for f in ("cat_id", "label"))
        index_map = F.to_json(F.map_from_arrays(ids, F.transform(ids, lambda x, i: i)))
        form = F.col("block") % 3 if forms else F.lit(0)
        index = F.when(form == 0, F.concat(F.lit('"index":'), index_map, F.lit(","))).when(
            form == 1, F.concat(F.lit('"index":'), F.to_json(ids), F.lit(","))
        ).otherwise("")
        unit = F.when(
            F.col("dim_id") == "ContentsCode",
            F.concat(
                F.lit(',"unit":'),
                F.to_json(F.map_from_arrays(
                    ids, F.transform(ids, lambda x: F.struct(F.concat(x, F.lit("/kg")).alias("label"),
                                                             F.lit(2).alias("decimals"))))),
            ),
        ).otherwise("")
        return F.concat(
            F.lit('{"label":"'), F.when(F.col("dim_id") != "Typ", F.concat(F.col("dim_id"), F.lit(" text"))).otherwise(""),
            F.lit('","note":["  Not  ",""],"extension":{"elimination":"'),
            F.when(F.col("dim_id") == "Typ", "true").otherwise("maybe"),
            F.lit('","show":"code"},"extra":'), F.col("pos").cast("string"),
            F.lit(',"category":{'), index, F.lit('"label":'), F.to_json(F.map_from_arrays(ids, labels)), unit,
            F.lit("}}"),
        )

    def _payload(self, forms: bool, head: Column, tail: Column, axes: DataFrame | None = None) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("pos", "dim_id", self._axis_json(forms).alias("j"))))
        axes = self.axes if axes is None else axes
        return (
            axes.groupBy("dataset_code", "block").agg(
                ordered.alias("_axes"),
                F.transform(F.array_sort(F.collect_list(F.struct("pos", F.size("cats").alias("n")))), lambda x: x["n"]).alias("sizes"),
            )
            .select(
                "dataset_code", "block",
                F.concat(
                    F.lit("{"), head, F.lit('"id":'), F.to_json(F.transform("_axes", lambda a: a["dim_id"])),
                    F.lit(',"dimension":{'),
                    F.array_join(F.transform("_axes", lambda a: F.concat(F.lit('"'), a["dim_id"], F.lit('":'), a["j"])), ","),
                    F.lit("}"), tail, F.lit("}"),
                ).alias("body"),
            )
        )

    @cached_property
    def v2_bodies(self) -> DataFrame:
        tail = F.concat(
            F.lit(',"role":{"time":["Tid"],"metric":[" ContentsCode ",""]},"note":" Payload ","extension":{"px":{"subject-area":"Area '),
            F.col("block").cast("string"),
            F.lit('","official-statistics":true},"contact":"Free text"}'),
        )
        return self._payload(True, F.lit(""), tail)

    @cached_property
    def sample_bodies(self) -> DataFrame:
        """Samples over the first two categories of each axis; every fifth has a wrong version."""
        head = F.concat(
            F.lit('"class":"dataset","version":"'), F.when(F.col("block") % 5 == 4, "1.0").otherwise("2.0"),
            F.lit('","size":'), F.to_json("sizes"), F.lit(","),
        )
        tail = F.lit(',"source":"Sample","extension":{"px":{"heading":["Tid"],"description":"Px text"}}')
        two = self.axes.withColumn("cats", F.slice("cats", 1, 2))
        return self._payload(False, head, tail, two)
