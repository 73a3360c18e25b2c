"""Shape the driver's test tables into this library's input shapes.

The test data has no repository or package documents, so we derive them from plain
columns with Spark expressions (every rule below is mirrored, independently, by the
DuckDB oracle SQL in ``snapflow.plans.oracle``). All shaping is per row or a
map-side-combined aggregate; nothing collects a group.

Fixed values: the rules are
- repos from ``events``: landing key ``'R' || user_id``; inner key ``'r' || user_id``,
  absent when ``event_id % 10 = 0``; ``k`` = ``props.k``; stars ``k * 500`` (absent when
  ``event_id % 10 = 3``, a JSON string when ``= 5``); forks ``k * 7`` (NULL when ``= 9``);
  watchers ``k * 500``; open_issues ``event_id % 50``; size ``floor(value)``;
  contributors ``k % 13``; releases ``k % 5``; latest release ``{tag 'v' || k, published ts}``
  unless ``k % 5 = 0``; topics ``[event_type]``; license ``'MIT'`` when ``k % 3 = 0``;
  description NULL when ``event_id % 10 = 1``; pushed_at absent when ``= 2``.
- packages from ``orders``: landing key ``'P' || o_custkey``; inner ``'p' || o_custkey``,
  absent when ``o_orderkey % 10 = 0``; version ``o_orderkey``; release_count
  ``o_orderkey % 20``; latest release info ``{}`` when ``o_orderkey % 20 = 0``; download
  statistics absent when ``o_orderkey % 10 = 4``, else day/week/month
  ``floor(price / 1000)``, ``floor(price / 100)``, ``floor(price * 20)``.
- mapping from ``customer``: technology ``c_name``; github ``'r' || c_custkey`` (NULL when
  ``c_custkey % 7 = 0``); pypi ``'p' || c_custkey`` (NULL when ``c_custkey % 11 = 0``).
- daily snapshots from ``lineitem`` per ``'s' || l_suppkey`` and ship day: stars
  ``sum(l_quantity)``, forks ``sum(l_linenumber)``, downloads ``count(*)``, open issues
  ``count_if(l_returnflag = 'R')``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.scalars import safe_ratio, tier
from snapflow.session import deal_rows
from snapflow.operators.metrics import POPULARITY_DEFAULT, POPULARITY_TIERS, USAGE_DEFAULT, USAGE_TIERS

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prepend(json_obj: Column, field_text: Column) -> Column:
    """Insert ``"name":value,`` text (or nothing) at the start of a JSON object."""
    return F.concat(F.lit("{"), field_text, F.substring(json_obj, F.lit(2), F.length(json_obj)))


def repo_documents(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(extracted_at, repo_name, raw_data)`` landing rows, one per event (plus ``keep``)."""
    m = F.col("event_id") % 10
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = deal_rows(events, "event_id", "ts", "user_id").select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"),
                                          m.alias("m"))
    ts_iso = F.date_format("ts", ISO_Z)
    rest = F.to_json(F.struct(
        F.when(F.col("m") != 0, F.concat(F.lit("r"), F.col("user_id").cast("string"))).alias("repo_name"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/e"),
                 F.col("event_id").cast("string")).alias("full_name"),
        F.when(F.col("m") != 1, F.concat(F.col("event_type"), F.lit(" events"))).alias("description"),
        F.col("event_type").alias("language"),
        F.when(F.col("m") != 9, F.col("k") * 7).alias("forks"),
        (F.col("k") * 500).alias("watchers"),
        (F.col("event_id") % 50).alias("open_issues"),
        F.floor("value").alias("size"),
        ts_iso.alias("created_at"),
        ts_iso.alias("updated_at"),
        F.when(F.col("m") != 2, ts_iso).alias("pushed_at"),
        F.lit("main").alias("default_branch"),
        (F.col("k") % 13).alias("contributors_count"),
        (F.col("k") % 5).alias("releases_count"),
        F.when(F.col("k") % 5 != 0, F.struct(
            F.concat(F.lit("v"), F.col("k").cast("string")).alias("tag_name"),
            ts_iso.alias("published_at"))).alias("latest_release"),
        F.array("event_type").alias("topics"),
        F.when(F.col("k") % 3 == 0, F.lit("MIT")).alias("license"),
        ts_iso.alias("extracted_at"),
    ))
    stars = (F.col("k") * 500).cast("string")
    stars_field = (F.when(F.col("m") == 3, F.lit(""))
                    .when(F.col("m") == 5, F.concat(F.lit('"stars":"'), stars, F.lit('",')))
                    .otherwise(F.concat(F.lit('"stars":'), stars, F.lit(","))))
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("extracted_at"),
        F.concat(F.lit("R"), F.col("user_id").cast("string")).alias("repo_name"),
        _prepend(rest, stars_field).alias("raw_data"),
        *keep,
    )


def package_documents(orders: DataFrame) -> DataFrame:
    """``(extracted_at, package_name, raw_data)`` landing rows, one per order."""
    ok = F.col("o_orderkey")
    price = F.col("o_totalprice")
    cust = F.col("o_custkey").cast("string")
    info = F.to_json(F.struct(
        F.when(ok % 10 != 0, F.concat(F.lit("p"), cust)).alias("package_name"),
        ok.cast("string").alias("version"),
        F.col("o_orderpriority").alias("summary"),
        F.lit("text/plain").alias("description_content_type"),
        F.when(ok % 4 != 0, F.concat(F.lit("site/"), cust)).alias("home_page"),
        F.col("o_orderstatus").alias("author"),
        F.col("o_orderstatus").alias("maintainer"),
        F.when(ok % 3 == 0, F.lit("BSD")).alias("license"),
        F.concat(F.col("o_orderstatus"), F.lit(","), F.col("o_orderpriority")).alias("keywords"),
        F.array("o_orderpriority").alias("classifiers"),
        F.array().cast("array<string>").alias("requires_dist"),
        F.lit(">=3.8").alias("requires_python"),
        F.create_map(F.lit("Home"), F.concat(F.lit("site/"), cust)).alias("project_urls"),
        (ok % 20).alias("release_count"),
        F.when(ok % 10 != 4, F.floor(price / 1000)).alias("downloads_last_day"),
        F.when(ok % 10 != 4, F.floor(price / 100)).alias("downloads_last_week"),
        F.when(ok % 10 != 4, F.floor(price * 20)).alias("downloads_last_month"),
        F.date_format("o_orderdate", ISO_Z).alias("extracted_at"),
    ))
    release_info = F.when(ok % 20 == 0, F.lit("{}")).otherwise(F.to_json(F.struct(
        F.date_format("o_orderdate", ISO_LOCAL).alias("upload_time"),
        F.lit("py3").alias("python_version"),
        (ok % 1000).alias("size"),
        F.concat(F.lit("pkg-"), ok.cast("string"), F.lit(".whl")).alias("filename"),
    )))
    field = F.concat(F.lit('"latest_release_info":'), release_info, F.lit(","))
    return deal_rows(orders, "o_orderkey", "o_custkey", "o_orderdate").select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("extracted_at"),
        F.concat(F.lit("P"), cust).alias("package_name"),
        _prepend(info, field).alias("raw_data"),
    )


def mapping(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        F.col("c_name").alias("technology_name"),
        F.when(key % 7 != 0, F.concat(F.lit("r"), key.cast("string"))).alias("github_repo"),
        F.when(key % 11 != 0, F.concat(F.lit("p"), key.cast("string"))).alias("pypi_package"),
    )


def daily_snapshots(lineitem: DataFrame) -> DataFrame:
    """One row per supplier and ship day (pre-aggregated map-side)."""
    return (lineitem
            .groupBy(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("technology_name"),
                     F.to_date("l_shipdate").alias("snapshot_date"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("github_stars"),
                 F.sum(F.col("l_linenumber").cast("bigint")).alias("github_forks"),
                 F.count(F.lit(1)).alias("pypi_downloads_daily"),
                 F.count_if(F.col("l_returnflag") == "R").alias("open_issues")))


def snapshot_metrics(snap: DataFrame) -> DataFrame:
    """Daily snapshots in the shape of the metrics fact (the history input)."""
    nb, nt = F.lit(None).cast("bigint"), F.lit(None).cast("timestamp_ntz")
    return snap.select(
        "technology_name",
        F.col("technology_name").alias("github_repo"),
        F.lit(None).cast("string").alias("pypi_package"),
        "github_stars", "github_forks",
        F.col("github_stars").alias("github_watchers"),
        "pypi_downloads_daily",
        nb.alias("pypi_downloads_weekly"), nb.alias("pypi_downloads_monthly"),
        "open_issues",
        nb.alias("contributors_count"), nb.alias("github_releases"), nb.alias("pypi_release_count"),
        safe_ratio("github_forks", "github_stars").alias("fork_to_star_ratio"),
        F.lit(0.0).alias("stars_per_contributor"),
        tier("github_stars", POPULARITY_TIERS, POPULARITY_DEFAULT).alias("popularity_tier"),
        tier(F.lit(None).cast("bigint"), USAGE_TIERS, USAGE_DEFAULT).alias("usage_tier"),
        nt.alias("github_created_at"), nt.alias("github_updated_at"),
        nt.alias("latest_release_published_at"), nt.alias("latest_release_upload_time"),
        "snapshot_date",
        F.col("snapshot_date").cast("timestamp_ntz").alias("last_updated_at"),
    )


ISO_FRAC_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def repo_responses(events: DataFrame) -> DataFrame:
    """Landed API responses ``(entity, endpoint, status, body)``: main, contributors, releases per user.

    Fixed values: entity ``'r' || user_id``; main 404 when ``user_id % 13 = 5``, 201 when
    ``% 8 = 6``, its body not JSON when ``% 17 = 3``, a list, null or text when it is 6, 9
    or 12; contributors 500 when ``% 7 = 3``, their body null, text or a status 203 when
    ``% 23`` is 4, 8 or 11; releases 403 when ``% 11 = 4``, ``{}``, an object or an empty
    list when ``% 19`` is 7, 11 or 13; ``forks_count`` absent when ``% 4 = 1``; ``topics``
    absent when ``% 6 = 5``; license ``MIT`` when ``% 3 = 0``, a text when ``% 29 = 5``; an
    older main response, to be ignored, when ``% 5 = 2``; two keys named twice, the first
    time with other values, when ``% 31 = 2``. Lists are per event
    type, so each body is bounded by the number of event types, and both aggregations
    combine map-side.
    """
    u = F.col("user_id")
    ent = F.concat(F.lit("r"), u.cast("string"))
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum(F.floor("value")).alias("size"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sort_array(F.collect_set("event_type")).alias("types"))
    main_body = F.to_json(F.struct(
        F.concat(F.lit("u"), u.cast("string")).alias("full_name"),
        F.element_at("types", 1).alias("language"),
        F.col("n").alias("stargazers_count"),
        F.when(u % 4 != 1, F.col("clicks")).alias("forks_count"),
        F.col("n").alias("watchers_count"),
        F.col("errors").alias("open_issues_count"),
        F.col("size").alias("size"),
        F.date_format("first_ts", ISO_Z).alias("created_at"),
        F.date_format("last_ts", ISO_Z).alias("updated_at"),
        F.date_format("last_ts", ISO_Z).alias("pushed_at"),
        F.lit("main").alias("default_branch"),
        F.when(u % 6 != 5, F.col("types")).alias("topics"),
        F.when(u % 3 == 0, F.struct(F.lit("mit").alias("key"), F.lit("MIT").alias("name"))).alias("license"),
    ))
    main_body = F.when(u % 29 == 5, _prepend(F.regexp_replace(main_body, '"license":\\{[^}]*\\},?', ""), F.lit('"license":"MIT",'))
                       ).otherwise(main_body)
    main_body = F.when(u % 31 == 2, _prepend(main_body, F.lit('"stargazers_count":-1,"size":"x",'))).otherwise(main_body)
    broken = (F.when(u % 17 == 3, F.lit("<html>busy</html>")).when(u % 17 == 6, F.lit("[]")).when(u % 17 == 9, F.lit("null"))
              .when(u % 17 == 12, F.lit('"x"')))
    main = per_user.select(ent.alias("entity"), F.lit("main").alias("endpoint"),
                           F.when(u % 13 == 5, 404).when(u % 8 == 6, 201).otherwise(200).alias("status"),
                           F.coalesce(broken, main_body).alias("body"), F.col("last_ts").alias("fetched_at"))
    older = per_user.where(u % 5 == 2).select(
        ent.alias("entity"), F.lit("main").alias("endpoint"), F.lit(200).alias("status"),
        F.lit('{"full_name":"older","stargazers_count":999999}').alias("body"),
        (F.col("first_ts") - F.expr("interval 1 day")).alias("fetched_at"))
    contrib = per_user.select(ent.alias("entity"), F.lit("contributors").alias("endpoint"),
                              F.when(u % 7 == 3, 500).when(u % 23 == 11, 203).otherwise(200).alias("status"),
                              F.when(u % 23 == 4, F.lit("null")).when(u % 23 == 8, F.lit('"abc"')).otherwise(
                                  F.to_json(F.transform("types", lambda t: F.struct(t.alias("login"))))).alias("body"),
                              F.col("last_ts").alias("fetched_at"))
    per_type = events.groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"))
    rel = per_type.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(
        F.date_format("ts", ISO_FRAC_Z).alias("published_at"), F.col("event_type").alias("tag_name"))),
        asc=False).alias("rels"))
    releases = rel.select(ent.alias("entity"), F.lit("releases").alias("endpoint"),
                          F.when(u % 11 == 4, 403).otherwise(200).alias("status"),
                          F.when(u % 19 == 7, F.lit("{}")).when(u % 19 == 11, F.lit('{"message":"moved"}'))
                          .when(u % 19 == 13, F.lit("[]")).otherwise(F.to_json("rels")).alias("body"),
                          F.lit(None).cast("timestamp").alias("fetched_at"))
    return main.unionByName(older).unionByName(contrib).unionByName(releases)


def package_responses(orders: DataFrame) -> DataFrame:
    """Landed API responses: metadata and recent download statistics per customer.

    Fixed values: entity ``'p' || o_custkey``; metadata 500 when ``o_custkey % 13 = 7``, 203
    when it is 3, its body a list, null, text, without info (null) or releases (null) when
    ``% 17`` is 3, 5, 8, 11 or 13; statistics 203 when ``% 8 = 3``, their body a list, with
    null data or null when ``% 19`` is 4, 9 or 12;
    versions are order statuses with one file each (upload time = last order date of that
    status, size = its order count), the current version is the status of the latest
    order, ``'X'`` (not listed) when ``% 9 = 2``, file lists empty when ``% 9 = 5``;
    classifiers absent when ``% 5 = 0``; statistics 429 when ``% 8 = 1``, ``last_week``
    absent when ``% 8 = 6``; day/week/month = order count, ``sum(floor(price / 1000))``,
    ``sum(floor(price))``.
    """
    c = F.col("o_custkey")
    ent = F.concat(F.lit("p"), c.cast("string"))
    per_status = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.max("o_orderdate").alias("last"), F.count(F.lit(1)).alias("cnt"))
    files = F.when(c % 9 == 5, F.array().cast(
        "array<struct<upload_time:string,python_version:string,size:bigint,filename:string>>")).otherwise(
        F.array(F.struct(F.date_format("last", ISO_LOCAL).alias("upload_time"), F.lit("py3").alias("python_version"),
                         F.col("cnt").alias("size"),
                         F.concat(F.lit("pkg-"), F.col("o_orderstatus"), F.lit(".whl")).alias("filename"))))
    rel = per_status.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("o_orderstatus"), files))).alias("releases"))
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("pri"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("latest_status"),
        F.sum(F.floor(F.col("o_totalprice") / 1000)).alias("week"),
        F.sum(F.floor("o_totalprice")).alias("month"))
    j = per_cust.join(rel, "o_custkey")
    info = F.struct(
        F.when(c % 9 == 2, F.lit("X")).otherwise(F.col("latest_status")).alias("version"),
        F.col("pri").alias("summary"),
        F.concat(F.lit("c"), c.cast("string")).alias("author"),
        F.lit(">=3.8").alias("requires_python"),
        F.when(c % 5 != 0, F.array("pri")).alias("classifiers"),
    )
    meta = j.select(ent.alias("entity"), F.lit("metadata").alias("endpoint"),
                    F.when(c % 13 == 7, 500).when(c % 13 == 3, 203).otherwise(200).alias("status"),
                    F.when(c % 17 == 3, F.lit("[]")).when(c % 17 == 5, F.lit("null")).when(c % 17 == 8, F.lit('"x"'))
                    .when(c % 17 == 11, F.concat(F.lit('{"info":null,"releases":'), F.to_json("releases"), F.lit("}")))
                    .when(c % 17 == 13, F.concat(F.lit('{"releases":null,"info":'), F.to_json(info), F.lit("}")))
                    .when(c % 31 == 2, _prepend(F.to_json(F.struct(info.alias("info"), F.col("releases"))), F.lit('"info":{"version":"0"},')))
                    .otherwise(F.to_json(F.struct(info.alias("info"), F.col("releases")))).alias("body"),
                    F.lit(None).cast("timestamp").alias("fetched_at"))
    recent = per_cust.select(ent.alias("entity"), F.lit("recent").alias("endpoint"),
                             F.when(c % 8 == 1, 429).when(c % 8 == 3, 203).otherwise(200).alias("status"),
                             F.when(c % 19 == 4, F.lit("[]")).when(c % 19 == 9, F.lit('{"data":null}')).when(c % 19 == 12, F.lit("null"))
                             .otherwise(F.to_json(F.struct(F.struct(
                                 F.col("n").alias("last_day"),
                                 F.when(c % 8 != 6, F.col("week")).alias("last_week"),
                                 F.col("month").alias("last_month")).alias("data")))).alias("body"),
                             F.lit(None).cast("timestamp").alias("fetched_at"))
    return meta.unionByName(recent)
