"""Climate, transport and housing indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadastra.functions import domain, text
from cadastra.functions.dates import iso_text_parts, month_from_label, quarter_start
from cadastra.functions.numbers import mwh_to_gwh, percent_ratio
from cadastra.operators import aggs, filters, joins, names, quality, sets, windows
from cadastra.operators.joins import Lookup
from cadastra.sources.inline import local_table
from cadastra.sources.staging import stage

# The groups whose averages are weighted.
SCORE_GROUP = ["lsoa", "current_energy_rating", "property_type", "transaction_type", "cauthnm", "year"]


def deprivation_weighted_scores(properties: DataFrame) -> DataFrame:
    """Mean score per combined authority and year, weighted by the inverse deprivation rank.

    Scores and ranks are first averaged per small area, rating, type, transaction, authority and
    year; those averages are what is weighted.
    """
    groups = properties.groupBy(*SCORE_GROUP).agg(
        F.count("*").alias("n"), F.avg("imd").alias("imd"), F.avg("score").alias("score")
    )
    return groups.groupBy("cauthnm", "year").agg(aggs.inverse_weighted_mean("score", "imd").alias("weighted_score"))


def latest_places(series: DataFrame, value: str, period: str = "year") -> DataFrame:
    """Place of every authority in the latest period, highest value first, with ordinal text.

    The series is small but dear to compute, so it is written once before it is asked for its
    latest period and again for the rows.
    """
    summary = stage(series, "series")
    return windows.placement(filters.at_maximum(summary, period), value, period)


def a_rated_share(certs: DataFrame, authorities: DataFrame) -> DataFrame:
    """A-rated certificates against the rest per combined authority.

    ``a_to_rest_pct`` divides by the rest, not by the total, as the published series does.
    """
    joined = joins.enrich(certs, Lookup(authorities, {"local_authority": "ladcd"}, ["cauthnm"], "inner"))
    category = domain.rating_category("asset_rating_band")
    counts = joined.groupBy("cauthnm").agg(
        F.nullif(F.count_if(category == "A"), F.lit(0)).alias("a"),
        F.nullif(F.count_if(category == "B_G"), F.lit(0)).alias("b_g"),
    )
    return counts.withColumn("a_to_rest_pct", F.bround(percent_ratio("a", "b_g"), 1))


def emissions_per_capita(
    emissions: DataFrame, authorities: DataFrame, sub_sectors: list[str],
    extra_members: list[tuple] = (), relabel: tuple[str, str] | None = None,
) -> DataFrame:
    """Tonnes per head by combined authority and year for the given sub-sectors.

    ``extra_members`` adds authorities by hand and ``relabel`` renames the group they join.
    """
    if extra_members:
        authorities = sets.append_rows(authorities, list(extra_members))
    if relabel:
        old, new = relabel
        authorities = authorities.withColumn(
            "cauthnm", F.when(F.col("cauthnm") == old, new).otherwise(F.col("cauthnm"))
        )
    chosen = emissions.where(F.col("la_ghg_sub_sector").isin(*sub_sectors))
    joined = joins.enrich(chosen, Lookup(authorities, {"local_authority_code": "ladcd"}, ["cauthnm"], "inner"))
    return aggs.per_capita(
        joined, "cauthnm", "calendar_year", "local_authority_code",
        "territorial_emissions_kt_co2e", "mid_year_population_thousands",
    )


def check_sub_sectors(emissions: DataFrame, sub_sectors: list[str], column: str = "la_ghg_sub_sector") -> None:
    """Every requested sub-sector must occur in the table."""
    requested = local_table(emissions.sparkSession, [(s,) for s in sub_sectors], f"{column} string")
    quality.require_none(quality.unknown_values(requested, emissions, column), "sub-sector not in emissions table")


def sector_totals(
    emissions: DataFrame, sectors: list[str], year_start: int, exclude: list[str] = ()
) -> DataFrame:
    """Emissions by year and sector, sectors outside the list lumped to ``Other``."""
    source = emissions.where(F.col("calendar_year") >= year_start)
    if exclude:
        source = source.where(~F.col("local_authority").isin(*exclude))
    group = aggs.lump_other("la_ghg_sector", sectors).alias("group")
    return source.groupBy("calendar_year", group).agg(
        F.sum("territorial_emissions_kt_co2e").alias("emissions_by_sector")
    )


def sector_chart(totals: DataFrame, groups: list[str]) -> DataFrame:
    return aggs.pivot_wider(totals, "calendar_year", "group", "emissions_by_sector", groups)


def traffic_lookup(traffic: DataFrame, authorities: DataFrame) -> DataFrame:
    """Traffic code of each member authority from the most recent year of the traffic table."""
    latest = filters.at_maximum(traffic, "year").select(
        F.col("local_authority_id").alias("dft_la_id"), F.col("local_authority_code").alias("ladcd"), "year"
    )
    return joins.keep_listed(latest, authorities, {"ladcd": "ladcd"})


def car_ratio_series(flows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Mean share of cars in all motor vehicles by combined authority and year."""
    joined = joins.enrich(flows, Lookup(lookup, {"local_authority_id": "dft_la_id"}, ["cauthnm"], "inner"))
    ratio = percent_ratio("cars_and_taxis", "all_motor_vehicles")
    return joined.groupBy("cauthnm", "year").agg(F.avg(ratio).alias("mean_ratio"))


def chargers_long(chargers: DataFrame, authorities: DataFrame) -> DataFrame:
    """Wide charger sheet (one column per quarter and measure, ``x`` for missing) to a long series."""
    joined = joins.enrich(
        chargers, Lookup(authorities, {"local_authority_region_code": "ladcd"}, ["cauthnm"], "inner")
    )
    measures = names.matching(joined, "devices|population")
    ids = [c for c in joined.columns if c not in measures and c != "local_authority_region_name"]
    long = aggs.unpivot_longer(joined.select(*ids, *measures), ids, measures)
    variable = F.when(F.col("name").contains("charging"), "total_charging_devices").otherwise("per_100k_population")
    return long.select(
        *ids, month_from_label("name").alias("end_date"), variable.alias("variable"),
        F.nullif(F.col("value"), F.lit("x")).try_cast("double").alias("value"),
    )


def renewables_cumulative(generation: DataFrame, authorities: DataFrame, areas: DataFrame) -> DataFrame:
    """Yearly and cumulative generation per combined authority, and cumulative GWh per square kilometre."""
    joined = joins.enrich(
        generation, Lookup(authorities, {"la_code": "ladcd"}, ["cauthnm", "cauthcd"], "inner")
    )
    running = windows.running_total(joined, ["cauthnm", "cauthcd"], "year", "total_mwh", "total_mwh_cum")
    with_area = joins.enrich(running, Lookup(areas, {"cauthcd": "cauthcd"}, ["km2"], "inner", "area"))
    return with_area.withColumn("cum_gwh_km2", mwh_to_gwh(F.col("total_mwh_cum") / F.col("km2")))


def licences_long(licences: DataFrame, areas: DataFrame, area_key: str, since: str | None = None) -> DataFrame:
    """Wide licence table (one column per quarter) to a long dated series of the listed small areas."""
    quarters = names.matching(licences, r"^\d{4}")
    ids = [c for c in licences.columns if c not in quarters]
    kept = joins.keep_listed(licences, areas, {"lsoa11cd": area_key})
    long = aggs.unpivot_longer(kept, ids, quarters, "name", "count")
    dated = long.withColumn("date", quarter_start("name")).drop("name")
    return dated.where(F.col("date") >= F.lit(since).cast("date")) if since else dated


def improvement_costs(recommendations: DataFrame) -> DataFrame:
    """Mean indicative cost and number of recommendations per improvement, most frequent first.

    Rows with any null are left out; ranges without an upper end count but have no mean cost.
    """
    complete = recommendations.dropna("any")
    cost = domain.cost_bounds("indicative_cost")["mean"]
    summary = complete.groupBy("improvement_id_text").agg(
        F.avg(cost).alias("mean_cost_of_improvement"), F.count("*").alias("count")
    )
    return summary.orderBy(F.desc("count"), "improvement_id_text")


def monitoring_sites(sites: DataFrame, photo_base: str) -> DataFrame:
    """Sites with coordinates and photo links; the combined point column goes."""
    place = text.lat_lon("geo_point_2d")
    number = F.col("siteid").cast("string")
    return sites.select(
        F.col("siteid").alias("site_id"),
        *[c for c in sites.columns if c not in ("siteid", "geo_point_2d", "photopath", "colocated")],
        F.coalesce(F.col("colocated").cast("double"), F.lit(0.0)).cast("int").alias("colocated"),
        place["latitude"].alias("latitude"),
        place["longitude"].alias("longitude"),
        F.concat(F.lit(photo_base + "thumbs/"), number, F.lit(".jpg")).alias("thumbnail_photo"),
        F.concat(F.lit(photo_base + "full/"), number, F.lit(".jpg")).alias("fullsize_photo"),
    )


def tubes_by_site(sites: DataFrame, tubes: DataFrame, site_columns: list[str]) -> DataFrame:
    """Annual tube readings with the place of their site, in site and year order."""
    joined = joins.enrich(tubes, Lookup(sites, {"site_id": "site_id"}, site_columns, "inner", "site"))
    rounded = {"no2": F.round("no2", 1)}
    rounded.update({c: F.round(c, 6) for c in ("latitude", "longitude") if c in site_columns})
    return joined.withColumns(rounded).orderBy("site_id", "year")


def hourly_with_parts(hourly: DataFrame) -> DataFrame:
    """Hourly readings with date parts sliced from the ISO text time."""
    return hourly.select("*", *iso_text_parts("date_time"))


def annual_means(hourly: DataFrame, pollutants: list[str]) -> DataFrame:
    """Mean of each pollutant by site and year, one decimal."""
    means = [F.round(F.avg(p), 1).alias(f"mean_{p}") for p in pollutants]
    return hourly.groupBy("site_id", "year").agg(*means).orderBy("year", "site_id")


# Columns of the published tracker, besides the name of the sheet.
TRACKER_COLUMNS = ["pillar", "action_areas", "id", "action", "update_for_march_2024", "impact", "mca_control"]


def action_tracker(
    sheets: dict[str, DataFrame], leave_out: list[str] = (), relabel: dict[str, str] | None = None, tag: str = "pillar",
    columns: list[str] = TRACKER_COLUMNS,
) -> DataFrame:
    """Sheets of an action tracker as one text table, the sheet name in ``tag``; rows without an action go.

    ``relabel`` gives the action area for all rows of some sheets. ``columns`` are those of the result; one
    that no sheet has is an error.
    """
    as_text = {
        name: all_text(names.clean_names(df)) for name, df in sheets.items() if name not in leave_out
    }
    rows = sets.unite_tagged(as_text, tag).where(F.col("action").isNotNull())
    area = F.col("action_areas")
    for sheet, label in (relabel or {}).items():
        area = F.when(F.col(tag) == sheet, label).otherwise(area)
    rows = rows.withColumn("action_areas", area)
    return rows.select(*columns)


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def register_report(published: DataFrame, registered: DataFrame) -> DataFrame:
    """Two bus registers compared: one row of counts and shares.

    Columns used: operator, service_code, schema_version, quality_score, licence_number (published) and
    service_code, licence_number (registered).
    """
    valid = F.coalesce((F.col("schema_version") == "2.4").cast("int"), F.lit(0))
    counts = published.agg(
        F.countDistinct("operator").alias("n_operators"),
        F.countDistinct("service_code").alias("n_service_codes"),
        (F.avg(valid) * 100).alias("schema_2_4_pct"),
    )
    # Both kinds of key in one comparison: each register is scanned once for it.
    kinds = F.explode(F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("key")) for c in ("service_code", "licence_number")
    ])).alias("k")
    both = joins.presence(*[df.select(kinds).select("k.*") for df in (published, registered)], ["kind", "key"])
    licence, service = F.col("kind") == "licence_number", F.col("kind") == "service_code"
    compared = both.agg(
        (F.avg(F.when(licence & (F.col("in_b") == 1), F.col("in_a"))) * 100).alias("published_licence_pct"),
        F.count_if(service & (F.col("in_a") == 0)).alias("n_registered_not_published"),
        F.count_if(service & (F.col("in_b") == 0)).alias("n_published_not_registered"),
    )
    row = compared.select(F.struct(*compared.columns)).scalar()
    return counts.select("*", row.alias("__row")).select(*counts.columns, "__row.*")


def tenure_wide(tenure: DataFrame, tenures: list[str] | None = None) -> DataFrame:
    """Long tenure counts to one row per small area and one clean-named column per tenure."""
    wide = aggs.pivot_wider(
        tenure, ["GEOGRAPHY_NAME", "GEOGRAPHY_CODE"], "C2021_TENURE_9_NAME", "OBS_VALUE", tenures, "first"
    )
    return names.clean_names(wide).withColumnsRenamed(
        {"geography_name": "lsoa_name", "geography_code": "lsoa21cd"}
    )
