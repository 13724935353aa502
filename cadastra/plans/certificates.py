"""Pipelines over property certificates. Column names follow the register, in lower case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions import bands, domain
from cadastra.functions.dates import date_parts
from cadastra.operators import aggs, dedupe, joins, windows
from cadastra.operators.joins import Lookup

# Columns of the postcode directory that the views carry.
POSTCODE_COLUMNS = [
    "lsoa21", "msoa21", "lsoa11", "msoa11", "lat", "long", "osnrth1m", "oseast1m", "geom_text", "imd", "pcds",
]


def _others(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key]


def in_region(certs: DataFrame, authorities: DataFrame, region: str) -> DataFrame:
    """Certificates of the authorities that make up one combined authority."""
    members = authorities.where(F.col("cauthnm") == region)
    return joins.keep_listed(certs, members, {"local_authority": "ladcd"})


def directory(postcodes: DataFrame, tenure: DataFrame, imd: DataFrame) -> DataFrame:
    """Postcodes with the tenure and deprivation of their small areas.

    With the keys of both: an area that a lookup does not know differs from an unknown postcode.
    """
    return joins.enrich(
        postcodes,
        Lookup(tenure, {"lsoa21": "lsoa21cd"}, tenure.columns, prefix="tenure"),
        Lookup(imd, {"lsoa11": "lsoa11cd"}, imd.columns, prefix="imd"),
    )


def domestic_view(
    certs: DataFrame, postcodes: DataFrame, tenure: DataFrame, imd: DataFrame,
    authorities: DataFrame | None = None, region: str | None = None, postcode_columns: list[str] = POSTCODE_COLUMNS,
) -> DataFrame:
    """Latest certificates per property with geography, tenure, deprivation, year, epoch and date parts.

    With ``region`` only properties whose latest certificate lies in that combined authority. The
    latest date counts all certificates (a property may have moved between authorities), but only
    those of the region are shuffled. Tenure and deprivation hang on the postcode, so they are
    joined to the postcode directory first and the certificates meet one lookup, not three.
    """
    members = None if region is None else in_region(certs, authorities, region)
    latest = dedupe.latest_with_ties(certs, "uprn", "lodgement_datetime", among=members)
    geography = directory(postcodes.select(*postcode_columns), tenure, imd)
    arms = [Lookup(geography, {"postcode": "pcds"}, geography.columns, prefix="pc")]
    if authorities is not None:
        arms.append(Lookup(authorities, {"local_authority": "ladcd"}, ["ladnm", "cauthnm", "ladcd"], prefix="la"))
    return with_derived(joins.enrich(latest, *arms))


def with_derived(certs: DataFrame) -> DataFrame:
    """Nominal construction year, epoch and lodgement date parts."""
    dated = certs.withColumn("nominal_construction_year", bands.year_by_range("construction_age_band"))
    return dated.select(
        "*",
        bands.epoch("nominal_construction_year").alias("construction_epoch"),
        *date_parts("lodgement_datetime", "lodgement_"),
    )


def non_domestic_view(certs: DataFrame, postcodes: DataFrame, authorities: DataFrame, region: str) -> DataFrame:
    """Latest non-domestic certificates of a region that have both an authority and a known postcode."""
    members = in_region(certs, authorities, region)
    latest = dedupe.latest_with_ties(certs, "uprn", "lodgement_datetime", among=members)
    joined = joins.enrich(
        latest,
        Lookup(authorities, {"local_authority": "ladcd"}, authorities.columns, "inner", "la"),
        Lookup(postcodes, {"postcode": "pcds"}, ["lsoa21", "lat", "long"], "inner", "pc"),
    )
    return joined.select("*", *date_parts("lodgement_datetime", "lodgement_")).drop("postcode")


def portal_view(
    certs: DataFrame, postcodes: DataFrame, tenure: DataFrame, imd: DataFrame, authorities: DataFrame, region: str,
    postcode_columns: list[str] = POSTCODE_COLUMNS,
) -> DataFrame:
    """Cleaned certificates of a region for publication, numbered in certificate-key order."""
    geography = joins.enrich(
        postcodes.select(*postcode_columns),
        Lookup(tenure, {"lsoa21": "lsoacd"}, _others(tenure, "lsoacd"), prefix="tenure"),
        Lookup(imd, {"lsoa21": "lsoacd"}, ["imd_decile"], prefix="imd"),
    ).withColumnRenamed("imd_decile", "n_imd_decile")
    joined = joins.enrich(
        in_region(certs, authorities, region),
        Lookup(geography, {"postcode": "pcds"}, _others(geography, "pcds"), prefix="pc"),
        Lookup(authorities, {"local_authority": "ladcd"}, ["ladnm"], prefix="la"),
    )
    with_epoch = joined.withColumn("construction_epoch", bands.epoch("n_nominal_construction_date"))
    return windows.row_numbers(with_epoch, "lmk_key", "rowname")


def ingest(certs: DataFrame, source: str, order: list) -> DataFrame:
    """Latest certificate per property and file, minus properties that still occur twice, then cleaned."""
    single = dedupe.latest_of_single_source(certs, source, "uprn", order)
    day = F.to_date("lodgement_datetime")
    return single.select(
        *[c for c in single.columns if c != "lodgement_datetime"],
        day.cast("string").alias("date"),
        F.year(day).alias("year"),
        F.month(day).cast("smallint").alias("month"),
        domain.tenure("tenure").alias("tenure_epc"),
        bands.year_by_digits("construction_age_band").alias("n_nominal_construction_date"),
    )


def profile_flags(
    certs: DataFrame, property_types: dict[str, str], ratings: dict[str, str], means: list[str] = (), keep: list[str] = ()
) -> DataFrame:
    """Authority, small area and 0/1 features of every certificate, with numbers and columns to keep."""
    extra = domain.one_hot("property_type", property_types) + domain.one_hot("current_energy_rating", ratings)
    return certs.select(*keep, "local_authority", "lsoa21", *means, *domain.profile_flags(), *extra)


def housing_profile(
    certs: DataFrame, property_types: dict[str, str], ratings: dict[str, str], means: list[str] = ()
) -> DataFrame:
    """Per authority and small area: percent and number of properties with each feature, in one pass.

    ``property_types`` and ``ratings`` map flag names to the values they stand for. For a profile that follows
    update batches without a new pass see :mod:`cadastra.streaming.retract`.
    """
    flagged = profile_flags(certs, property_types, ratings, means)
    flags = [c for c in flagged.columns if c.startswith("d_")]
    return aggs.flag_profile(flagged, ["local_authority", "lsoa21"], flags, means, "epc_properties_count")


def band_by_rating(certs: DataFrame, ratings: list[str]) -> DataFrame:
    """Number of properties per construction age band (rows) and rating (columns); empty cells null."""
    known = certs.where(F.col("construction_age_band").isNotNull())
    counts = known.groupBy("construction_age_band", "current_energy_rating").agg(F.count("*").alias("properties"))
    return aggs.pivot_wider(counts, "construction_age_band", "current_energy_rating", "properties", ratings)


def postcode_subset(postcodes: DataFrame, areas: DataFrame, area_key: str, columns: dict[str, str]) -> DataFrame:
    """Postcodes of the listed authorities, chosen columns only, renamed to ``old -> new``."""
    kept = joins.keep_listed(postcodes, areas, {"oslaua": area_key})
    return kept.select(*[F.col(old).alias(new) for old, new in columns.items()])


def postcode_deprivation(lookup: DataFrame, authorities: DataFrame, imd: DataFrame) -> DataFrame:
    """Postcodes of combined authorities with their small area, authority and deprivation rank."""
    members = joins.enrich(
        lookup, Lookup(authorities, {"ladnm": "ladnm"}, ["cauthcd", "cauthnm"], "inner", "ca")
    )
    ranked = joins.enrich(members, Lookup(imd, {"lsoa11cd": "lsoa11cd"}, ["imd19"], prefix="imd"))
    return ranked.select("pcds", "lsoa11cd", "msoa11cd", "ladcd", "ladnm", "cauthcd", "cauthnm", "imd19")


def rating_distribution(certs: DataFrame, areas: DataFrame, area: Column) -> DataFrame:
    """Ratings of the latest certificates of one area; postcodes outside ``areas`` have no area name."""
    latest = dedupe.latest_of_group(certs, "uprn", "lodgement_datetime")
    joined = areas.join(latest, areas["pcds"] == latest["postcode"], "right")
    return joined.where(area).groupBy("current_energy_rating").agg(F.count("*").alias("n"))
