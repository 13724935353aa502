"""Declared schemas of the published register files.

CSV files are mapped by position, so the column order below is part of the format.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "m": T.DecimalType(10, 2),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """``NAME NAME:i`` to a schema; a name without a type is a string."""
    fields = [word.partition(":") for word in text.split()]
    return T.StructType([T.StructField(name, _TYPES[kind or "s"]) for name, _, kind in fields])


# Column names, order and types of the published files (fixed values).
DOMESTIC = _schema("""
LMK_KEY ADDRESS1 ADDRESS2 ADDRESS3 POSTCODE BUILDING_REFERENCE_NUMBER
CURRENT_ENERGY_RATING POTENTIAL_ENERGY_RATING CURRENT_ENERGY_EFFICIENCY:i POTENTIAL_ENERGY_EFFICIENCY:i
PROPERTY_TYPE BUILT_FORM INSPECTION_DATE:date LOCAL_AUTHORITY CONSTITUENCY COUNTY LODGEMENT_DATE:date
TRANSACTION_TYPE ENVIRONMENT_IMPACT_CURRENT:i ENVIRONMENT_IMPACT_POTENTIAL:i
ENERGY_CONSUMPTION_CURRENT:d ENERGY_CONSUMPTION_POTENTIAL:d
CO2_EMISSIONS_CURRENT:m CO2_EMISS_CURR_PER_FLOOR_AREA:m CO2_EMISSIONS_POTENTIAL:m
LIGHTING_COST_CURRENT:d LIGHTING_COST_POTENTIAL:d HEATING_COST_CURRENT:d HEATING_COST_POTENTIAL:d
HOT_WATER_COST_CURRENT:d HOT_WATER_COST_POTENTIAL:d TOTAL_FLOOR_AREA:m ENERGY_TARIFF MAINS_GAS_FLAG
FLOOR_LEVEL FLAT_TOP_STOREY FLAT_STOREY_COUNT:m MAIN_HEATING_CONTROLS MULTI_GLAZE_PROPORTION:d
GLAZED_TYPE GLAZED_AREA EXTENSION_COUNT:i NUMBER_HABITABLE_ROOMS:d NUMBER_HEATED_ROOMS:d
LOW_ENERGY_LIGHTING:i NUMBER_OPEN_FIREPLACES:i HOTWATER_DESCRIPTION HOT_WATER_ENERGY_EFF HOT_WATER_ENV_EFF
FLOOR_DESCRIPTION FLOOR_ENERGY_EFF FLOOR_ENV_EFF WINDOWS_DESCRIPTION WINDOWS_ENERGY_EFF WINDOWS_ENV_EFF
WALLS_DESCRIPTION WALLS_ENERGY_EFF WALLS_ENV_EFF SECONDHEAT_DESCRIPTION SHEATING_ENERGY_EFF SHEATING_ENV_EFF
ROOF_DESCRIPTION ROOF_ENERGY_EFF ROOF_ENV_EFF MAINHEAT_DESCRIPTION MAINHEAT_ENERGY_EFF MAINHEAT_ENV_EFF
MAINHEATCONT_DESCRIPTION MAINHEATC_ENERGY_EFF MAINHEATC_ENV_EFF LIGHTING_DESCRIPTION LIGHTING_ENERGY_EFF
LIGHTING_ENV_EFF MAIN_FUEL WIND_TURBINE_COUNT:d HEAT_LOSS_CORRIDOR UNHEATED_CORRIDOR_LENGTH:m FLOOR_HEIGHT:m
PHOTO_SUPPLY:d SOLAR_WATER_HEATING_FLAG MECHANICAL_VENTILATION PROPERTY_ADDRESS LOCAL_AUTHORITY_LABEL
CONSTITUENCY_LABEL POSTTOWN CONSTRUCTION_AGE_BAND LODGEMENT_DATETIME:ts TENURE FIXED_LIGHTING_OUTLETS_COUNT:d
LOW_ENERGY_FIXED_LIGHT_COUNT:d UPRN UPRN_SOURCE
""")

NON_DOMESTIC = _schema("""
LMK_KEY ADDRESS1 ADDRESS2 ADDRESS3 POSTCODE BUILDING_REFERENCE_NUMBER ASSET_RATING:i ASSET_RATING_BAND
PROPERTY_TYPE INSPECTION_DATE:date LOCAL_AUTHORITY CONSTITUENCY COUNTY LODGEMENT_DATE:date TRANSACTION_TYPE
NEW_BUILD_BENCHMARK EXISTING_STOCK_BENCHMARK BUILDING_LEVEL MAIN_HEATING_FUEL OTHER_FUEL_DESC
SPECIAL_ENERGY_USES RENEWABLE_SOURCES FLOOR_AREA:i STANDARD_EMISSIONS:m TARGET_EMISSIONS:m
TYPICAL_EMISSIONS:m BUILDING_EMISSIONS:m AIRCON_PRESENT AIRCON_KW_RATING:m ESTIMATED_AIRCON_KW_RATING:m
AC_INSPECTION_COMMISSIONED:i BUILDING_ENVIRONMENT ADDRESS LOCAL_AUTHORITY_LABEL CONSTITUENCY_LABEL POSTTOWN
LODGEMENT_DATETIME:ts PRIMARY_ENERGY_VALUE:i UPRN:l UPRN_SOURCE
""")

POSTCODES = _schema("""
pcd pcd2 pcds dointr:i doterm:i oscty ced oslaua osward parish usertype:i oseast1m:i osnrth1m:i osgrdind:i
oshlthau nhser ctry rgn streg pcon eer teclec ttwa pct itl statsward oa01 casward npark lsoa01 msoa01 ur01ind
oac01 oa11 lsoa11 msoa11 wz11 sicbl bua11 buasd11 ru11ind oac11 lat:d long:d lep1 lep2 pfa imd:i calncv icb
oa21 lsoa21 msoa21
""")

AUTHORITIES = _schema("LAD22CD LAD22NM CAUTH22CD CAUTH22NM ObjectId:i")
TRAFFIC = _schema("""
local_authority_id:d local_authority_name year:d link_length_km:d link_length_miles:d cars_and_taxis:d
all_motor_vehicles:d
""")
SENSOR_READINGS = _schema("sensor_id:l lat:d lon:d timestamp P1 P2")
ANNUAL_TUBES = _schema("site_id:i year:i no2:d count:i")


def hyphenated(schema: T.StructType) -> T.StructType:
    """The same columns under the names of the update service: ``LMK_KEY`` is ``lmk-key`` there."""
    return T.StructType([T.StructField(f.name.lower().replace("_", "-"), f.dataType) for f in schema])


# Columns and types kept when certificates are read per authority (fixed values).
DOMESTIC_SUBSET = _schema("""
lmk-key postcode local-authority property-type lodgement-datetime transaction-type tenure mains-gas-flag
hot-water-energy-eff windows-description windows-energy-eff walls-description walls-energy-eff roof-description
roof-energy-eff mainheat-description mainheat-energy-eff mainheat-env-eff main-heating-controls
mainheatcont-description mainheatc-energy-eff main-fuel solar-water-heating-flag construction-age-band
current-energy-rating potential-energy-rating current-energy-efficiency potential-energy-efficiency built-form
constituency floor-description environment-impact-current:l environment-impact-potential:l
energy-consumption-current:l energy-consumption-potential:l co2-emiss-curr-per-floor-area:l
co2-emissions-current:d co2-emissions-potential:d lighting-cost-current:l lighting-cost-potential:l
heating-cost-current:l heating-cost-potential:l hot-water-cost-current:l hot-water-cost-potential:l
total-floor-area:d number-habitable-rooms:l number-heated-rooms:l photo-supply:d uprn:l
building-reference-number:l
""")
NON_DOMESTIC_SUBSET = _schema("""
LMK_KEY POSTCODE BUILDING_REFERENCE_NUMBER:l ASSET_RATING:l ASSET_RATING_BAND PROPERTY_TYPE LOCAL_AUTHORITY
CONSTITUENCY TRANSACTION_TYPE STANDARD_EMISSIONS:d TYPICAL_EMISSIONS:d TARGET_EMISSIONS:d BUILDING_EMISSIONS:d
BUILDING_LEVEL:l RENEWABLE_SOURCES LODGEMENT_DATETIME UPRN
""")


def vehicle_licences(first: str = "2009 Q4", last: str = "2023 Q4") -> T.StructType:
    """Five text columns, then one int column per quarter from ``last`` back to ``first``."""
    base = _schema("LSOA11CD LSOA11NM BodyType Keepership LicenceStatus")
    start, end = (int(y) * 4 + int(q) - 1 for y, q in (re.split(" Q", t) for t in (first, last)))
    quarters = [f"{n // 4} Q{n % 4 + 1}" for n in range(end, start - 1, -1)]
    return T.StructType([*base.fields, *[T.StructField(q, T.IntegerType()) for q in quarters]])


# Type words of column metadata files (fixed values); an unknown word means text.
DATATYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "float": T.DoubleType(),
    "decimal": T.DoubleType(),
    "datetime": T.TimestampNTZType(),
    "integer": T.LongType(),
}
