"""I (indicator pipelines) over the test tables dressed up as register tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from cadastra.catalog.registry import Tables, query
from cadastra.catalog.standins import UNTIED, band_sql, band_text, epoch_sql, range_year_sql, words, words_sql
from cadastra.functions.bands import year_by_range
from cadastra.operators import filters, joins, quality
from cadastra.operators.aggs import column_values, percent_drop
from cadastra.operators.joins import Lookup
from cadastra.plans import certificates, indicators, sql_layer, star
from cadastra.sources import readers, writers
from cadastra.sources.staging import fresh_dir, stage
from cadastra.streaming import retract

# --- the register seen in the test tables ----------------------------------------------------
#
# certificate = order, property = customer, postcode = customer key, small area = nation,
# authority = first digit of the order priority, combined authority = region.


def _certs(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("lmk_key"),
        F.col("o_custkey").alias("uprn"),
        F.col("o_custkey").alias("postcode"),
        F.substring("o_orderpriority", 1, 1).alias("local_authority"),
        F.col("o_orderdate").alias("lodgement_datetime"),
        band_text("o_orderkey").alias("construction_age_band"),
        F.col("o_orderstatus").alias("current_energy_rating"),
        F.col("o_totalprice").alias("total_floor_area"),
    )


_CERTS = f"""certs AS (SELECT o_orderkey AS lmk_key, o_custkey AS uprn, o_custkey AS postcode,
    left(o_orderpriority, 1) AS local_authority, o_orderdate AS lodgement_datetime,
    {band_sql('o_orderkey')} AS construction_age_band, o_orderstatus AS current_energy_rating,
    o_totalprice AS total_floor_area FROM orders)"""


def _postcodes(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("pcds"), F.col("c_nationkey").alias("lsoa21"), F.col("c_nationkey").alias("lsoa11"),
        F.col("c_acctbal").alias("lat"), F.col("c_mktsegment").alias("msoa21"),
    )


_POSTCODE_COLUMNS = ["pcds", "lsoa21", "lsoa11", "lat", "msoa21"]


def _tenure(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("lsoa21cd"), F.col("n_name").alias("lsoa_name"))


def _imd(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("lsoa11cd"), (F.col("n_regionkey") + 1).alias("imd19"))


def _authorities(t: Tables) -> DataFrame:
    return t.region.select(
        (F.col("r_regionkey") + 1).cast("string").alias("ladcd"),
        F.concat(F.lit("District "), "r_name").alias("ladnm"),
        F.concat(F.lit("E4700000"), F.col("r_regionkey").cast("string")).alias("cauthcd"),
        F.col("r_name").alias("cauthnm"),
    )


_AUTHORITIES = """las AS (SELECT CAST(r_regionkey + 1 AS VARCHAR) AS ladcd, 'District ' || r_name AS ladnm,
    'E4700000' || r_regionkey AS cauthcd, r_name AS cauthnm FROM region)"""

_LATEST = """latest AS (SELECT c.* FROM certs c JOIN (SELECT uprn, max(lodgement_datetime) AS d FROM certs GROUP BY uprn) m
    ON c.uprn = m.uprn AND c.lodgement_datetime = m.d)"""

_VIEW_COLUMNS = [
    "lmk_key", "uprn", "local_authority", "construction_age_band", "lsoa21", "msoa21", "lat", "lsoa_name", "imd19",
    "ladnm", "cauthnm", "nominal_construction_year", "construction_epoch",
    "lodgement_day", "lodgement_month", "lodgement_year",
]

_VIEW_SQL = f"""
WITH {_CERTS}, {_LATEST}, {_AUTHORITIES}
SELECT lmk_key, uprn, local_authority, construction_age_band, c_nationkey AS lsoa21, c_mktsegment AS msoa21,
    c_acctbal AS lat, n_name AS lsoa_name, n_regionkey + 1 AS imd19, ladnm, cauthnm,
    {range_year_sql('construction_age_band')} AS nominal_construction_year,
    {epoch_sql(range_year_sql('construction_age_band'))} AS construction_epoch,
    day(lodgement_datetime)::INTEGER AS lodgement_day, month(lodgement_datetime)::INTEGER AS lodgement_month,
    year(lodgement_datetime)::INTEGER AS lodgement_year
FROM latest LEFT JOIN customer ON postcode = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN las ON ladcd = local_authority"""


@query("i01_domestic_view", _VIEW_SQL + " WHERE cauthnm = 'EUROPE'")
def _(t: Tables):
    view = certificates.domestic_view(_certs(t), _postcodes(t), _tenure(t), _imd(t), _authorities(t), "EUROPE", _POSTCODE_COLUMNS)
    return view.select(*_VIEW_COLUMNS)


@query("i01_domestic_view_all", _VIEW_SQL)
def _(t):
    view = certificates.domestic_view(_certs(t), _postcodes(t), _tenure(t), _imd(t), _authorities(t), postcode_columns=_POSTCODE_COLUMNS)
    return view.select(*_VIEW_COLUMNS)


@query("i01_bucketed_view", _VIEW_SQL)
def _(t):
    prefix, path = f"i01_{uuid.uuid4().hex}", fresh_dir(t.spark, "i01-star")
    star.store_star(t.spark, prefix, path, _certs(t), _postcodes(t), _tenure(t), _imd(t), 8, _POSTCODE_COLUMNS)
    return star.star_view(t.spark, prefix, _authorities(t)).select(*_VIEW_COLUMNS)


@query("i01_sql_view", _VIEW_SQL + " WHERE cauthnm = 'EUROPE'")
def _(t):
    # Defined over a first load; read in another session after a second one.
    root, database = fresh_dir(t.spark, "i01-sql"), f"i01_{uuid.uuid4().hex}"
    tables = {"domestic": _certs(t), "postcodes": _postcodes(t), "tenure": _tenure(t), "imd": _imd(t), "authorities": _authorities(t)}
    for frames in ({**tables, "domestic": tables["domestic"].where("lmk_key % 3 = 0")}, tables):
        writers.publish_tables(t.spark, root, frames)
        sql_layer.publish(t.spark, root, database)
    other = t.spark.newSession()
    return other.sql(f"SELECT {', '.join(_VIEW_COLUMNS)} FROM {database}.epc_domestic_vw WHERE cauthnm = 'EUROPE'")


@query("i02_non_domestic_view", f"""
WITH {_CERTS}, {_LATEST}, {_AUTHORITIES}
SELECT lmk_key, uprn, local_authority, total_floor_area, ladcd, ladnm, cauthcd, cauthnm, c_nationkey AS lsoa21,
    c_acctbal AS lat, CAST(c_custkey AS DOUBLE) AS long, day(lodgement_datetime)::INTEGER AS lodgement_day,
    month(lodgement_datetime)::INTEGER AS lodgement_month, year(lodgement_datetime)::INTEGER AS lodgement_year
FROM latest JOIN las ON ladcd = local_authority JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON postcode = c_custkey
WHERE local_authority IN (SELECT ladcd FROM las WHERE cauthnm = 'ASIA')""")
def _(t):
    known = _postcodes(t).where(F.col("lat") > 0).withColumn("long", F.col("pcds").cast("double"))
    view = certificates.non_domestic_view(_certs(t), known, _authorities(t), "ASIA")
    return view.drop("lodgement_datetime", "construction_age_band", "current_energy_rating")


@query("i03_portal_view", f"""
WITH {_CERTS}, {_AUTHORITIES}
SELECT row_number() OVER (ORDER BY lmk_key) AS rowname, lmk_key, local_authority, c_nationkey AS lsoa21, n_name AS lsoa_name,
    ladnm, n_regionkey + 1 AS n_imd_decile, y AS n_nominal_construction_date, {epoch_sql('y')} AS construction_epoch
FROM (SELECT *, {range_year_sql('construction_age_band')} AS y FROM certs) LEFT JOIN customer ON postcode = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN las ON ladcd = local_authority
WHERE local_authority IN (SELECT ladcd FROM las WHERE cauthnm = 'EUROPE')""")
def _(t):
    certs = _certs(t).withColumn("n_nominal_construction_date", year_by_range("construction_age_band"))
    tenure = _tenure(t).withColumnRenamed("lsoa21cd", "lsoacd")
    imd = t.nation.select(F.col("n_nationkey").alias("lsoacd"), (F.col("n_regionkey") + 1).alias("imd_decile"))
    view = certificates.portal_view(certs, _postcodes(t), tenure, imd, _authorities(t), "EUROPE", _POSTCODE_COLUMNS)
    return view.select(
        "rowname", "lmk_key", "local_authority", "lsoa21", "lsoa_name", "ladnm", "n_imd_decile",
        "n_nominal_construction_date", "construction_epoch",
    )


_TENURE_WORDS = {"A": "owner-occupied", "N": "Rented (social)", "R": "rental (private)"}
_INGEST_ORDER = ["lodgement_datetime", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("i04_certificate_ingest", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
               l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem),
     f AS (SELECT * FROM r WHERE rn = 1),
     s AS (SELECT * FROM f WHERE l_orderkey IN (SELECT l_orderkey FROM f GROUP BY 1 HAVING count(*) = 1)),
     b AS (SELECT *, regexp_replace({band_sql('l_partkey')}, '[^0-9]', '', 'g') AS d FROM s)
SELECT l_orderkey AS uprn, l_returnflag AS source, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS date,
    year(l_shipdate)::INTEGER AS year, month(l_shipdate)::SMALLINT AS month,
    CASE l_returnflag WHEN 'A' THEN 'Owner occupied' WHEN 'N' THEN 'Social rented' ELSE 'Private rented' END AS tenure_epc,
    CAST(CASE WHEN d = '' THEN NULL WHEN d = '1900' THEN 1899 WHEN length(d) = 8 THEN
        floor((CAST(d[5:8] AS INTEGER) - CAST(d[1:4] AS INTEGER)) / 2) + CAST(d[1:4] AS INTEGER)
        ELSE CAST(d[1:4] AS INTEGER) END AS INTEGER) AS n_nominal_construction_date FROM b""")
def _(t):
    # One folder of files per source, read tolerantly by the key in their path.
    path = fresh_dir(t.spark, "i04")
    certs = t.lineitem.select(
        F.col("l_returnflag").alias("la"), F.col("l_orderkey").alias("uprn"), F.col("l_shipdate").alias("lodgement_datetime"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.lit("unused").alias("unused"),
        words(_TENURE_WORDS, "l_returnflag").alias("tenure"), band_text("l_partkey").alias("construction_age_band"),
    )
    writers.rebalanced(certs, ["la"]).write.partitionBy("la").option("header", True).csv(path)
    file_columns = [c for c in certs.columns if c != "la"]
    subset = certs.drop("la", "unused").schema
    found = readers.read_by_path_key(
        lambda p: readers.read_subset_csv(t.spark, p, subset, file_columns), path, r"/la=([^/]+)/",
        column_values(t.lineitem, "l_returnflag"), "source",
    )
    clean = certificates.ingest(found, "source", _INGEST_ORDER)
    return clean.select("uprn", "source", "l_partkey", "date", "year", "month", "tenure_epc", "n_nominal_construction_date")


# --- weighted scores -------------------------------------------------------------------------


def _scored_properties(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    # Customers and nations join the orders, and the large line table then meets one lookup.
    customers = joins.enrich(
        t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
        Lookup(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner"),
    )
    orders = joins.enrich(
        (t.orders if orders is None else orders).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"),
        Lookup(customers, {"o_custkey": "c_custkey"}, ["n_name", "c_mktsegment"], "inner"),
    )
    line = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    taken = ["o_orderpriority", "o_orderdate", "n_name", "c_mktsegment"]
    return joins.enrich(line, Lookup(orders, {"l_orderkey": "o_orderkey"}, taken, "inner")).select(
        F.col("c_mktsegment").alias("lsoa"), F.col("l_returnflag").alias("current_energy_rating"),
        F.col("l_linestatus").alias("property_type"), F.col("o_orderpriority").alias("transaction_type"),
        F.col("n_name").alias("cauthnm"), F.year("o_orderdate").alias("year"),
        F.col("l_quantity").alias("imd"), F.col("l_extendedprice").alias("score"),
    )


_SCORES_SQL = """
WITH g AS (SELECT n_name AS cauthnm, year(o_orderdate)::INTEGER AS year, avg(l_quantity) AS imd, avg(l_extendedprice) AS score
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, year(o_orderdate), c_mktsegment, l_returnflag, l_linestatus, o_orderpriority),
w AS (SELECT cauthnm, year, sum(score / imd) / sum(1 / imd) AS weighted_score FROM g GROUP BY ALL),
m AS (SELECT max(o_orderdate) AS d FROM orders),
y AS (SELECT year(d) - CASE WHEN month(d) = 12 AND day(d) = 31 THEN 0 ELSE 1 END AS last_year FROM m)"""


@query("i05_deprivation_weighted_scores", _SCORES_SQL + """
SELECT cauthnm, year, round(weighted_score, 4) AS weighted_score FROM w, y WHERE year BETWEEN last_year - 10 AND last_year""")
def _(t):
    # Eleven years in all, as bounds on the stored date, before anything is joined.
    scores = indicators.deprivation_weighted_scores(_scored_properties(t, filters.trailing_years(t.orders, "o_orderdate", 10)))
    return scores.withColumn("weighted_score", F.round("weighted_score", 4))


_ORDINAL_SQL = """CASE WHEN place % 100 BETWEEN 11 AND 13 THEN 'th' WHEN place % 10 = 1 THEN 'st'
    WHEN place % 10 = 2 THEN 'nd' WHEN place % 10 = 3 THEN 'rd' ELSE 'th' END"""


@query("i05_latest_places", _SCORES_SQL + f""",
p AS (SELECT cauthnm, year, rank() OVER (ORDER BY weighted_score DESC) AS place FROM w, y WHERE year = last_year)
SELECT cauthnm, year, CAST(place AS DOUBLE) AS place, place || {_ORDINAL_SQL} AS place_text FROM p""")
def _(t):
    # Only the last complete year is joined and aggregated.
    scores = indicators.deprivation_weighted_scores(_scored_properties(t, filters.trailing_years(t.orders, "o_orderdate", 0)))
    return indicators.latest_places(scores, "weighted_score").select("cauthnm", "year", "place", "place_text")


@query("i06_a_rated_share", f"""
WITH {_AUTHORITIES}, c AS (SELECT left(o_orderpriority, 1) AS la, CASE o_orderstatus WHEN 'F' THEN 'A+' WHEN 'O' THEN 'C'
    END AS band FROM orders)
SELECT cauthnm, count(*) FILTER (WHERE band = 'A+') AS a, count(*) FILTER (WHERE band = 'C') AS b_g,
    round_even(count(*) FILTER (WHERE band = 'A+') * 100.0::DOUBLE / count(*) FILTER (WHERE band = 'C'), 1) AS a_to_rest_pct
FROM c JOIN las ON la = ladcd GROUP BY 1""")
def _(t):
    band = words({"F": "A+", "O": "C"}, "o_orderstatus").alias("asset_rating_band")
    certs = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("local_authority"), band)
    return indicators.a_rated_share(certs, _authorities(t))


# --- housing profile -------------------------------------------------------------------------

_ROOF = {"STANDARD": "Good", "PROMO": "Very Good", "LARGE": "Very Poor", "MEDIUM": "Average"}
_FUEL = {"STANDARD": "mains gas (not community)", "PROMO": "Electricity", "LARGE": "oil", "SMALL": "mains gas"}
_TENURE = {"STANDARD": "owner-occupied", "PROMO": "rental (social)", "LARGE": "rental (private)", "ECONOMY": "Owner-occupied"}
_FORM = {"STANDARD": "Detached", "PROMO": "Semi-Detached", "LARGE": "Mid-Terrace", "MEDIUM": "NO DATA!", "SMALL": "End-Terrace"}
_PROPERTY = {"d_house": "House", "d_flat": "Flat"}
_RATINGS = {"d_rated_a": "A", "d_rated_b": "B"}


def _flag_sql(name: str, condition: str) -> str:
    flag = f"sum(CAST({condition} AS INTEGER))"
    return (
        f"round_even(coalesce({flag}, 0) * 100.0::DOUBLE / count(*), 1) AS {name}_percent, "
        f"CAST(coalesce({flag}, 0) AS BIGINT) AS {name}_sum"
    )


_PROFILE_FLAGS_SQL = ",\n    ".join(
    _flag_sql(name, condition)
    for name, condition in {
        "roof_good": "roof LIKE '%Good%'", "roof_poor": "roof LIKE '%Poor%'",
        "walls_good": "walls LIKE '%Good%'", "walls_poor": "walls LIKE '%Poor%'",
        "mf_electricity": "fuel LIKE '%lectricity%'", "mf_gas": "fuel LIKE '%mains gas%'", "mf_oil": "fuel LIKE '%oil%'",
        "epc_rent_social": "tenure LIKE '%social%'", "epc_owned": "tenure LIKE '%wn%'",
        "epc_rent_private": "tenure LIKE '%private%'", "terrace": "form LIKE '%Terrace%'",
        "detached": "form = 'Detached'", "semi_detached": "form = 'Semi-Detached'",
        "house": "kind = 'House'", "flat": "kind = 'Flat'", "rated_a": "rating = 'A'", "rated_b": "rating = 'B'",
    }.items()
)


def _profile_sql(lines: str) -> str:
    """The profile over some form of ``lineitem``."""
    return f"""
WITH c AS (SELECT p_brand AS local_authority, p_size AS lsoa21, {words_sql(_ROOF, 'p_type')} AS roof,
    {words_sql(_ROOF, "CASE WHEN l_returnflag = 'R' THEN p_type ELSE 'LARGE' END")} AS walls,
    {words_sql(_FUEL, 'p_type')} AS fuel, {words_sql(_TENURE, 'p_type')} AS tenure,
    nullif({words_sql(_FORM, 'p_type')}, 'NO DATA!') AS form,
    CASE l_linestatus WHEN 'F' THEN 'House' ELSE 'Flat' END AS kind, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' END
    AS rating, l_quantity FROM {lines} JOIN part ON l_partkey = p_partkey)
SELECT local_authority, lsoa21, {_PROFILE_FLAGS_SQL}, round_even(avg(l_quantity), 0) AS quantity,
    count(*) AS epc_properties_count FROM c GROUP BY 1, 2"""


def _certificates(t: Tables, lines: DataFrame, *keep: str) -> DataFrame:
    """Order lines as certificates: what the part is made of as roof, walls, fuel, tenure and form."""
    line = lines.select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity", *keep)
    parts = Lookup(t.part, {"l_partkey": "p_partkey"}, ["p_brand", "p_size", "p_type"], "inner")
    walls_key = F.when(F.col("l_returnflag") == "R", F.col("p_type")).otherwise("LARGE")
    return joins.enrich(line, parts).withColumn("walls_key", walls_key).select(
        *keep, F.col("p_brand").alias("local_authority"), F.col("p_size").alias("lsoa21"),
        words(_ROOF, "p_type").alias("roof_energy_eff"), words(_ROOF, "walls_key").alias("walls_energy_eff"),
        words(_FUEL, "p_type").alias("main_fuel"), words(_TENURE, "p_type").alias("tenure"),
        words(_FORM, "p_type").alias("built_form"),
        F.when(F.col("l_linestatus") == "F", "House").otherwise("Flat").alias("property_type"),
        words({"A": "A", "N": "B"}, "l_returnflag").alias("current_energy_rating"),
        F.col("l_quantity").alias("n_quantity"),
    )


@query("i07_housing_profile", _profile_sql("lineitem"))
def _(t):
    return certificates.housing_profile(_certificates(t, t.lineitem), _PROPERTY, _RATINGS, ["n_quantity"])


@query("i07_refreshed_profile", _profile_sql("""(
    SELECT CASE WHEN l_suppkey % 5 = 1 AND l_partkey > 0 THEN l_partkey - 1 ELSE l_partkey END AS l_partkey, l_linestatus,
        CASE WHEN l_suppkey % 5 IN (0, 1) THEN 'A' ELSE l_returnflag END AS l_returnflag,
        CASE WHEN l_suppkey % 5 = 0 THEN l_quantity * 2 ELSE l_quantity END AS l_quantity
    FROM lineitem WHERE l_suppkey % 5 <> 3 OR l_linestatus = 'F')"""))
def _(t):
    # A register without the lines of some suppliers, then two batches: lines rated anew and larger; new lines,
    # and lines that move to another part, and so to another authority and area.
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice"]
    numbered = t.lineitem.withColumn("l_part", F.col("l_orderkey") % 16).withColumn("stamp", F.lit(0))
    rated = numbered.where("l_suppkey % 5 = 0").withColumns({"l_returnflag": F.lit("A"), "l_quantity": F.col("l_quantity") * 2})
    moved = numbered.where("l_suppkey % 5 = 1").withColumns({"l_returnflag": F.lit("A"), "l_partkey": F.greatest(F.col("l_partkey") - 1, F.lit(0))})
    added = numbered.where("l_suppkey % 5 = 2 OR (l_suppkey % 5 = 3 AND l_linestatus = 'F')")
    outdated = rated.withColumn("l_returnflag", F.lit("N"))  # repeated in the batch, the later stamp wins
    waves = [rated.withColumn("stamp", F.lit(2)).unionByName(outdated), moved.unionByName(added)]

    def flagged(lines: DataFrame) -> DataFrame:
        certs = _certificates(t, lines, *key, "l_part", "stamp")
        return certificates.profile_flags(certs, _PROPERTY, _RATINGS, ["n_quantity"], [*key, "l_part", "stamp"])

    register, sums = fresh_dir(t.spark, "i07-register"), fresh_dir(t.spark, "i07-sums")
    first = stage(flagged(numbered.where("l_suppkey % 5 NOT IN (2, 3)")), "i07")
    writers.replace_table(first, register, ["l_part"])
    spec = retract.Sums(("local_authority", "lsoa21"), tuple(c for c in first.columns if c.startswith("d_")), ("n_quantity",))
    retract.start_profile(first, sums, spec)
    for number, wave in enumerate(waves, start=1):
        retract.refresh(t.spark, register, sums, flagged(wave), [*key, "l_part"], "l_part", "stamp", spec, number)
    return retract.profile(retract.stored_sums(t.spark, sums, first.schema, spec), spec, "epc_properties_count")


# --- emissions -------------------------------------------------------------------------------


def _emissions(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Order totals as emissions of the customer's nation; account balance as population."""
    yearly = (t.orders if orders is None else orders).groupBy(
        "o_custkey", F.year("o_orderdate").alias("calendar_year"), F.col("o_orderpriority").alias("la_ghg_sub_sector")
    ).agg(F.sum("o_totalprice").alias("territorial_emissions_kt_co2e"))
    joined = joins.enrich(yearly, Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner"))
    return joined.select(
        F.col("c_nationkey").cast("string").alias("local_authority_code"), "calendar_year", "la_ghg_sub_sector",
        "territorial_emissions_kt_co2e",
        (F.col("c_nationkey") + 1).cast("double").alias("mid_year_population_thousands"),
    )


def _members(t: Tables) -> DataFrame:
    """Nations as authorities of the region they lie in; nation 0 belongs to none."""
    named = joins.enrich(t.nation, Lookup(t.region, {"n_regionkey": "r_regionkey"}, ["r_name"], "inner"))
    return named.where(F.col("n_nationkey") > 0).select(
        F.col("n_nationkey").cast("string").alias("ladcd"), F.col("r_name").alias("cauthnm")
    )


_EMISSIONS_SQL = """
WITH las AS (SELECT CAST(n_nationkey AS VARCHAR) AS ladcd, r_name AS cauthnm FROM nation JOIN region ON n_regionkey = r_regionkey
             WHERE n_nationkey > 0 UNION ALL SELECT '0', 'EUROPE'),
     relabelled AS (SELECT ladcd, CASE WHEN cauthnm = 'EUROPE' THEN 'EUROPE (inc 0)' ELSE cauthnm END AS cauthnm FROM las),
     e AS (SELECT CAST(c_nationkey AS VARCHAR) AS la, year(o_orderdate)::INTEGER AS calendar_year,
           avg(c_nationkey + 1) * 1000 AS pop, sum(o_totalprice) AS kt FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL),
     p AS (SELECT cauthnm, calendar_year, sum(pop) AS population, sum(kt) AS amount FROM e JOIN relabelled ON la = ladcd
           GROUP BY ALL)"""


_SUB_SECTORS = ["1-URGENT", "2-HIGH"]


def _per_capita(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    return indicators.emissions_per_capita(
        _emissions(t, orders), _members(t), _SUB_SECTORS, [("0", "EUROPE")], ("EUROPE", "EUROPE (inc 0)")
    )


@query("i08_emissions_per_capita", _EMISSIONS_SQL + """
SELECT cauthnm, calendar_year, round(population, 2) AS population, round(amount, 2) AS amount,
    round(amount * 1000 / population, 4) AS per_capita FROM p""")
def _(t):
    rounded = {"population": F.round("population", 2), "amount": F.round("amount", 2), "per_capita": F.round("per_capita", 4)}
    return _per_capita(t).withColumns(rounded)


@query("i08_latest_places", _EMISSIONS_SQL + f""",
r AS (SELECT cauthnm, calendar_year, rank() OVER (ORDER BY amount / population DESC) AS place FROM p
      WHERE calendar_year = (SELECT max(calendar_year) FROM p))
SELECT cauthnm, calendar_year, CAST(place AS DOUBLE) AS place, place || {_ORDINAL_SQL} AS place_text FROM r""")
def _(t):
    # The latest year of these sub-sectors is found first; only its orders are joined and aggregated.
    latest = filters.in_latest_year(t.orders.where(F.col("o_orderpriority").isin(*_SUB_SECTORS)), "o_orderdate")
    places = indicators.latest_places(_per_capita(t, latest), "per_capita", "calendar_year")
    return places.select("cauthnm", "calendar_year", "place", "place_text")


_SECTORS = ["PROMO", "LARGE", "SMALL"]


def _sector_totals(t: Tables) -> DataFrame:
    recent = filters.in_years(t.lineitem, "l_shipdate", 1996)  # what sector_totals keeps, as a bound on the stored date
    line = recent.groupBy("l_partkey", F.year("l_shipdate").alias("calendar_year")).agg(
        F.sum("l_extendedprice").alias("territorial_emissions_kt_co2e")
    )
    parts = Lookup(t.part, {"l_partkey": "p_partkey"}, ["p_type", "p_brand"], "inner")
    emissions = joins.enrich(line, parts).withColumnsRenamed({"p_type": "la_ghg_sector", "p_brand": "local_authority"})
    return indicators.sector_totals(emissions, _SECTORS, 1996, ["Brand#1"])


_SECTOR_SQL = """
WITH s AS (SELECT year(l_shipdate)::INTEGER AS calendar_year, CASE WHEN p_type IN ('PROMO', 'LARGE', 'SMALL') THEN p_type
    ELSE 'Other' END AS "group", sum(l_extendedprice) AS e FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_brand <> 'Brand#1' AND year(l_shipdate) >= 1996 GROUP BY ALL)"""


@query("i09_sector_chart", _SECTOR_SQL + """
SELECT calendar_year, """ + ", ".join(
    f"round(sum(e) FILTER (WHERE \"group\" = '{s}'), 2) AS \"{s}\"" for s in [*_SECTORS, "Other"]
) + " FROM s GROUP BY 1")
def _(t):
    groups = [*_SECTORS, "Other"]
    chart = indicators.sector_chart(_sector_totals(t), groups)
    return chart.withColumns({g: F.round(g, 2) for g in groups})


@query("i09_percent_drop", _SECTOR_SQL + """,
y AS (SELECT calendar_year, sum(e) AS total FROM s GROUP BY 1)
SELECT round_even((arg_min(total, calendar_year) - arg_max(total, calendar_year)) * 100 / arg_min(total, calendar_year), 1)
    AS percent_drop FROM y""")
def _(t):
    return percent_drop(_sector_totals(t), "calendar_year", "emissions_by_sector").select("percent_drop")


# --- traffic, chargers, renewables, licences -------------------------------------------------


def _traffic(t: Tables) -> DataFrame:
    """One file per authority in the register; here the authority is a supplier's nation."""
    flows = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_tax").alias("cars_and_taxis"), F.sum("l_quantity").alias("all_motor_vehicles")
    )
    joined = joins.enrich(flows, Lookup(t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"], "inner"))
    return joined.withColumn("local_authority_code", F.concat(F.lit("E"), F.col("s_nationkey").cast("string"))).withColumnRenamed(
        "s_nationkey", "local_authority_id"
    )


_TRAFFIC_SQL = """
WITH f AS (SELECT l_suppkey, year(l_shipdate)::INTEGER AS year, sum(l_tax) * 100 / sum(l_quantity) AS ratio FROM lineitem
           GROUP BY ALL),
     l AS (SELECT DISTINCT s_nationkey FROM f JOIN supplier ON l_suppkey = s_suppkey WHERE year = (SELECT max(year) FROM f)),
     a AS (SELECT r_name AS cauthnm, year, avg(ratio) AS mean_ratio FROM f JOIN supplier s ON l_suppkey = s_suppkey
           JOIN l ON l.s_nationkey = s.s_nationkey JOIN nation ON s.s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey > 0 GROUP BY ALL)"""


def _car_ratios(t: Tables) -> DataFrame:
    traffic = stage(_traffic(t), "traffic")  # read three times below
    members = _members(t).withColumn("ladcd", F.concat(F.lit("E"), "ladcd"))
    lookup = indicators.traffic_lookup(traffic, members).select("dft_la_id", "ladcd").distinct()
    lookup = joins.enrich(lookup, Lookup(members, {"ladcd": "ladcd"}, ["cauthnm"], "inner"))
    return indicators.car_ratio_series(traffic, lookup)


@query("i10_car_ratio_series", _TRAFFIC_SQL + "SELECT cauthnm, year, round(mean_ratio, 8) AS mean_ratio FROM a")
def _(t):
    return _car_ratios(t).withColumn("mean_ratio", F.round("mean_ratio", 8))


@query("i10_latest_places", _TRAFFIC_SQL + f""",
p AS (SELECT cauthnm, year, rank() OVER (ORDER BY mean_ratio DESC) AS place FROM a WHERE year = (SELECT max(year) FROM a))
SELECT cauthnm, year, CAST(place AS DOUBLE) AS place, place || {_ORDINAL_SQL} AS place_text FROM p""")
def _(t):
    return indicators.latest_places(_car_ratios(t), "mean_ratio").select("cauthnm", "year", "place", "place_text")


_CHARGER_QUARTERS = {"jul_23_total_charging_devices": "A", "oct_23_total_charging_devices": "N", "jan_24_per_100k_population": "R"}


@query("i11_chargers_long", " UNION ALL ".join(
    f"""SELECT CAST(l_suppkey AS VARCHAR) AS local_authority_region_code, r_name AS cauthnm,
    '{date}' AS end_date, '{variable}' AS variable, CAST(nullif(count(*) FILTER (WHERE l_returnflag = '{flag}' AND l_quantity > 45), 0)
    AS DOUBLE) AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY l_suppkey, r_name""" for date, variable, flag in (
        ("2023-07-01", "total_charging_devices", "A"), ("2023-10-01", "total_charging_devices", "N"),
        ("2024-01-01", "per_100k_population", "R"))))
def _(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(
        *[F.count_if((F.col("l_returnflag") == flag) & (F.col("l_quantity") > 45)).alias(name)
          for name, flag in _CHARGER_QUARTERS.items()]
    )
    cells = [F.when(F.col(c) > 0, F.col(c).cast("string")).otherwise("x").alias(c) for c in _CHARGER_QUARTERS]
    code = F.col("l_suppkey").cast("string").alias("local_authority_region_code")
    wide = counts.select(code, F.lit("Somewhere").alias("local_authority_region_name"), *cells)
    authorities = joins.enrich(
        t.supplier.select("s_suppkey", "s_nationkey"),
        Lookup(t.nation, {"s_nationkey": "n_nationkey"}, ["n_regionkey"], "inner"),
        Lookup(t.region, {"n_regionkey": "r_regionkey"}, ["r_name"], "inner"),
    ).select(F.col("s_suppkey").cast("string").alias("ladcd"), F.col("r_name").alias("cauthnm"))
    long = indicators.chargers_long(wide, authorities)
    return long.withColumn("end_date", F.col("end_date").cast("string"))


@query("i12_renewables_cumulative", """
WITH g AS (SELECT c_nationkey, year(o_orderdate)::INTEGER AS year, sum(o_totalprice) AS mwh FROM orders
           JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
     y AS (SELECT r_name AS cauthnm, 'E4700000' || r_regionkey AS cauthcd, year, sum(mwh) AS total FROM g
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
     a AS (SELECT 'E4700000' || n_regionkey AS cauthcd, count(*) AS km2 FROM customer JOIN nation ON c_nationkey = n_nationkey
           GROUP BY 1),
     r AS (SELECT *, sum(total) OVER (PARTITION BY cauthcd ORDER BY year) AS cum FROM y)
SELECT cauthnm, cauthcd, year, round(total, 2) AS total_mwh, round(cum, 2) AS total_mwh_cum, km2,
    round(cum / km2 / 1000, 6) AS cum_gwh_km2 FROM r JOIN a USING (cauthcd)""")
def _(t):
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("total_mwh"))
    generation = joins.enrich(
        yearly, Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    ).withColumnRenamed("c_nationkey", "la_code")
    nations = joins.enrich(t.nation, Lookup(t.region, {"n_regionkey": "r_regionkey"}, ["r_name"], "inner")).select(
        F.col("n_nationkey").alias("ladcd"), F.col("r_name").alias("cauthnm"),
        F.concat(F.lit("E4700000"), F.col("n_regionkey").cast("string")).alias("cauthcd"),
    )
    counts = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    areas = joins.enrich(counts, Lookup(nations, {"c_nationkey": "ladcd"}, ["cauthcd"], "inner"))
    areas = areas.groupBy("cauthcd").agg(F.sum("n").alias("km2"))
    result = indicators.renewables_cumulative(generation, nations, areas)
    rounded = {"total_mwh": F.round("total_mwh", 2), "total_mwh_cum": F.round("total_mwh_cum", 2),
               "cum_gwh_km2": F.round("cum_gwh_km2", 6)}
    return result.withColumns(rounded)


def _quarters(t: Tables) -> list[str]:
    """Every quarter from the first to the last order, e.g. ``1996 Q4``."""
    first, last = t.orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    spots = range(first.year * 4 + (first.month - 1) // 3, last.year * 4 + (last.month - 1) // 3 + 1)
    return [f"{spot // 4} Q{spot % 4 + 1}" for spot in spots]


@query("i13_licences_long", """
WITH q AS (SELECT strftime(unnest(generate_series(TIMESTAMP '1997-01-01', (SELECT max(o_orderdate) FROM orders), INTERVAL 3 MONTH)),
                           '%Y-%m-%d') AS d),
     k AS (SELECT DISTINCT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region
           ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
     b AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders JOIN k ON o_custkey = c_custkey),
     n AS (SELECT o_custkey, o_orderstatus, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS d, count(*) AS n
           FROM orders GROUP BY ALL)
SELECT b.o_custkey AS lsoa11cd, b.o_orderstatus AS body_type, q.d AS date, coalesce(n.n, 0) AS count
FROM b CROSS JOIN q LEFT JOIN n ON n.o_custkey = b.o_custkey AND n.o_orderstatus = b.o_orderstatus AND n.d = q.d""")
def _(t):
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit(" Q"), F.quarter("o_orderdate").cast("string"))
    keys = [F.col("o_custkey").alias("lsoa11cd"), F.col("o_orderstatus").alias("body_type")]
    wide = t.orders.groupBy(*keys).agg(*[F.count_if(quarter == q).alias(q) for q in _quarters(t)])
    europe = _european_customers(t)
    long = indicators.licences_long(wide, europe, "c_custkey", since="1997-01-01")
    return long.withColumn("date", F.col("date").cast("string"))


def _european_customers(t: Tables) -> DataFrame:
    return joins.enrich(
        t.customer.select("c_custkey", "c_nationkey"),
        Lookup(t.nation, {"c_nationkey": "n_nationkey"}, ["n_regionkey"], "inner"),
        Lookup(t.region.where(F.col("r_name") == "EUROPE"), {"n_regionkey": "r_regionkey"}, ["r_name"], "inner"),
    ).select("c_custkey")


# --- costs, air quality, tables --------------------------------------------------------------


@query("i14_improvement_costs", """
SELECT p_type AS improvement_id_text, round(avg(CASE WHEN l_returnflag <> 'A' THEN (p_size * 1000 + p_size * 1000 + 1500) / 2 END), 6)
    AS mean_cost_of_improvement, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_brand <> 'Brand#1' GROUP BY 1""")
def _(t):
    line = t.lineitem.select("l_partkey", "l_returnflag")
    parts = joins.enrich(line, Lookup(t.part, {"l_partkey": "p_partkey"}, ["p_type", "p_size", "p_brand"], "inner"))
    low = F.concat(F.lit("£"), F.format_number(F.col("p_size") * 1000, 0))
    high = F.concat(F.lit(" - £"), F.format_number(F.col("p_size") * 1000 + 1500, 0))
    cost = F.concat(low, F.when(F.col("l_returnflag") != "A", high).otherwise(""))
    recommendations = parts.select(
        F.col("l_partkey").alias("improvement_id"), F.col("p_type").alias("improvement_id_text"),
        F.when(F.col("p_brand") != "Brand#1", cost).alias("indicative_cost"),
    )
    costs = indicators.improvement_costs(recommendations)
    return costs.withColumn("mean_cost_of_improvement", F.round("mean_cost_of_improvement", 6))


@query("i15_tubes_by_site", """
SELECT c_custkey::INTEGER AS site_id, year, round(no2, 1) AS no2, count, c_name AS location, round(c_acctbal, 6) AS latitude,
    round(c_nationkey / 7.0, 6)::DOUBLE AS longitude FROM (SELECT o_custkey, year(o_orderdate)::INTEGER AS year,
    avg(o_totalprice) * 0.70710678 AS no2, count(*) AS count FROM orders GROUP BY ALL) JOIN customer ON o_custkey = c_custkey""")
def _(t):
    point = F.concat_ws(",", F.col("c_acctbal").cast("string"), (F.col("c_nationkey") / F.lit(7.0).cast("double")).cast("string"))
    raw = t.customer.select(
        F.col("c_custkey").cast("int").alias("siteid"), F.col("c_name").alias("location"), point.alias("geo_point_2d"),
        F.lit(None).cast("string").alias("photopath"), F.lit(None).cast("string").alias("colocated"),
    )
    sites = indicators.monitoring_sites(raw, "photos/")
    tubes = t.orders.groupBy(F.col("o_custkey").cast("int").alias("site_id"), F.year("o_orderdate").alias("year")).agg(
        (F.avg("o_totalprice") * UNTIED).alias("no2"), F.count("*").alias("count")
    )
    return indicators.tubes_by_site(sites, tubes, ["location", "latitude", "longitude"])


@query("i15_annual_means", """
SELECT user_id AS site_id, year(ts)::INTEGER AS year, round(avg(value * 0.70710678), 1) AS mean_no2,
    round(avg(CASE WHEN event_type <> 'error' THEN value * 0.70710678 END), 1) AS mean_pm10 FROM events GROUP BY ALL""")
def _(t):
    hourly = t.events.select(
        F.col("user_id").alias("site_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date_time"),
        (F.col("value") * UNTIED).alias("no2"),
        F.when(F.col("event_type") != "error", F.col("value") * UNTIED).alias("pm10"),
    )
    return indicators.annual_means(indicators.hourly_with_parts(hourly), ["no2", "pm10"])


@query("i16_band_by_rating", f"""
SELECT band AS construction_age_band, """ + ", ".join(
    f"nullif(count(*) FILTER (WHERE o_orderstatus = '{r}'), 0) AS \"{r}\"" for r in "FOP"
) + f" FROM (SELECT o_orderstatus, {band_sql('o_orderkey')} AS band FROM orders) WHERE band IS NOT NULL GROUP BY 1")
def _(t):
    return certificates.band_by_rating(_certs(t), ["F", "O", "P"])


@query("i17_action_tracker", """
SELECT 'Homes' AS pillar, c_mktsegment AS action_areas, CAST(c_custkey AS VARCHAR) AS id, c_name AS action,
    CAST(c_nationkey AS VARCHAR) AS impact, NULL::VARCHAR AS mca_control FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'Resilience ', 'Resilience', CAST(s_suppkey AS VARCHAR), s_name, NULL, 'yes' FROM supplier""")
def _(t):
    homes = t.customer.select(
        F.col("c_mktsegment").alias("Action Areas"), F.col("c_custkey").alias("ID"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("Action"), F.col("c_nationkey").alias("Impact"),
    )
    resilience = t.supplier.select(
        F.lit("mixed").alias("Action areas"), F.col("s_suppkey").alias("ID"), F.col("s_name").alias("Action"),
        F.lit("yes").alias("MCA control"),
    )
    sheets = {"instructions": t.nation.select(F.col("n_name").alias("Action")), "Homes": homes, "Resilience ": resilience}
    columns = ["pillar", "action_areas", "id", "action", "impact", "mca_control"]
    return indicators.action_tracker(sheets, ["instructions"], {"Resilience ": "Resilience"}, columns=columns)


@query("i18_register_report", """
WITH p AS (SELECT * FROM orders WHERE year(o_orderdate) = 1996), r AS (SELECT * FROM orders WHERE year(o_orderdate) = 1997)
SELECT (SELECT count(DISTINCT o_orderpriority) FROM p) AS n_operators, (SELECT count(DISTINCT o_custkey) FROM p) AS n_service_codes,
    (SELECT round(avg(CASE WHEN o_orderstatus = 'F' THEN 100.0 ELSE 0 END), 6) FROM p) AS schema_2_4_pct,
    (SELECT round(avg(CASE WHEN k IN (SELECT o_custkey FROM p) THEN 100.0 ELSE 0 END), 6) FROM (SELECT DISTINCT o_custkey AS k FROM r))
        AS published_licence_pct,
    (SELECT count(DISTINCT o_custkey) FROM r WHERE o_custkey NOT IN (SELECT o_custkey FROM p)) AS n_registered_not_published,
    (SELECT count(DISTINCT o_custkey) FROM p WHERE o_custkey NOT IN (SELECT o_custkey FROM r)) AS n_published_not_registered""")
def _(t):
    registers = [
        filters.in_years(t.orders, "o_orderdate", year, year).select(
            F.col("o_orderpriority").alias("operator"), F.col("o_custkey").alias("service_code"),
            F.col("o_custkey").alias("licence_number"),
            F.when(F.col("o_orderstatus") == "F", "2.4").otherwise("2.1").alias("schema_version"),
        )
        for year in (1996, 1997)
    ]
    report = indicators.register_report(*registers)
    return report.withColumns({c: F.round(c, 6) for c in ("schema_2_4_pct", "published_licence_pct")})


@query("i19_postcode_subset", """
SELECT c_custkey AS pcds, c_nationkey AS ladcd, c_name AS ward FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA'""")
def _(t):
    path = fresh_dir(t.spark, "i19")
    directory = t.customer.select("c_custkey", "c_nationkey", "c_name").toDF("pcds", "oslaua", "osward")
    writers.write_csv(directory, path)
    loaded = readers.read_declared_csv(t.spark, path, directory.schema)
    africa = joins.keep_listed(t.nation, t.region.where(F.col("r_name") == "AFRICA"), {"n_regionkey": "r_regionkey"})
    columns = {"pcds": "pcds", "oslaua": "ladcd", "osward": "ward"}
    return certificates.postcode_subset(loaded, africa, "n_nationkey", columns)


@query("i20_postcode_deprivation", """
SELECT c_custkey AS pcds, c_nationkey AS lsoa11cd, c_mktsegment AS msoa11cd, n_nationkey AS ladcd, n_name AS ladnm,
    r_regionkey AS cauthcd, r_name AS cauthnm, CASE WHEN c_nationkey > 3 THEN c_nationkey * 10 END AS imd19
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""")
def _(t):
    return _postcode_deprivation(t)


def _postcode_deprivation(t: Tables) -> DataFrame:
    lookup = joins.enrich(t.customer, Lookup(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner")).select(
        F.col("c_custkey").alias("pcds"), F.col("c_nationkey").alias("lsoa11cd"), F.col("c_mktsegment").alias("msoa11cd"),
        F.col("c_nationkey").alias("ladcd"), F.col("n_name").alias("ladnm"),
    )
    regions = t.region.where(F.col("r_name") != "ASIA")
    authorities = joins.enrich(
        t.nation, Lookup(regions, {"n_regionkey": "r_regionkey"}, ["r_regionkey", "r_name"], "inner")
    ).select(F.col("n_name").alias("ladnm"), F.col("r_regionkey").alias("cauthcd"), F.col("r_name").alias("cauthnm"))
    imd = t.nation.where(F.col("n_nationkey") > 3).select(
        F.col("n_nationkey").alias("lsoa11cd"), (F.col("n_nationkey") * 10).alias("imd19")
    )
    return certificates.postcode_deprivation(lookup, authorities, imd)


@query("i20_missing_deprivation", """
SELECT round(avg(CASE WHEN c_nationkey > 3 THEN 0.0 ELSE 100.0 END), 6) AS missing_pct FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""")
def _(t):
    return _postcode_deprivation(t).agg(F.round(quality.missing_percent("imd19"), 6).alias("missing_pct"))


@query("i21_rating_distribution", f"""
WITH {_CERTS}, l AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY uprn ORDER BY lodgement_datetime DESC) AS r FROM certs)
    WHERE r = 1)
SELECT current_energy_rating, count(*) AS n FROM l LEFT JOIN customer ON postcode = c_custkey
WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def _(t):
    areas = t.customer.select(F.col("c_custkey").alias("pcds"), F.col("c_mktsegment").alias("msoa21nm"))
    return certificates.rating_distribution(_certs(t), areas, F.col("msoa21nm") == "BUILDING")


@query("i22_tenure_wide", """
SELECT c_name AS lsoa_name, o_custkey AS lsoa21cd, """ + ", ".join(
    f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 END) AS BIGINT) AS \"{c}\"" for p, c in (
        ("1-URGENT", "1_urgent"), ("2-HIGH", "2_high"), ("4-NOT SPECIFIED", "4_not_specified"), ("3-MEDIUM", "3_medium"), ("5-LOW", "5_low"))
) + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def _(t):
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("OBS_VALUE"))
    long = joins.enrich(counts, Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_name"], "inner")).select(
        F.col("c_name").alias("GEOGRAPHY_NAME"), F.col("o_custkey").alias("GEOGRAPHY_CODE"),
        F.col("o_orderpriority").alias("C2021_TENURE_9_NAME"), "OBS_VALUE",
    )
    return indicators.tenure_wide(long)
