"""Features whose attributes are not declared beforehand: every layer of a service has its own.

Pages of features are read as text and kept as VARIANT values, so layers with different attributes stand in
one table. What a layer holds is found from the data; what is asked for is taken out with a type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_FEATURES = "array<variant>"


def read_open_features(spark: SparkSession, path, whole_files: bool = True) -> DataFrame:
    """``layer, page, attributes, geometry``: one row per feature of JSON pages ``{"features": [...]}``.

    A page is a file, or a line of one with ``whole_files=False``. ``layer`` is the folder the file lies in,
    without a ``name=`` in front. A page without features gives no row; one that is no JSON gives one row without
    attributes and geometry, so that it can be counted.
    """
    pages = spark.read.text(path, wholetext=whole_files)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]*$", 1)
    parsed = pages.select(folder.alias("layer"), F.col("_metadata.file_name").alias("page"), F.try_parse_json("value").alias("doc"))
    listed = F.when(F.col("doc").isNull(), F.array(F.lit(None).cast("variant"))).otherwise(F.try_variant_get("doc", "$.features", _FEATURES))
    features = parsed.select("layer", "page", F.explode(listed).alias("f"))
    return features.select(
        "layer", "page", F.try_variant_get("f", "$.attributes", "variant").alias("attributes"),
        F.try_variant_get("f", "$.geometry", "variant").alias("geometry"),
    )


def found_types(features: DataFrame, by=("layer",)) -> DataFrame:
    """The type that holds all attributes of a layer, as text: ``OBJECT<code: STRING, n: BIGINT>``."""
    return features.groupBy(*by).agg(F.schema_of_variant_agg("attributes").alias("attributes_type"), F.count("attributes").alias("n_features"))


def attribute(name: str) -> str:
    """Path of an attribute, whatever characters its name has, as long as it has one kind of quotes only."""
    if '"' in name and "'" in name:
        raise ValueError(f"an attribute with both kinds of quotes has no path: {name}")
    return f"$['{name}']" if '"' in name else f'$["{name}"]'


def typed_attributes(features: DataFrame, wanted: dict[str, str], strict: bool = False, keep=("layer",)) -> DataFrame:
    """Asked-for attributes as columns of the given types; null where a feature lacks one.

    A value that does not fit its type is null too, or an error with ``strict``. A coordinate is asked for as
    ``geometry.x``.
    """
    get = F.variant_get if strict else F.try_variant_get

    def column(name: str, kind: str):
        if name.startswith("geometry."):
            return get("geometry", attribute(name.removeprefix("geometry.")), kind).alias(name.removeprefix("geometry."))
        return get("attributes", attribute(name), kind).alias(name)

    return features.select(*keep, *[column(name, kind) for name, kind in wanted.items()])
