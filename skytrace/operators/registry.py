"""Registry filter by brand and model, and the semi join that keeps states of registered aircraft."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: brand and model patterns of the aircraft families that are kept
BRAND = r"(?i)cessna|reims|fuji.*cessna|piper|diamond|hoac|cirrus"
CESSNA_BRAND = r"cessna|reims|fuji.*cessna"
CESSNA_MODEL = r"(?i)(?<!\d)(150|152|162|172|177|180|182|185|206|207|210|310|336|337|340|402|414|421)(?!\d)"
PIPER_BRAND = r"piper"
PIPER_MODEL = r"(?i)(\bJ[ -]?[35](?!\d)|PA[ -]?(11|12|16|18|20|22|23|24|28|30|32|34|38|44)(?!\d))"
CIRRUS_BRAND = r"cirrus"
CIRRUS_MODEL = r"(?i)\bSR[ -]?2[02]"
DIAMOND_BRAND = r"diamond|hoac"
DIAMOND_MODEL = r"(?i)(\bDA[ -]?(20|40|42|62)(?!\d)|\bDV[ -]?2[02]\b|\bHK[ -]?36(?!\d)|\bKatana\b|\bTwin[ \-]?Star\b|\bDiamond[ \-]?Star\b)"


def has_brand(manufacturer: Column) -> Column:
    return F.coalesce(manufacturer.rlike(BRAND), F.lit(False))


def has_model(manufacturer: Column, model: Column) -> Column:
    """The first brand that matches decides; a miss of its models isn't made good by another brand."""
    name = F.lower(F.coalesce(manufacturer, F.lit("nan")))
    model = F.coalesce(model, F.lit("nan"))
    return (
        F.when(name.rlike(CESSNA_BRAND), model.rlike(CESSNA_MODEL))
        .when(name.rlike(PIPER_BRAND), model.rlike(PIPER_MODEL))
        .when(name.rlike(CIRRUS_BRAND), model.rlike(CIRRUS_MODEL))
        .when(name.rlike(DIAMOND_BRAND), model.rlike(DIAMOND_MODEL))
        .otherwise(F.lit(False))
    )


def filter_registry(registry: DataFrame) -> DataFrame:
    return registry.where(has_brand(F.col("manufacturername")) & has_model(F.col("manufacturername"), F.col("model")))


def keep_registered(states: DataFrame, registry: DataFrame) -> DataFrame:
    """States of registered aircraft.

    No hint: the planner broadcasts the distinct codes only if their size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and merges otherwise.
    """
    return states.join(registry.select("icao24").distinct(), "icao24", "left_semi")


def order_states(states: DataFrame) -> DataFrame:
    """Partitioned by day and aircraft, and ordered by time within each."""
    return states.repartition("date", "icao24").sortWithinPartitions("date", "icao24", "time")
