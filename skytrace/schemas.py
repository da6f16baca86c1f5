"""Fixed schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}


def _struct(text: str) -> T.StructType:
    """A schema from ``name type`` pairs; needs no session."""
    return T.StructType([T.StructField(n, TYPES[t]) for n, t in (x.split() for x in text.split(","))])


STATES = _struct(
    "time bigint, icao24 string, lat double, lon double, velocity double, heading double, vertrate double, callsign string, "
    "onground boolean, spi boolean, alert boolean, squawk string, baroaltitude double, geoaltitude double, lastposupdate double, lastcontact double"
)
REGISTRY = _struct("icao24 string, manufacturername string, model string")

SEGMENT_COLUMNS = ["time", "icao24", "lat", "lon", "velocity", "heading", "vertrate", "callsign", "squawk", "altitude", "date", "segment_id"]
ENU_COLUMNS = ["E_m", "N_m", "U_m", "vE_mps", "vN_mps", "vU_mps"]
ACCEL_COLUMNS = ["speed_mps", "aE_mps2", "aN_mps2", "aU_mps2", "accel_mps2"]


def require(columns: list[str], required: list[str], what: str) -> None:
    """Raises ValueError if any required column is missing."""
    if missing := [c for c in required if c not in columns]:
        raise ValueError(f"{what}: missing columns {missing}")
