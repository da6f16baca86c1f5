"""Geodesy as Column expressions, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: mean earth radius in metres and the WGS-84 ellipsoid
EARTH_RADIUS_M = 6_371_000.0
WGS84_A = 6_378_137.0
WGS84_F = 1.0 / 298.257_223_563
WGS84_E2 = 2 * WGS84_F - WGS84_F * WGS84_F


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))))


def ecef(lat: Column, lon: Column, alt: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates of a geodetic position."""
    phi, lam = F.radians(lat), F.radians(lon)
    normal = WGS84_A / F.sqrt(1.0 - WGS84_E2 * F.sin(phi) * F.sin(phi))
    ring = (normal + alt) * F.cos(phi)
    return ring * F.cos(lam), ring * F.sin(lam), (normal * (1.0 - WGS84_E2) + alt) * F.sin(phi)


def enu(point: tuple[Column, Column, Column], origin: tuple[Column, Column, Column], lat0: Column, lon0: Column) -> tuple[Column, Column, Column]:
    """East, north and up of an earth-centred point, seen from an earth-centred origin at ``lat0``, ``lon0``."""
    dx, dy, dz = (p - o for p, o in zip(point, origin))
    phi, lam = F.radians(lat0), F.radians(lon0)
    along = F.cos(lam) * dx + F.sin(lam) * dy
    return -F.sin(lam) * dx + F.cos(lam) * dy, -F.sin(phi) * along + F.cos(phi) * dz, F.cos(phi) * along + F.sin(phi) * dz


def norm3(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)
