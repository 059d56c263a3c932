"""Great-circle geometry as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareflow.schemas import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points; null when any coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def initial_bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Heading from point 1 to point 2 in [0, 360)."""
    d_lon = F.radians(lon2 - lon1)
    east = F.sin(d_lon) * F.cos(F.radians(lat2))
    north = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.cos(d_lon)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def destination_lat(lat: Column, bearing_deg: Column, distance_km: Column) -> Column:
    """Latitude reached after ``distance_km`` along ``bearing_deg``."""
    angle = distance_km / EARTH_RADIUS_KM
    return F.degrees(
        F.asin(
            F.sin(F.radians(lat)) * F.cos(angle)
            + F.cos(F.radians(lat)) * F.sin(angle) * F.cos(F.radians(bearing_deg))
        )
    )


def destination_lon(lat: Column, lon: Column, bearing_deg: Column, distance_km: Column) -> Column:
    """Longitude reached after ``distance_km`` along ``bearing_deg``, wrapped to [-180, 180)."""
    angle = distance_km / EARTH_RADIUS_KM
    end_lat = F.radians(destination_lat(lat, bearing_deg, distance_km))
    turn = F.atan2(
        F.sin(F.radians(bearing_deg)) * F.sin(angle) * F.cos(F.radians(lat)),
        F.cos(angle) - F.sin(F.radians(lat)) * F.sin(end_lat),
    )
    return F.pmod(F.degrees(F.radians(lon) + turn) + 540.0, F.lit(360.0)) - 180.0
