"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, digits: int | None = 2
) -> Column:
    """Haversine distance in km; the half-chord is clipped to [0, 1] before the arc.

    ``digits=None`` leaves the value unrounded.
    """
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_dlat * half_dlat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    )
    # greatest/least skip nulls, so a missing coordinate has to be kept apart.
    clipped = F.when(chord.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), chord)))
    km = 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(clipped), F.sqrt(1 - clipped))
    return km if digits is None else F.round(km, digits)
