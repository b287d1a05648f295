"""Errors raised by the gates; each keeps the offending rows as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame


class QualityError(ValueError):
    """A data-quality gate failed. ``rows`` holds every offending row, lazily."""

    def __init__(self, message: str, rows: DataFrame | None = None):
        super().__init__(message)
        self.rows = rows


class CaptureError(RuntimeError):
    """A capture cannot be preserved safely."""


class WeatherError(RuntimeError):
    """A weather payload cannot be used."""
