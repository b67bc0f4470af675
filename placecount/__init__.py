"""Distributed analytics over counts observed at places, dates and time slots."""

from placecount.roles import OBS_COLUMNS, OBS_SCHEMA, Roles, conform

__all__ = ["OBS_COLUMNS", "OBS_SCHEMA", "Roles", "conform"]
