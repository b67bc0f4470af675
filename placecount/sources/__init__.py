from placecount.sources.cache import ObservationCache
from placecount.sources.layouts import read_layouts
from placecount.sources.reader import read_obs, read_stream
from placecount.sources.report import LoadReport, load_report
from placecount.sources.sink import export, land

__all__ = [
    "LoadReport",
    "ObservationCache",
    "export",
    "land",
    "load_report",
    "read_layouts",
    "read_obs",
    "read_stream",
]
