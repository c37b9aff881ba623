from barloom.functions.symbols import asset_class, path_safe, vendor_symbol
from barloom.functions.times import (
    date_parts,
    epoch_ms,
    ms_to_instant,
    ms_to_utc,
    utc_wall,
)

__all__ = [
    "asset_class",
    "date_parts",
    "epoch_ms",
    "ms_to_instant",
    "ms_to_utc",
    "path_safe",
    "utc_wall",
    "vendor_symbol",
]
