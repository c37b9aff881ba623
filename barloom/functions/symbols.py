"""Symbol classification and naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exchange marker, its quote suffix and the class names.
EXCHANGE = "BINANCE"
QUOTE = "USDT"
CRYPTO = "Crypto"
STOCK = "Stock"


def asset_class(symbol: Column) -> Column:
    """``Crypto`` when the symbol names the crypto exchange anywhere, else ``Stock``."""
    return F.when(symbol.contains(EXCHANGE), CRYPTO).otherwise(STOCK)


def vendor_symbol(symbol: Column) -> Column:
    """Name under which the bar vendor lists a symbol.

    ``BINANCE:BTCUSDT`` is ``BTC-USD``; every other symbol keeps its own name.
    """
    return F.regexp_replace(symbol, f"^{EXCHANGE}:(.*){QUOTE}$", "$1-USD")


def path_safe(symbol: Column) -> Column:
    """Symbol text usable as a path segment."""
    return F.translate(symbol, ":", "_")
