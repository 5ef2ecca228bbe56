"""layerkit: layered tables (raw -> clean -> aggregate) as plain Spark DataFrame operators."""

from layerkit.contract import Contract
from layerkit.session import configure

__all__ = ["Contract", "configure"]
