"""Inventory and demand analytics as Spark DataFrame operators.

Every operator maps DataFrames to a DataFrame, takes an explicit ``as_of`` date,
and is built from Spark SQL expressions so that Catalyst plans the work.
"""

from stocklens.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
