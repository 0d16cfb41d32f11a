"""adfuse: multi-channel advertising analytics as lazy Spark DataFrame operators.

Conform any number of channel feeds (declared by ``FeedSpec``) into one
unified fact, then roll up, window, rank and present it -- every step a
DataFrame -> DataFrame transformation planned by Catalyst.
"""

from adfuse.schema import FACT_COLUMNS, FACT_SCHEMA

__version__ = "0.1.0"

__all__ = ["FACT_COLUMNS", "FACT_SCHEMA", "__version__"]
