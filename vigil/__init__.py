"""Data-health analytics on Spark: expectations, metrics, lineage, profiles, alerts.

Every operator takes DataFrames and returns a DataFrame; whatever depends on
"now" takes an explicit ``as_of``.
"""

__version__ = "0.1.0"
