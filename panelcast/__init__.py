"""panelcast: panel time-series features and classifier evaluation on Spark.

Every operator takes and returns DataFrames keyed by ``series_id``; nothing
here pulls data to the driver except model fits and argument checks.
"""

__version__ = "0.1.0"
