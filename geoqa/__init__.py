"""geoqa: map-conflation and data-quality checks as Spark DataFrame operators.

Sub-packages
------------
functions   column expressions (geometry measures, CRS, text normalisers)
operators   DataFrame -> DataFrame operators (grid spatial joins, clustering,
            hulls, ranking)
sources     readers for feature tables / address dumps / GeoJSON, report sinks
plans       the checks (one plan per anomaly class) and the test fixtures
streaming   incremental re-run of a check over newly arriving files
"""

__version__ = "0.1.0"
