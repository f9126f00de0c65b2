"""sectionmap: a Spark-native index of recorded land-survey maps.

Maps are indexed by the public land survey grid (township, range, section and
quarter-quarter cell).  Every operator is a DataFrame-in / DataFrame-out
function built from Spark SQL expressions, joins, windows and aggregates.
"""

__version__ = "0.1.0"
