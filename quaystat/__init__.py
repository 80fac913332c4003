"""Departure-delay analytics on Spark.

Layers: raw board snapshots (bronze) -> flat observations (silver) ->
star schema with upserts (gold) -> latest estimate per logical departure ->
delay reports. Every operator is a ``DataFrame -> DataFrame`` function; the
caller owns the ``SparkSession``.
"""

__version__ = "0.1.0"
