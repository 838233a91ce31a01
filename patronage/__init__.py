"""patronage — customer-value analytics on Spark.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) so that a whole run stays one lazy plan that Catalyst can
optimise; actions happen only in sinks, model fits and lineage cuts.
"""

__version__ = "0.1.0"
