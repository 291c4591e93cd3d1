"""tessera: tabular analytics, features, evaluation and recommendation on Spark.

Every public function takes and returns DataFrames.  Heavy work stays in
Catalyst / Tungsten (built-in expressions, joins, aggregates, windows);
only metric tables and one-row fitted scalars ever reach the driver.
"""

from tessera.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
