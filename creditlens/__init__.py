"""creditlens — card-account spend, risk and credit-line analytics on Spark.

Everything is DataFrame / Spark SQL / Spark ML.  Sub-packages:

* ``sources``   – table loading, role views over the driver tables, sinks
* ``functions`` – pure ``Column`` builders (business rules, parsing, maths)
* ``operators`` – DataFrame -> DataFrame operators (rollups, sampling, FX,
                  reports, metrics, models)
* ``plans``     – the query registry used by ``__spark_entry__`` and bench
* ``streaming`` – incremental (Structured Streaming) form of the spend rollup
"""

from creditlens.session import get_spark, checkpoint_dir  # noqa: F401
