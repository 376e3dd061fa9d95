"""churnkit — customer-churn analytics expressed as Spark DataFrame plans.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects
(or a fitted model), receives column names as parameters and leaves the
physical plan to Catalyst/AQE.  Sub-packages:

* ``sources``   — table readers, test-table adapters, layer/manifest IO
* ``functions`` — column-expression builders (cleaning, encoding, bins, decisions)
* ``operators`` — DataFrame -> DataFrame operators (OLAP, profiling, evaluation,
                  models, segmentation, outliers)
* ``plans``     — end-to-end jobs (ETL layers, training, segmentation) and the
                  catalogue of named queries used by ``__spark_entry__``
* ``streaming`` — the same scoring operators applied to a Structured Stream
"""

from churnkit.spec import ChurnSpec

__all__ = ["ChurnSpec"]
