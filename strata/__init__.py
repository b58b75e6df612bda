"""strata: panel-data analytics, cleaning, imputation, evaluation and forecasting on Spark.

Every operator is a DataFrame -> DataFrame function built from native Spark SQL
expressions, windows, joins and aggregates.  Sub-packages:

* ``sources``   – scans, sinks, stage layout, record stores and the derived fixtures
* ``functions`` – column-expression helpers and scalable order statistics / prefix sums
* ``operators`` – the panel operators (clean, profile, impute, features, split, balance,
                  metrics, models, forecast)
* ``plans``     – the registered query catalog and its SQL oracles
* ``streaming`` – Structured Streaming scorer
"""

__version__ = "0.1.0"
