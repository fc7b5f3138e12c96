"""forecastry: retail demand forecasting as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``-> Model``)
built from stock ``pyspark.sql`` / ``pyspark.ml``; nothing runs until an
action, so Catalyst sees whole plans and does the pruning, pushdown and
partial aggregation.  Job-level composition (read, persist, write) lives
in :mod:`forecastry.plans.jobs`.
"""

__version__ = "0.1.0"
