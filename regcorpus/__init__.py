"""regcorpus — regulatory/legal corpus analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, joins and windows.  Sub-packages:

* ``sources``   — landed inputs (paged JSON envelopes, files, front matter, tables)
* ``functions`` — column expressions (identifiers, dates, text clean-up, JSON get)
* ``operators`` — records, paging, flow (joins/aggregations), markup, corpus, rules
* ``plans``     — registered queries over the driver tables and their SQL oracles
* ``streaming`` — incremental ingest and keyed upsert
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python tasks (Arrow jobs, the SQL table function) must not depend on
    the package being installed on executors: functions and classes of this
    package are pickled by value into the task closures."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):  # older cloudpickle: rely on an installed package
        pass


_ship_by_value()
