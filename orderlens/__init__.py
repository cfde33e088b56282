"""orderlens: Spark-native analytics for order-item returns.

Layers (all DataFrame / SQL / ML work on Spark):

* ``sources``   -- typed scans, sentinel handling, the driver-table adapter,
                   lookup sources (colour map, name lists) and sinks.
* ``functions`` -- column-expression builders (sizes, colours, cost, logit).
* ``operators`` -- cleaning, fitted feature tables, EDA aggregates, cost and
                   cutoff sweeps, AUC, k-NN, models, genetic search.
* ``plans``     -- registered queries and their DuckDB oracle SQL.
* ``streaming`` -- applying a fitted feature spec to a stream.
"""

__all__ = ["session"]


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers need not have it installed."""
    import sys

    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - optional
        pass


_ship_by_value()
