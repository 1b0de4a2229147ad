"""tidepool: event-stream analytics operators expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function that takes column
names as arguments.  The same function serves tables and Structured
Streaming sources wherever Spark allows it; the ``streaming`` package holds
the runners and stateful processors for the cases where it does not.

    from tidepool.operators import windows, rolling, changes, rules
"""

__all__ = ["session", "sources", "sinks", "functions", "operators", "plans", "streaming"]
