"""qtrlens — revenue, churn and small text/event analytics as Spark jobs.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from the
DataFrame API, so it composes with ``DataFrame.transform`` and is planned by
Catalyst like any other query.
"""

__version__ = "0.1.0"
