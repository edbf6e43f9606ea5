"""tessera — a Spark-native engine for landing and querying vendor time-series observations.

Every public operator is ``DataFrame(s) -> DataFrame`` (or a ``Column`` expression) built from
the DataFrame/SQL API, so Catalyst plans, prunes and pushes down the whole job.
"""

__version__ = "0.1.0"
