"""Water-balance forecasting tables on Spark.

``functions`` holds column expressions, ``sources`` readers, writers and keyed tables, ``operators`` the DataFrame
operators, ``streaming`` the incremental ingest, ``plans`` the end-to-end flows, and ``catalog`` the registered queries
over the test tables with their SQL counterparts.
"""
