"""Spark-native ingest, merge and data-quality library.

``sources`` scan files, catalogs and records, ``functions`` hold column
functions and type mapping, ``operators`` transform frames, ``sinks`` write
them, ``streaming`` runs envelope streams and ``plans`` puts whole jobs
together. No module sets a master or keeps data on the driver.
"""
