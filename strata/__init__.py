"""strata: layered (raw -> curated -> refined) listening analytics on Spark.

Pure ``DataFrame -> DataFrame`` functions; no global session.
"""

__version__ = "0.1.0"
