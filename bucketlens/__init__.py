"""bucketlens — object-storage access-log and inventory analytics on Spark.

Every operator is a plain ``DataFrame → DataFrame`` function built from Spark's
own expressions, windows, aggregates and joins; nothing collects to the
driver or creates a session.
"""

__version__ = "0.1.0"
