"""vidlens: video engagement analytics by search keyword, on Spark.

Pure ``DataFrame -> DataFrame`` functions; the session and all I/O stay at
the edges (``vidlens.sources``, ``vidlens.sinks``, ``vidlens.streaming``).
"""

__version__ = "0.1.0"
