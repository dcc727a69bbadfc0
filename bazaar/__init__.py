"""bazaar: retail sales analytics as Spark DataFrame jobs.

Every public operator is a plain function ``DataFrame(s) -> DataFrame``; nothing
is collected to the driver unless the result is a bounded, one-row report.
"""

__version__ = "0.1.0"
