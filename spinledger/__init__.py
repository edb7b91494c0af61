"""Play-event analytics as lazy PySpark DataFrames.

Every public operator takes DataFrames plus explicit parameters (``as_of``, ``tz``,
thresholds) and returns a lazy DataFrame. Nothing here collects data to the driver.
"""

__version__ = "0.1.0"
