"""Cohort variant analytics as Spark DataFrame jobs.

The cohort is a star schema of long tables (``sites``, ``calls``,
``ref_blocks``, ``samples``); every operator takes DataFrames and returns
DataFrames, holds no global session and never pulls data to the driver.
"""

__version__ = "0.1.0"
