"""Dimensional warehousing on Spark DataFrames.

Wide snapshots become long facts, customer attributes become a Type 2
dimension, facts meet the version valid in their month, and every batch is
audited before it is published.  All operators are DataFrame -> DataFrame
functions made of built-in Spark expressions; there are no Python UDFs.
"""

__version__ = "0.1.0"
