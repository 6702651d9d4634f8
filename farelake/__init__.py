"""farelake: trip-record analytics on Spark DataFrames.

Land monthly trip files, clean them with named rules, load a star schema with
surrogate keys and repeatable loads, answer a library of reports, and train and
score a total-amount regression with Spark ML.
"""

from farelake.session import checkpoint_base, get_spark

__all__ = ["get_spark", "checkpoint_base"]
