"""Refinery: data curation and analysis operators on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and leaves
planning to Catalyst. What reaches the driver is of a fixed size: counts, marks,
names of folders.
"""

__version__ = "0.1.0"
