"""broadloom: named, parameterised DataFrame operators for PySpark 4.

Every operator takes DataFrames and column names and returns a lazy DataFrame.
Operators that must look at the data first (cut points, size checks) say so in
their docstring and only ever bring a bounded number of rows to the driver.
"""

__version__ = "0.1.0"
