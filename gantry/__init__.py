"""gantry: market-data certification and dataset building on PySpark DataFrames."""
