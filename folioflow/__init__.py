"""folioflow: bibliographic data processing and analytics on Spark DataFrames."""
