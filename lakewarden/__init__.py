"""Table ingestion, versioning, data quality and drift as Spark jobs.

Every operator is a lazy function from DataFrames to a DataFrame. "Now" is
always a parameter (``as_of``), so results repeat.
"""
