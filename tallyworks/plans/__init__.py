"""The reports and jobs, as functions from DataFrames to DataFrames."""
