"""Table operators: functions from DataFrames to a DataFrame. None of them runs a job."""
