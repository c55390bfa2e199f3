"""Ready-made models: functions of DataFrames, by layer."""
