"""Wind-turbine SCADA analytics on Spark DataFrames."""
