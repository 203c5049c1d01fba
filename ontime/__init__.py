"""ontime: delay analytics on Spark DataFrames.

Sub-packages:
  sources/    readers for raw flights, weather, stations, airports; table registration
  functions/  Column expressions (cleaning, features, score presentation)
  operators/  DataFrame operators (EDA reports, geo matching, joins, sampling, ML, evaluation)
  plans/      end-to-end jobs and the query catalog over the driver tables
  streaming/  nothing: the workload is batch only (see README)
"""

__version__ = "0.1.0"
