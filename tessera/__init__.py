"""tessera: panel time-series analytics on Spark DataFrames.

Modules:
  sources    - table readers/writers and panel sources built from the test tables
  functions  - column expressions (calendar, cyclic, holiday, text)
  operators  - DataFrame operators (panel, features, cleaning, profiling,
               models, forecasting, evaluation)
  plans      - registered queries, their SQL oracles and the end-to-end run
  streaming  - Structured Streaming form of the panel builder
"""

__version__ = "0.1.0"
