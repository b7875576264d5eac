"""snapdeck: daily snapshot analytics on Spark DataFrames.

Layers: ``functions`` (Column builders), ``operators`` (DataFrame -> DataFrame
building blocks), ``sources`` (schemas, JSON ingest, lake and fixtures),
``plans`` (staging/metric/mart models, checks, serving queries, the daily
job) and ``streaming`` (the windowed error alert).
"""

__version__ = "0.1.0"
