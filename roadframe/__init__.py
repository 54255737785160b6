"""roadframe — Spark-native road-accident analytics.

Turns multi-year, multi-file accident records into one wide model-ready
table and evaluates injury-severity classifiers on it. Every operator is a
plain ``DataFrame -> DataFrame`` function (usable with ``df.transform``)
whose rules and column names are parameters, so it runs on any table.

Sub-packages
------------
sources    scans, probes, lookup/rule documents, sinks
functions  Column-expression builders (no Python UDFs)
operators  DataFrame operators: joins, group features, statistics,
           profiling, sampling, preparation, models, evaluation, explanation
plans      end-to-end plans (ETL, training, scoring) and the proof queries
"""

from roadframe.session import checkpoint_dir, get_spark  # noqa: F401

__version__ = "0.1.0"
