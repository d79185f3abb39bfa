"""panelcast — Spark-native toolkit for sparse sales panels (entity x month x family).

Every operator is a DataFrame -> DataFrame function built from Spark SQL
primitives; the stages in :mod:`panelcast.plans` compose them.
"""

__version__ = "0.1.0"
