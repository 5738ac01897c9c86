"""strata: Spark-native medallion analytics — flattening, cleansing, keyed merge,
hierarchy roll-up, classified marts and analytic questions as DataFrame operators."""

__version__ = "0.1.0"
