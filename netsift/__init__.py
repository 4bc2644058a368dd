"""netsift: Spark-native preparation, labelling, rebalancing, binning,
classification and evaluation of network connection records."""

__version__ = "0.1.0"
