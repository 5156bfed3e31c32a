"""Spark-native analytics for tissue-image tables: histograms, quality flags, label and
region joins, sheet loading and stratified region sampling, as DataFrame operators."""
