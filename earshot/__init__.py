"""A Spark-native batch engine for listening recommendations.

Delimited rating and play-count text goes in; a saved ALS model and one wide
row per user come out.  See the README for the map of modules.
"""
