"""Features, training, comparison and persistence of classifiers on Spark ML."""
