"""canopy: a Spark-native engine for auditing permits against public registries."""
