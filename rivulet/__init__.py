"""A PySpark-native engine for gridded and vector time series, with operators for training data."""
