"""DataFrame -> DataFrame operators: parse, encode, stats, sample, evaluate,
k-means, anomaly detection, report preparation."""
