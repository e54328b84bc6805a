"""Spark-native matrix analytics and clustering (PCA, K-means, Gaussian-mixture EM, cluster metrics)."""

__version__ = "0.1.0"
