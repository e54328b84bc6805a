"""DataFrame operators: statistics, decomposition, sampling, K-means, Gaussian mixtures, metrics."""
