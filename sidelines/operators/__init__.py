"""DataFrame-to-DataFrame operators that the plans are assembled from."""
