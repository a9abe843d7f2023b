"""Analytics for recognised documents and training corpora, on Spark."""
