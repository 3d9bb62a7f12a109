"""Text corpora to word embeddings and nearest words, on Spark."""
