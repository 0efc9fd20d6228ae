"""Training-data operators over tables of documents and embeddings."""
