"""Column functions on text, vectors and byte-pair ids."""
