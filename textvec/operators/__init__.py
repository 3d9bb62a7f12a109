"""Sharding, layout, embedding and nearest-word operators: DataFrame in, DataFrame out."""
