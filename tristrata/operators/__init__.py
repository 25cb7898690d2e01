"""DataFrame to DataFrame steps; the row-wise ones also run on streams."""
