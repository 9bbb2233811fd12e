"""facetflow: product-listing analytics as PySpark DataFrame operators."""
