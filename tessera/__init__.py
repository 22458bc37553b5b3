"""tessera: record linkage and corpus analytics as composable PySpark DataFrame transformations."""
