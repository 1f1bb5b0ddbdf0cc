"""Record linkage and large-scale table processing on PySpark."""
