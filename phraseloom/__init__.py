"""phraseloom: a PySpark-native engine for curating phrase and example-sentence datasets."""
