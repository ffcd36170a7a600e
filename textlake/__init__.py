"""textlake: labelled text corpora as PySpark DataFrame plans."""
