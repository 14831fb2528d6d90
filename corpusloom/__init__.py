"""Site-corpus engine on PySpark: fetched pages in, structured corpora out."""
