"""Web-archive analytics on Spark: WARC scan, normalisation, text extraction, classification and keyed tables."""
