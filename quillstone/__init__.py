"""quillstone: Spark-native processing of ownership filings, market bars and their texts."""
