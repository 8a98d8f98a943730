"""textflow: text curation and retrieval evaluation on Spark DataFrames."""
