"""tidemark: daily app-analytics events on Spark, from nested raw rows to marts."""
