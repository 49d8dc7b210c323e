"""Weekly sales-and-inventory mart for a retailer, as PySpark DataFrame jobs."""
