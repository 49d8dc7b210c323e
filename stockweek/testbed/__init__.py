"""The five retail tables derived from the star-schema test data, in Spark and in SQL."""
