"""The queries that show every operator at work, with SQL to check them against."""
