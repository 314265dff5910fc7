"""Set-based business data jobs on Spark DataFrames."""
