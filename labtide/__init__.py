"""Laboratory-operations analytics on Spark: turnaround, activity and public-health reporting."""
