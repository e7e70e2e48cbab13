"""clickfeat: click-log features as Spark DataFrame jobs."""
