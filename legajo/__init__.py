"""legajo: résumé and job-description processing as Spark DataFrame jobs."""
