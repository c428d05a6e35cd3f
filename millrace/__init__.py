"""DataFrame jobs for log, text, rating, regression, click and series analytics."""
