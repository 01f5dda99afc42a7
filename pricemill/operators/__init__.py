"""DataFrame operators. Column names are arguments; nothing here runs a job."""
