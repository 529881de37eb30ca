"""Gold tables, reports and the jobs that build the layers."""
