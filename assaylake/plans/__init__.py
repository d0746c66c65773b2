"""Marts, reports, table store and the jobs that chain them."""
