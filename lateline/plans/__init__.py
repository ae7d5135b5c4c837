"""Declared tables, report views and the batch jobs that write them."""
