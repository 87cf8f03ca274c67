"""Marlstone: analytics requests, operators and lakehouse jobs as Spark DataFrames."""
