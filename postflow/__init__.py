"""Batch and streaming analytics over short social posts, built on Spark DataFrames."""
