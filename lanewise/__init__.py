"""Delay analytics over origin/destination event tables, built on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames (or a small object
holding them); nothing here runs row-at-a-time Python or brings a table to the
driver.  The packages:

``functions``  column expressions (buckets, route names, hash fractions)
``sources``    table and message scans, the keyed parquet table
``operators``  reports, confusion ratios, sampling, graph queries, classification
``streaming``  message decoding, scoring, keyed sink, tail and publish jobs
``plans``      the registered queries and their plain-SQL twins
"""
