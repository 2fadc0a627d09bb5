"""Larchfield: medallion-style analytics operators on the public PySpark API.

Every operator is a function from DataFrame to DataFrame. Nothing here runs a
job unless its docstring says so.
"""
