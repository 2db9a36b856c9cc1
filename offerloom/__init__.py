"""Retail offers on Spark: captured pages in, clean comparable offers out.

Everything in this package is a DataFrame -> DataFrame or Column -> Column
function, so a job is a plain Spark plan that Catalyst optimises.
"""
