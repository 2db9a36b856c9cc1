"""Queries over the driver's tables, each next to its SQL twin.

The tables hold no shop pages, so some views render page text from table rows.
The SQL twins never render: they compute the expected fields from the rows, so
a parser fault shows up as a difference.
"""
