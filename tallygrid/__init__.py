"""tallygrid: word and message tallies on a geographic grid, as Spark jobs.

Every operator is a function from DataFrame (or Column) to DataFrame (or
Column); nothing here holds rows in Python.
"""
