"""Declare table-to-table jobs as one lazy Spark plan.

The pieces compose in the order of a job: ``sources`` read tables, ``operators``
reshape them with the column ``functions``, ``plans.Flow`` runs the SQL steps over
named tables, and ``sinks`` write the result.
"""
