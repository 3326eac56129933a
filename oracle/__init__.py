"""DuckDB oracle SQL for the correctness check of ``__spark_entry__``.

Written independently of the Spark code, in the shape of the specification:
window functions where it uses windows, the 66 specs as a UNION ALL of
group-bys, CASE chains in specification order.  Only the fixture views and
the fixed value tables are shared with the library.
"""
