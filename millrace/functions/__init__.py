"""Scalar functions. Each takes Spark SQL text for its inputs and returns Spark SQL text.

Use them with ``df.selectExpr`` or ``F.expr``; nothing here runs Python on the executors.
"""
