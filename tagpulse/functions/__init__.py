"""Scalar and array expressions, written as Spark SQL text.

Each builder takes SQL text for its input (a column name, a struct field, a lambda
variable) and returns SQL text, so one definition serves ``F.expr``, higher-order
lambdas and SQL functions, and everything stays in the JVM.
"""
