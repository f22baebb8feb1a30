"""lakeloom: Spark-native claims, observation, payment-message and stream operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL /
DataFrame / Structured Streaming primitives, so Catalyst sees one lazy plan.
"""

__version__ = "0.1.0"
