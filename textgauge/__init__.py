"""textgauge: build, measure and explain text classifiers on large document tables.

Every operator is a plain ``DataFrame -> DataFrame`` function written with
Spark SQL and MLlib.  See the README for the layout and the scaling rules.
"""

__version__ = "0.1.0"
